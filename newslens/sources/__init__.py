"""Reading what lands and writing tables."""
