"""newslens: entity mentions and sentiment over streams and tables of text, as Spark DataFrame operators."""
