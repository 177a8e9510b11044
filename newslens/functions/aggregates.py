"""Aggregates shared by marts and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_avg(score: Column) -> Column:
    """Mean of a score that does not depend on the order of rows.

    Doubles summed in another order give another last digit, so a retried task would change the answer; the sum is
    held as a decimal and only the quotient is a double. Null when no row has a score.
    """
    total = F.sum(score.cast("decimal(28,12)")).cast("double")
    return F.try_divide(total, F.count(score).cast("double"))


def rounded_avg(score: Column, digits: int = 3) -> Column:
    """The mean, rounded half up as a decimal: the nearest double of a tie may lie on the wrong side of it."""
    return F.round(exact_avg(score).cast("decimal(28,12)"), digits).cast("double")


def label_counts() -> list[Column]:
    """Rows per sentiment label."""
    return [
        F.count_if(F.col("sentiment_label") == label).alias(f"{label}_count")
        for label in ("positive", "neutral", "negative")
    ]
