"""Arithmetic of issue numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

WRAP = 300  # a difference as large as this is a change of year


def window(issue: Column, n: int) -> Column:
    """Issue, issue - 1, ... newest first."""
    return F.sequence(issue, issue - (n - 1), F.lit(-1))


def delta(previous: Column, current: Column) -> Column:
    """The step between issues, with the wrap at the turn of a year."""
    step = current - previous
    return F.when(step <= -WRAP, F.lit(1)).when(step >= WRAP, F.lit(-1)).otherwise(step)
