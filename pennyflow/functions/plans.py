"""Hints to the optimizer."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """``value``, worked out once per row.

    Catalyst may copy the expression behind a column into each filter and field access above it,
    which is costly when it parses JSON. It does not copy through the explode of one element.
    """
    return F.explode(F.array(value))
