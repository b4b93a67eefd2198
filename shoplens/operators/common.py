"""Small building blocks shared by the aggregate operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_grand_total(grouped: DataFrame, measure: str | Column, alias: str) -> DataFrame:
    """Attach ``sum(measure)`` over all rows of an *aggregated* result.

    Use only after a groupBy whose number of groups is small and bounded by
    the domain (hours, flags; star ratings and top-level categories, which the
    catalogue bounds, not the number of rows): the window
    moves just those rows to one task and reads them once, instead of a
    second pass over the raw input."""
    m = F.col(measure) if isinstance(measure, str) else measure
    return grouped.withColumn(alias, F.sum(m).over(Window.partitionBy()))
