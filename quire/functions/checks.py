"""Checks that no later projection can remove, and values computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def must_hold(df: DataFrame, condition: Column, message: Column | str) -> DataFrame:
    """`df`, whose job fails on the first row for which `condition` isn't true.

    The check is a filter, so it runs whatever columns a consumer reads, and
    for a mere count too; an error inside a projected column would be pruned
    together with that column.
    """
    text = F.lit(message) if isinstance(message, str) else message
    return df.where(F.when(condition, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))


def once(value: Column) -> Column:
    """`value` as the one row of a generator: computed once for each input row.
    A projected column would be copied into each of its uses, and a condition
    on it moved below it with its whole expression."""
    return F.explode(F.array(value))
