"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def sort_bounded(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Total order for a result whose row count has a fixed bound (a
    vocabulary, k centres, a fixed set of bucket combinations): its rows
    move to one partition and are sorted there. The exchange keeps the
    aggregate below parallel, and no sampling job runs as for `orderBy`; use
    it only where the bound holds."""
    return df.repartition(1).sortWithinPartitions(*cols)
