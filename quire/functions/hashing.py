"""Deterministic hash keys that Spark and ANSI-SQL engines compute alike
(md5 of the text form), for sampling order and posting-list blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_rank_key(*parts: Column | str, seed: int = 42) -> Column:
    """md5 hex of 'p1:p2:...:seed' — a seeded, engine-independent sort key."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols], F.lit(str(seed))))


def md5_prefix32(value: Column | str) -> Column:
    """The first 32 bits of md5(value) as a non-negative bigint."""
    c = F.col(value) if isinstance(value, str) else value
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")
