"""Survey bucketing and row-wise sums over wide tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_name(name: str) -> str:
    """A column name as a quoted SQL identifier (dots and backticks allowed)."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds a dot."""
    return F.col(sql_name(name))


def working_status(telfs: Column | str = "telfs") -> Column:
    """"working" for 1 <= telfs < 3, otherwise (null included) "not working"."""
    c = quoted(telfs) if isinstance(telfs, str) else telfs
    return F.when((c >= 1) & (c < 3), F.lit("working")).otherwise(F.lit("not working"))


def sex_bucket(tesex: Column | str = "tesex") -> Column:
    """"male" for tesex = 1, otherwise (null included) "female"."""
    c = quoted(tesex) if isinstance(tesex, str) else tesex
    return F.when(c == 1, F.lit("male")).otherwise(F.lit("female"))


def age_bucket(teage: Column | str = "teage") -> Column:
    """"young" for 15..22, "active" for 23..55, otherwise "elder" (bounds inclusive)."""
    c = quoted(teage) if isinstance(teage, str) else teage
    return (F.when((c >= 15) & (c <= 22), F.lit("young"))
            .when((c >= 23) & (c <= 55), F.lit("active"))
            .otherwise(F.lit("elder")))


def hours_sum(columns: Sequence[str], integral: bool = False) -> Column:
    """(0 + c1 + c2 + ...) / 60 as a double: a null term makes the row null,
    an empty list gives 0.0. Integral inputs start from a bigint zero so the
    running sum is 64-bit. One SQL expression however wide the group (real
    survey files have hundreds of minute columns)."""
    zero = "CAST(0 AS BIGINT)" if integral else "0"
    return F.expr("(" + " + ".join([zero] + [sql_name(c) for c in columns]) + ") / 60")
