"""Wide CSV source of the survey operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.buckets import sql_name
from quire.functions.checks import must_hold
from quire.functions.text import sql_string
from quire.session import ensure_checkpoint_dir


# The classes of a field's text, from narrow to wide in each family; a column's
# set of classes is the bitwise or of its fields', so partial sets merge in any
# order, and twice makes no difference.
INT, LONG, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << k for k in range(7))

# (SQL test of a field, class), the first that holds.
FIELD_CLASSES = [
    ("{c} RLIKE '^[+-]?[0-9]+$' AND try_cast({c} AS INT) IS NOT NULL", INT),
    ("{c} RLIKE '^[+-]?[0-9]+$' AND try_cast({c} AS BIGINT) IS NOT NULL", LONG),
    ("try_cast({c} AS DOUBLE) IS NOT NULL", DOUBLE),
    ("{c} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' AND try_cast({c} AS DATE) IS NOT NULL", DATE),
    ("{c} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]' AND try_cast({c} AS TIMESTAMP) IS NOT NULL", TIMESTAMP),
    ("lower({c}) IN ('true', 'false')", BOOLEAN),
]

# The narrowest type of a set of classes: the first whose classes cover it.
TYPES = [(INT, T.IntegerType()), (INT | LONG, T.LongType()), (INT | LONG | DOUBLE, T.DoubleType()),
         (DATE, T.DateType()), (DATE | TIMESTAMP, T.TimestampType()), (BOOLEAN, T.BooleanType())]


def field_class(name: str) -> Column:
    """The class of a text field as a number with one bit; 0 for null."""
    c = sql_name(name)
    tests = " ".join(f"WHEN {test.format(c=c)} THEN {bit}" for test, bit in FIELD_CLASSES)
    return F.expr(f"CASE WHEN {c} IS NULL THEN 0 {tests} ELSE {TEXT} END")


def column_type(classes: int) -> T.DataType:
    """The type that holds all fields of a column; text for mixed families and
    for a column without fields."""
    return next((kind for cover, kind in TYPES if classes and not classes & ~cover), T.StringType())


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> tuple[list[str], DataFrame]:
    """(column names, frame) of a CSV file with a header.

    With `schema` the frame is lazy. Without one the types are inferred, and
    the file is read once for both types and data: one job checkpoints the
    fields as text into `spark.checkpoint.dir` and, as they pass, collects
    each column's set of field classes (one number per task and column,
    merged by bitwise or, so tasks that run again change nothing). The frame
    casts the checkpoint's fields.
    """
    reader = spark.read.option("header", "true")
    if schema is not None:
        df = reader.schema(schema).csv(path)
        return list(df.columns), df
    text = reader.csv(path)
    found = Observation()
    classes = [F.bit_or(field_class(c)).alias(f"c{k}") for k, c in enumerate(text.columns)]
    ensure_checkpoint_dir(spark)
    kept = text.observe(found, *classes).checkpoint(eager=True)
    sets = found.get
    kinds = [column_type(sets.get(f"c{k}") or 0) for k in range(len(text.columns))]
    return list(text.columns), kept.selectExpr(*[
        f"try_cast({sql_name(c)} AS {kind.simpleString()}) AS {sql_name(c)}" for c, kind in zip(text.columns, kinds)])


def rescued_rows(text: DataFrame, schema: T.StructType, rescued: str = "_rescued") -> DataFrame:
    """Text fields cast to `schema`, and a map column of those that don't fit:
    name to text, null where all do. No row is lost and none fails the job."""
    names = schema.fieldNames()
    typed = [f"try_cast({sql_name(f.name)} AS {f.dataType.simpleString()}) AS {sql_name(f.name)}" for f in schema]
    bad = ", ".join(
        f"IF({sql_name(f.name)} IS NOT NULL AND try_cast({sql_name(f.name)} AS {f.dataType.simpleString()}) IS NULL, "
        f"named_struct('k', {sql_string(f.name)}, 'v', CAST({sql_name(f.name)} AS STRING)), NULL)" for f in schema)
    entries = f"array_compact(array({bad}))"
    return text.select(*[F.col(sql_name(n)) for n in names]).selectExpr(
        *typed, f"IF(size({entries}) > 0, map_from_entries({entries}), NULL) AS {sql_name(rescued)}")


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV file; reads its first line only."""
    return spark.read.option("header", "true").csv(path).columns


def row_schema(columns: list[str]) -> T.StructType:
    """First column string, every other column double."""
    if not columns:
        raise ValueError("a row needs at least one field")
    return T.StructType([T.StructField(columns[0], T.StringType(), True)]
                        + [T.StructField(c, T.DoubleType(), True) for c in columns[1:]])


def typed_rows(df: DataFrame) -> DataFrame:
    """Cast raw fields to the row schema: the first field stays a string, all
    others become doubles. A non-numeric field fails the job whatever columns
    are read, and for a mere count too (with ANSI mode on or off); an empty
    field is null."""
    cols = df.columns
    names = [sql_name(c) for c in cols]
    wrong = [f"{n} IS NOT NULL AND try_cast({n} AS DOUBLE) IS NULL" for n in names[1:]]
    if wrong:
        told = " ".join(f"WHEN {w} THEN concat({sql_string(c)}, ': ', CAST({n} AS STRING))"
                        for w, c, n in zip(wrong, cols[1:], names[1:]))
        df = must_hold(df, ~F.expr(" OR ".join(f"({w})" for w in wrong)),
                       F.concat(F.lit("not a number in column "), F.expr(f"CASE {told} END")))
    return df.selectExpr(f"CAST({names[0]} AS STRING) AS {names[0]}",
                         *[f"try_cast({n} AS DOUBLE) AS {n}" for n in names[1:]])
