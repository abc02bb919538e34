"""The corpus pipeline: five stages from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import langid, lines, mixing, packing, simhash
from quire.llm.common import read_table, scratch_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; the rest keep their columns."""
    return langid.identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document has go; so do documents left blank by it."""
    found = lines.dedup_lines(docs)
    blank = F.length(F.translate("text", " \t\r\n\x0b\f", "")) == 0
    found = found.where(F.col("text").isNull() | (F.col("n_removed") == 0) | ~blank)
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id.
    Documents without an id stay."""
    copies = simhash.near_duplicates(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in slot order; documents of small sources come repeatedly."""
    return mixing.in_order(mixing.mix(docs)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length, with the crc32 of their ids; their
    numbers follow the mixture's slots, the order in which its rows were written."""
    return packing.in_file_order(packing.digest(packing.pack(docs, places=True)))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each stage's rows are written as
    Parquet to the shared folder and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), name)
    return docs
