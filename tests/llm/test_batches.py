"""Batches that reach the Python workers are bounded by their bytes."""

import pyarrow as pa
import pytest

from quire.llm import common


@pytest.fixture()
def unset(spark):
    before = spark.conf.getAll.get(common.BATCH_CONF)
    spark.conf.unset(common.BATCH_CONF)
    yield
    spark.conf.unset(common.BATCH_CONF)
    if before is not None:
        spark.conf.set(common.BATCH_CONF, before)


def sizes(spark):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    texts = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('word ', 2000) AS text")
    return common.map_arrow(texts, run, "n long, size long").collect()


def test_batches_are_small(spark, unset):
    found = sizes(spark)
    assert sum(r["n"] for r in found) == 3000
    assert max(r["size"] for r in found) < 2 * common.BATCH_BYTES


def test_a_sessions_own_batch_size_holds(spark, unset):
    spark.conf.set(common.BATCH_CONF, "8m")
    found = sizes(spark)
    assert sum(r["n"] for r in found) == 3000
    assert 4 << 20 < max(r["size"] for r in found) < 16 << 20
