"""The pipeline's sequences follow the mixture's slots."""

import random

import corpus_pipeline
from quire.llm import mixing, packing


def test_sequences_follow_the_slots(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["ab", "cde", "f"], k=20 if i < 300 else 4000)), "en", f"s{i % 3}", 0)
            for i in range(360)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    want = [r["doc_id"] for r in mixing.mix(docs).orderBy("slot", "position").select("doc_id").collect()]
    text = {r[0]: r for r in rows}
    cuts = [0, 5, 60, 70, 250, len(want)]  # a part file each, of unequal size
    slices = [[text[i] for i in want[lo:hi]] for lo, hi in zip(cuts, cuts[1:])]
    path = str(tmp_path / "mixture")
    parts = spark.sparkContext.parallelize(slices, len(slices)).flatMap(lambda x: x)
    spark.createDataFrame(parts, docs.schema).write.parquet(path)
    assert len(spark.read.parquet(path).inputFiles()) == len(slices)
    packed = corpus_pipeline.pack(spark, spark.read.parquet(path), "").collect()
    found = [(r["doc_id"], r["start"]) for r in sorted(packed, key=lambda r: r["sequence_id"])]
    assert [i for i, start in found if start == 0] == want
    assert len({r["sequence_id"] for r in packed}) == len(packed)
    at = {}
    for r in sorted(packed, key=lambda r: r["sequence_id"]):  # a document's pieces are neighbours, in order
        assert r["start"] == at.get(r["doc_id"], 0)
        at[r["doc_id"]] = (r["start"] + r["length"]) % r["doc_tokens"]


def test_numbers_are_unique_over_partition_folders(spark, tmp_path):
    rows = [(i, "word " * (i % 7 + 1), f"s{i % 4}") for i in range(80)]
    path = str(tmp_path / "parts")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).write.partitionBy("source").parquet(path)
    docs = spark.read.parquet(path)
    assert len({f.rsplit("/", 1)[-1] for f in docs.inputFiles()}) < len(docs.inputFiles())
    packed = packing.in_file_order(packing.digest(packing.pack(docs, places=True))).collect()
    assert sorted(r["sequence_id"] for r in packed) == list(range(len(packed))) and len(packed) >= 80
    assert {r["doc_id"] for r in packed} == set(range(80))
    memory = spark.createDataFrame(rows, "doc_id long, text string, source string")  # no files
    alike = packing.in_file_order(packing.digest(packing.pack(memory, places=True)))
    assert alike.columns == [c for c in packing.digest(packing.pack(memory)).columns] and alike.count() == len(packed)
