"""Stored index, explicit partitioning, large vocabularies, bands of centres,
medians by histogram, one-scan CSV types, resumable k-means."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from quire.functions.geometry import bands
from quire.operators import articles as A
from quire.operators import clustering, postings
from quire.plans import catalogue, programs
from quire.plans import params as P
from quire.sources import bucketed, index_store, lines, tables
from quire.sources import csv as C

SF = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def generated(df) -> list[int]:
    """The largest compiled method of each whole-stage codegen stage, in bytes."""
    df.collect()
    jvm = df.sparkSession._jvm
    plan = df._jdf.queryExecution().executedPlan()
    text = jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    return [int(line.split("maxMethodCodeSize:")[1].split(";")[0]) for line in text.splitlines() if "maxMethodCodeSize:" in line]


# --- lines are parsed once ---------------------------------------------------

def test_a_line_is_split_once(spark):
    text = spark.createDataFrame([("1,7,,,5,Java",), ("2,8,,7,3,",)], "value string")
    plan = lines.parse_postings(text)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    scored = postings.scored_postings(lines.parse_postings(text))
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2  # once on each side
    plan = lines.parse_articles(text)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("instr(") == 1


def test_parsing_stays_compiled(spark):
    df = catalogue.scored_postings_from_lines(spark, SF)
    sizes = generated(df)
    assert sizes and max(sizes) < 8000


def test_null_and_malformed_lines_are_rejects(spark):
    text = spark.createDataFrame([(None,), ("1,7,,,5,Java",), ("1,x,,,5,",), ("",)], "value string")
    good, rejects = lines.parse_postings(text, mode="permissive")
    assert good.count() == 1 and sorted(rows(rejects), key=str) == sorted([(None,), ("1,x,,,5,",), ("",)], key=str)
    with pytest.raises(Exception, match="malformed posting line"):
        lines.parse_postings(text.where("value is null or value = ''")).count()


def test_a_bad_field_fails_whatever_is_read(spark):
    raw = spark.createDataFrame([("a", "1", "2"), ("b", "zz", "3")], "id string, x string, y string")
    for read in (lambda d: d.count(), lambda d: d.select("id").collect(), lambda d: d.select("y").collect()):
        with pytest.raises(Exception, match="not a number in column x: zz"):
            read(C.typed_rows(raw))


# --- hot questions -----------------------------------------------------------

def hot_posts(spark, n=40_000, share=3):
    answers = spark.range(n).selectExpr(
        "2 posting_type", "id + 1000000 id", "cast(null as bigint) accepted_answer",
        f"if(id % {share} = 0, 0, id % 5000) parent_id", "int(id % 50) score", "cast(null as string) tag")
    asked = spark.range(5000).selectExpr(
        "1 posting_type", "id", "cast(null as bigint) accepted_answer", "cast(null as bigint) parent_id", "0 score", "'t' tag")
    return asked.unionByName(answers)


def test_hot_questions_are_found_and_sized(spark):
    found = dict(rows(postings.hot_questions(hot_posts(spark), partitions=20)))
    assert set(found) == {0} and 100 <= found[0] <= 120  # a third of 320 pieces
    assert rows(postings.hot_questions(hot_posts(spark).where("posting_type = 1"))) == []
    assert rows(postings.hot_questions(hot_posts(spark).where("id >= 1000000 and parent_id <> 0"), partitions=20)) == []


def test_hot_questions_spread_without_aqe(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "20"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        posts = hot_posts(spark)
        for split, ok in ((True, lambda m, l: l <= 2 * m), (False, lambda m, l: l > 5 * m)):
            paired = postings.grouped_postings(posts, split_hot=split)
            sizes = sorted(r[1] for r in rows(paired.groupBy(F.spark_partition_id()).count()))
            assert ok(sizes[len(sizes) // 2], sizes[-1]) and sum(sizes) == 40_000
        a, b = (postings.grouped_postings(posts, split_hot=s) for s in (True, False))
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


# --- nearest centre by bands -------------------------------------------------

def lines_of(points):
    return sorted(r[0] for r in points.select("x").distinct().collect())


def nearest(x, y, centers):
    return min(centers, key=lambda c: ((x - c[1]) ** 2 + (y - c[2]) ** 2, c[0]))[0]


@pytest.mark.parametrize("k", [1, 2, 3, 64, 65, 1000])
def test_bands_assign_as_all_distances_do(spark, k):
    rng = random.Random(k)
    centers = [(3 * i, rng.choice([-50, 0, 7, 50]), rng.randrange(-40, 40)) for i in range(k)]
    points = spark.createDataFrame([(x, y, 1) for x in (-50, 0, 7, 13) for y in range(-60, 60)], "x long, y long, w long")
    found = clustering.assign(points, centers, lines_of(points))
    assert all(r.center_id == nearest(r.x, r.y, centers) for r in found.collect())
    assert max(generated(found)) < 8000 and "lambda" not in executed(found)


def test_conditions_on_the_centre_stay_above_the_bisection(spark):
    points = spark.createDataFrame([(x, y, 1) for x in range(15) for y in range(60)], "x long, y long, w long")
    centers = [(i, i % 15, i) for i in range(200)]
    found = clustering.assign(points, centers, lines_of(points)).where("center_id = 3")
    joined = found.join(spark.range(5).withColumnRenamed("id", "center_id"), "center_id")
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN") < 20
    assert max(generated(joined)) < 8000
    assert sorted(rows(joined.select("x", "y"))) == sorted((x, y) for x in range(15) for y in range(60) if nearest(x, y, centers) == 3)


def test_bands_of_extreme_places():
    far = 1 << 62
    for x in (-far, 0, far):
        found = bands(x, [(0, -far, -far), (1, far, far), (2, 0, 0), (3, 0, 0)])
        assert found[0][0] == -(1 << 63) and all(a[0] < b[0] for a, b in zip(found, found[1:]))
        assert 3 not in {c for _, c in found}


def test_points_on_too_many_lines_take_all_distances(spark, monkeypatch):
    monkeypatch.setattr(clustering, "MAX_LINES", 3)
    points = spark.createDataFrame([(x, x, 1) for x in range(5)], "x long, y long, w long")
    centers = [(i, i, i) for i in range(70)]
    assert clustering.lines_of(points, centers) is None
    assert dict(rows(clustering.kmeans_assign(points, centers))) == {i: 1 for i in range(5)}


# --- medians -----------------------------------------------------------------

@pytest.mark.parametrize("spread", [5, 70_000, 1 << 40, 1 << 63])
def test_medians_by_histogram(spark, spread):
    rng = random.Random(spread)
    data = [(g, rng.randrange(-spread, spread), rng.randrange(0, 4)) for g in range(4) for _ in range(40)]
    data += [(9, -5, 1), (9, -4, 1), (10, 3, 0), (11, None, 1), (None, 7, 1)]
    if spread == 1 << 63:
        data += [(12, -(1 << 63), 1), (12, (1 << 63) - 1, 2)]
    frame = spark.createDataFrame(data, "g int, v long, w long")
    want = {}
    for g in {d[0] for d in data}:
        each = sorted(v for h, v, w in data if h == g and v is not None for _ in range(w))
        if each:
            want[g] = math.floor((each[(len(each) - 1) // 2] + each[len(each) // 2]) // 2)
    assert dict(rows(clustering.group_medians(frame, "g", "v", "w"))) == want
    assert rows(clustering.group_medians(frame.where("false"), "g", "v", "w")) == []


def test_a_histogram_holds_digits_not_scores(spark):
    points = spark.range(300_000).selectExpr("0L g", "id * 1000 v", "1L w")
    found = clustering.group_medians(points, "g", "v", "w")
    assert "percentile" not in executed(found) and rows(found) == [(0, 149_999_500)]


# --- vocabularies of any length ----------------------------------------------

def corpus(spark, n=300):
    rng = random.Random(1)
    return spark.createDataFrame(
        [(f"t{i}", " ".join(f"w{min(int(rng.expovariate(0.05)), 499)}" for _ in range(30))) for i in range(n)]
        + [("none", None), ("empty", ""), ("t0", "w1 w1  w1")], "title string, text string")


@pytest.mark.parametrize("limit", [64 << 20, 0], ids=["broadcast", "shuffled"])
def test_large_vocabularies(spark, monkeypatch, limit):
    monkeypatch.setattr(A, "BROADCAST_BYTES", limit)
    arts, vocab = corpus(spark), [f"w{k}" for k in range(500)] + [f"absent{k}" for k in range(3000)]
    want_rank = rows(A.rank_terms(arts, vocab[:600]))
    found = rows(A.rank_terms(arts, vocab))
    assert found[:600] == want_rank and len(found) == 3500 and found == rows(A.rank_terms_agg(arts, vocab))
    table = spark.createDataFrame(pa.table({"idx": range(600), "term": vocab[:600]}))
    assert rows(A.rank_terms(arts, table)) == want_rank
    index, long = A.inverted_index(arts, vocab[:600]), A.inverted_index(arts, vocab)
    assert sorted(rows(long)) == sorted(rows(index))
    assert sorted(rows(A.inverted_index(arts, table, with_text=True))) == sorted(rows(A.inverted_index(arts, vocab[:600], True)))
    assert rows(A.rank_terms_using_index(long, vocab)) == found
    blocks = A.inverted_index_blocks(long, vocab, 20)
    assert rows(A.rank_terms_using_index(blocks, vocab)) == found


def test_a_million_terms(spark):
    arts = corpus(spark)
    terms = spark.range(1_000_000).select(F.col("id").alias("idx"), F.concat(F.lit("w"), "id").alias("term"))
    found = A.rank_terms(arts, terms)
    assert found.count() == 1_000_000
    assert rows(found.limit(500)) == rows(A.rank_terms(arts, [f"w{k}" for k in range(500)]))[:500]


def test_a_vocabulary_table_is_checked(spark):
    for bad in ([(0, "a"), (1, "a")], [(0, "")], [(0, None)], []):
        with pytest.raises(ValueError):
            A.rank_terms(corpus(spark), spark.createDataFrame(bad, "idx long, term string"))


def test_vectors_of_a_vocabulary_table(spark):
    scored = spark.createDataFrame([("a", 3), ("b", 5), ("z", 1), (None, 2)], "tag string, high_score int")
    table = spark.createDataFrame([(0, "a"), (1, "b")], "idx long, term string")
    assert sorted(rows(postings.vector_postings(scored, table, 10))) == sorted(rows(postings.vector_postings(scored, ["a", "b"], 10)))


def test_ranking_from_a_block_index(spark):
    index = spark.range(1000).selectExpr("'java' term", "concat('t', id) title")
    assert rows(A.rank_terms_using_index(A.inverted_index_blocks(index, ["java", "php"], 100), ["java", "php"])) == [
        ("java", 1000), ("php", 0)]


def test_first_terms_are_a_top_k(spark):
    ranking = A.rank_terms(corpus(spark), ["w9", "w1", "absent", "w2"])
    first = A.top_term(ranking, ["w9", "w1", "absent", "w2"], 2)
    assert rows(first) == rows(ranking)[:2]
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()


# --- bitmaps -----------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 63, 64, 65, 130])
def test_bitmaps_rank_as_texts_do(spark, n):
    arts, vocab = corpus(spark), [f"w{k}" for k in range(n)]
    bits = A.term_bitmaps(arts, vocab)
    want = rows(A.rank_terms(arts, vocab))
    assert rows(A.rank_bitmaps(bits, vocab)) == rows(A.rank_bitmaps_agg(bits, vocab)) == want
    assert sorted(rows(A.index_bitmaps(bits, vocab))) == sorted(rows(A.inverted_index(arts, vocab)))


def test_the_ranking_program_reads_its_file_once(spark, tmp_path):
    p = tmp_path / "articles.dat"
    p.write_text("".join(f"X<page><title>A{i}</title><text>Scala {'Java ' * (i % 2)}{'x' * 5000}</text></page>YY\n"
                         for i in range(50)), encoding="utf-8")
    out = programs.rank_articles(spark, str(p), ["Java", "Scala"])
    assert out["naive"] == out["index"] == out["by_key"] == [("Scala", 50), ("Java", 25)]
    bits = A.term_bitmaps(lines.read_articles(spark, str(p)), ["Java", "Scala"]).select("bits").cache()
    bits.count()
    kept = bits._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert kept < 5000  # 250,000 characters of text
    bits.unpersist()


# --- stored index ------------------------------------------------------------

@pytest.mark.parametrize("vocab", [None, [f"w{k}" for k in range(40)], [f"w{k}" for k in range(2500)]], ids=["all", "list", "long"])
def test_stored_index(spark, tmp_path, monkeypatch, vocab):
    monkeypatch.setattr(index_store, "CHUNK", 70)
    arts = corpus(spark).repartition(5, "title")
    index_store.write_index(arts, str(tmp_path / "i"), vocab, block_size=8, with_text=True)
    index = index_store.StoredIndex(spark, str(tmp_path / "i"))
    terms = [f"w{k}" for k in range(40)]
    want = A.inverted_index(arts, terms, with_text=True)
    assert sorted(rows(index.lookup(terms, text=True))) == sorted(rows(want))
    assert rows(index.rank(terms)) == rows(A.rank_terms(arts, terms))
    assert rows(index.rank_all(3)) == rows(A.rank_terms(arts, terms))[:3]
    sizes = [tuple(r) for r in index.blocks.select("n", F.size("gaps").alias("gaps")).collect()]
    assert all(n == gaps + 1 <= 8 for n, gaps in sizes)
    assert index.blocks.select("term", "block").distinct().count() == len(sizes)
    assert sorted(rows(index.articles.select("doc"))) == [(i,) for i in range(303)]


def test_ranking_a_stored_index_reads_sizes_only(spark, tmp_path):
    index_store.write_index(corpus(spark), str(tmp_path / "i"))
    index = index_store.StoredIndex(spark, str(tmp_path / "i"))
    plan = executed(index.rank(["w1", "w2"]))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("ReadSchema: struct<term:string,n:bigint>" in s and "In(term" in s for s in scans)
    with pytest.raises(ValueError):
        index.lookup(["w1"], text=True)
    index_store.write_index(corpus(spark).where("false"), str(tmp_path / "none"))
    assert rows(index_store.StoredIndex(spark, str(tmp_path / "none")).rank(["w1"])) == [("w1", 0)]


# --- explicit partitioning ---------------------------------------------------

def test_bucketed_postings(spark, tmp_path):
    posts = tables.postings_view(spark, SF)
    bucketed.write_postings(posts, "quire_test_posts", 6, str(tmp_path / "posts"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = bucketed.read_postings_tables(spark, "quire_test_posts")
        assert stored.columns == posts.columns
        assert stored.exceptAll(posts).count() == posts.exceptAll(stored).count() == 0
        scored = bucketed.shuffle_free(postings.scored_postings(stored))
        assert sorted(rows(scored), key=str) == sorted(rows(postings.scored_postings(posts)), key=str)
        paired = bucketed.shuffle_free(postings.grouped_postings(stored, split_hot=False))
        assert paired.count() == postings.grouped_postings(posts).count()
        with pytest.raises(ValueError, match="shuffles"):
            bucketed.shuffle_free(postings.scored_postings(posts))
        with pytest.raises(ValueError):
            bucketed.write_postings(posts, "quire_test_posts", 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for side in bucketed.SIDES:
            spark.sql(f"DROP TABLE IF EXISTS quire_test_posts_{side}")


# --- CSV types in one scan ---------------------------------------------------

def test_types_and_data_from_one_scan(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a.b,i,l,d,day,at,yes,s,none,mixed\n"
                 "x,1,1,1,2024-01-02,2024-01-02,true,1,,1\n"
                 "y,-2,3000000000,2.5,2024-02-03,2024-01-02 03:04:05,FALSE,z,,true\n"
                 ",,,,,,,,,\n", encoding="utf-8")
    names, df = C.read_csv(spark, str(p))
    assert names == ["a.b", "i", "l", "d", "day", "at", "yes", "s", "none", "mixed"]
    assert [f.dataType.simpleString() for f in df.schema] == [
        "string", "int", "bigint", "double", "date", "timestamp", "boolean", "string", "string", "string"]
    assert df.count() == 3 and df.where("yes").select("l", "d").first() == (1, 1.0)
    assert "FileScan" not in executed(df)  # the data come from the pass that found the types


def test_types_match_sparks_own(spark, tmp_path):
    catalogue.tables.wide_view(spark, SF).write.option("header", "true").csv(str(tmp_path / "wide"))
    _, df = C.read_csv(spark, str(tmp_path / "wide"))
    own = spark.read.options(header=True, inferSchema=True).csv(str(tmp_path / "wide"))
    assert df.schema == own.schema
    assert df.exceptAll(own).count() == own.exceptAll(df).count() == 0


def test_class_sets_merge_in_any_order():
    assert C.column_type(0) == C.column_type(C.TEXT) == C.column_type(C.INT | C.DATE) == C.T.StringType()
    assert C.column_type(C.LONG) == C.T.LongType() and C.column_type(C.LONG | C.INT | C.DOUBLE) == C.T.DoubleType()


def test_fields_that_do_not_fit_are_rescued(spark):
    schema = C.T.StructType([C.T.StructField("id", C.T.StringType()), C.T.StructField("n.x", C.T.IntegerType()),
                             C.T.StructField("d", C.T.DoubleType())])
    raw = spark.createDataFrame([("a", "1", "2.5"), ("b", "one", "x"), ("c", None, "3")], "id string, `n.x` string, d string")
    found = {r["id"]: tuple(r)[1:] for r in C.rescued_rows(raw, schema).collect()}
    assert found == {"a": (1, 2.5, None), "b": (None, None, {"n.x": "one", "d": "x"}), "c": (None, 3.0, None)}


# --- k-means that goes on ----------------------------------------------------

class Killed(Exception):
    pass


def test_a_killed_run_goes_on(spark, tmp_path, monkeypatch):
    points = clustering.materialize(clustering.weighted_points(catalogue.vectors(spark, SF)))
    centers = clustering.collect_centers(clustering.sample_vectors(points, len(P.POSTING_VOCAB), P.KERNELS))
    whole = clustering.kmeans(points, centers, 0.5, 9, checkpoint=False)
    step, done = clustering._centroids, []

    def dies_in_round_8(*args):
        done.append(1)
        if len(done) == 8:
            raise Killed
        return step(*args)

    monkeypatch.setattr(clustering, "_centroids", dies_in_round_8)
    saved = clustering.SavedRun(spark, str(tmp_path / "run"))
    with pytest.raises(Killed):
        clustering.kmeans(points, centers, 0.5, 9, saved=saved)
    again = clustering.kmeans(points.where("false"), centers, 0.5, 9, saved=clustering.SavedRun(spark, str(tmp_path / "run")))
    assert len(done) == 8 + whole.iterations - 7  # rounds 1 to 7 were not computed again
    assert (again.centers, again.iterations, again.moved, again.trace) == (
        whole.centers, whole.iterations, whole.moved, whole.trace)
    with pytest.raises(ValueError, match="other centres"):
        clustering.kmeans(points, centers[:-1], 0.5, 9, saved=saved)


def test_vector_count_is_checked_before_kmeans(spark):
    points = clustering.materialize(spark.createDataFrame([(0, 1, 2), (0, 5, 1)], "x long, y long, w long"))
    assert clustering.expect_vectors(points, 3) is points and clustering.expect_vectors(points, None) is points
    with pytest.raises(ValueError, match="unexpected vector count"):
        clustering.expect_vectors(points, 4)


def test_trace_lines(capsys):
    clustering._print_round(1, 4.0, 20.0, [(0, 1, 2)], [(0, 1, 4)])
    assert "(1,2) ==>" in capsys.readouterr().out.replace("               ", "")
