"""Hard negatives, lexical search and decontamination against plain versions."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import fmindex, lexical, negatives, words

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_words(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# --- words -------------------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.one_of(st.sampled_from("aB zZ09/:@[`{\x7f\x80é\n"), st.characters(codec="utf-8")),
                                             max_size=30)), max_size=6))
def test_words_equal_the_pattern(texts):
    array = pa.array(["x"] + texts + ["y"], pa.string()).slice(1, len(texts))
    codes, bounds, found = words.coded(array)
    got = [[found[k].as_py().decode() for k in codes[lo:hi].tolist()] for lo, hi in zip(bounds, bounds[1:])]
    assert got == [[w + " " for w in plain_words(t)] for t in texts]


def test_slices_cover_a_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["aaaa", None, "b" * 50, "", "cc", "dd"])], ["t"])
    parts = list(words.slices(batch, 0, 6))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert [p.num_rows for p in parts] == [2, 1, 3]


# --- FM-index ----------------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_order(codes):
    whole = np.array([*codes, 0])
    assert suffixes(whole) == fmindex.suffix_order(whole).tolist()


def suffixes(whole):
    return sorted(range(len(whole)), key=lambda i: whole[i:].tolist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=200))
def test_wavelet_rank_and_access(symbols):
    s = np.array(symbols)
    w = fmindex.Wavelet.build(s, 9)
    got, _ = w.access(np.arange(len(s)))
    assert got.tolist() == symbols
    top = 1 << w.levels
    for c in range(min(10, top)):
        at = np.arange(len(s) + 1)
        rank = w.follow(np.full(len(at), c), at) - w.follow(np.array([c]), np.array([0]))
        assert rank.tolist() == [symbols[:i].count(c) for i in at]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=25), min_size=1, max_size=5),
       st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=4), min_size=1, max_size=6))
def test_every_occurrence_is_located(docs, phrases):
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    shard = fmindex.Shard.build(np.array([c for d in docs for c in d], np.int64), bounds, 3)
    table = np.full((len(phrases), 4), -1)
    for k, p in enumerate(phrases):
        table[k, :len(p)] = np.array(p) + 1
    got = [list(zip(*(x.tolist() for x in part))) for part in shard.occurrences(table, np.array([len(p) for p in phrases]))]
    want = [(k, d, i) for k, p in enumerate(phrases) for d, doc in enumerate(docs)
            for i in range(len(doc) - len(p) + 1) if doc[i:i + len(p)] == p]
    assert sorted(x for part in got for x in part) == sorted(want)


def plain_contamination(docs, items, window=10):
    wanted = collections.defaultdict(set)
    for item, text in items:
        w = plain_words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w and item is not None else 0):
            wanted[tuple(w[i:i + k])].add(item)
    sizes = {len(w) for w in wanted}
    out = []
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wanted:
                    hit |= set(range(i, i + k))
                    found |= wanted[tuple(w[i:i + k])]
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 24, 150])
def test_contamination(spark, monkeypatch, block):
    rng = random.Random(5)
    monkeypatch.setattr(fmindex, "BLOCK_BYTES", block)
    word = lambda n: " ".join(rng.choice(["ab", "Cd", "é", "x9", "über"]) for _ in range(n))
    items = [(1, word(30)), (2, word(12)), (2, word(11)), (10, "Solo"), (11, "two words"), (12, None), (13, " ,. "),
             (None, word(15)), (14, word(10))]
    docs = [(i, f"{word(rng.randint(0, 40))} {rng.choice(items)[1] or ''}! {word(rng.randint(0, 40))}") for i in range(60)]
    docs += [(100, None), (101, ""), (102, "solo"), (102, "solo"), (None, f"a {items[0][1]}"), (103, "SOLO two;words solo"),
             (104, word(30_000)), (105, items[0][1].upper())]
    frame = spark.createDataFrame([(*d, "x", "x", 1) for d in docs], "doc_id long, text string, spans string, items string, shard int")
    bench = spark.createDataFrame([(*i, "x", 0) for i in items], "item_id long, text string, h string, size int")
    found = fmindex.digest(fmindex.decontaminate(frame, bench))
    assert sorted(map(tuple, found.collect()), key=str) == plain_contamination(docs, items)


def test_spans_and_cleaned_texts(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Before it, {passage} -- after."), (2, "nothing here"), (3, None), (4, passage)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(7, f"{passage}")], "item_id long, text string")
    found = {r["doc_id"]: r for r in fmindex.decontaminate(frame, bench).collect()}
    assert [tuple(s) for s in found[1]["spans"]] == [(2, 13)] and found[1]["items"] == [7]
    assert found[2]["spans"] == [] and found[3]["n_words"] == 0
    cleaned = {r["doc_id"]: r["text"] for r in fmindex.cleaned(frame, bench).collect()}
    assert cleaned == {1: "Before it, after.", 2: "nothing here", 3: None, 4: ""}


def test_contamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in fmindex.digest(fmindex.decontaminate(docs, none)).collect()] == plain_contamination([(1, "a b")], [])
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert fmindex.decontaminate(docs.where("false"), some).collect() == []


# --- hard negatives ----------------------------------------------------------

@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 20), st.integers(1, 12), st.integers(1, 12))
def test_lookups_give_exact_products(seed, dims, rows, anchors):
    rng = np.random.default_rng(seed)
    v, a = rng.integers(-300, 300, (rows, dims)), rng.integers(-300, 300, (anchors, dims))
    fill = lambda m: np.pad(m, ((0, 0), (0, -dims % 8)))
    planes = negatives.planes_of(fill(v), 10)
    assert (negatives.integers_of(planes) == fill(v)).all()
    assert (negatives.scores(planes, negatives.subset_sums(fill(a))) == v @ a.T).all()


def plain_negatives(rows, every):
    good = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (a, label, v) in enumerate(good):
        if a % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), i, l, j) for j, (i, l, w) in enumerate(good)]
        order = sorted(scored, key=lambda s: (-s[0], s[1]))
        for n, (p, i, _, _) in enumerate([s for s in order if s[2] == label and s[3] != k][:5]):
            far = [s for s in order if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p][:3]
            out += [(a, i, n + 1, r + 1, s[1], p, s[0]) for r, s in enumerate(far)]
    return sorted(out)


@pytest.mark.parametrize("cells", [(16_384, 16_384), (20, 60)])
def test_hard_negatives(spark, monkeypatch, cells):
    monkeypatch.setattr(negatives, "CELL_ANCHORS", cells[0])
    monkeypatch.setattr(negatives, "CELL_ROWS", cells[1])
    rng = random.Random(2)
    nan, inf = float("nan"), float("inf")
    vector = lambda: [rng.choice([-0.5, 0.25, 0.1, 0.6, 0.0]) for _ in range(9)]  # noqa: E731  (many ties)
    rows = [(i, vector(), rng.randrange(4)) for i in range(150)]
    rows += [(5, rows[5][1], 1), (10, rows[10][1], rows[10][2]), (200, None, 1), (205, [nan] * 9, 1), (210, [inf] * 9, 2),
             (215, [None, 0.5], 1), (220, vector(), None), (None, vector(), 1), (225, [], 1), (230, [0.9], 2), (235, vector(), 77)]
    frame = spark.createDataFrame([(*r, "x", "x", 1) for r in rows],
                                  "vec_id long, embedding array<float>, label int, v string, data string, cell int")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(frame, F.col("vec_id") % 5 == 0, relabel=moved)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 5)
    assert negatives.hard_negatives(frame.where("false"), F.col("vec_id") % 5 == 0).collect() == []
    with pytest.raises(ValueError):
        negatives.hard_negatives(spark.createDataFrame([(1, [1e30], 1)], "vec_id long, embedding array<double>, label int"),
                                 F.lit(True))


def cells_of(v, label, every, feed):
    """A cell's positives and negatives as (anchor, place, id, score), fed by parts; the anchors are every so many rows."""
    ids, at = np.arange(len(v)), np.arange(0, len(v), every)
    bits = 1 + int(max(-v.min() - 1, v.max(), 0)).bit_length()
    v = np.pad(v, ((0, 0), (0, -v.shape[1] % 8)))
    planes, shape = negatives.planes_of(v, bits), (bits, v.shape[1] // 8)
    wide = v.shape[1] << 2 * (bits - 1) >= 1 << 31
    anchors = pa.table({"key": ids[at], "label": label[at], "data": pa.array([planes[i].tobytes() for i in at])})

    def result(cell):
        for lo in range(0, len(v), feed):
            cell.feed(*(x[lo:lo + feed] for x in (ids, ids, label, planes)))
        return [c.to_pylist() for c in cell.result().columns]

    key, found, score = result(negatives.Positives(anchors, shape, wide, 5))
    best = {i: [] for i in at.tolist()}
    for k, s, i in sorted(zip(key, score, found), key=lambda x: (x[0], -x[1], x[2])):
        best[k].append((s, i))
    scores = pa.array([[s for s, _ in best[i]] for i in at.tolist()], pa.list_(pa.int64()))
    key, number, other, score = result(negatives.Negatives(anchors.append_column("scores", scores), shape, wide, 3, 50, 95))
    return best, sorted(zip(key, number, other, score))


def plain_cells(v, label, every):
    best, found = {}, []
    for a in range(0, len(v), every):
        score = [sum(x * y for x, y in zip(v[a].tolist(), w)) for w in v.tolist()]
        order = sorted(range(len(v)), key=lambda i: (-score[i], i))
        best[a] = [(score[i], i) for i in order if label[i] == label[a] and i != a][:5]
        for k, (p, _) in enumerate(best[a]):
            found += [(a, k, i, score[i]) for i in order
                      if label[i] != label[a] and 50 * p <= 100 * score[i] <= 95 * p][:3]
    return best, sorted(found)


def unit_vectors(rng, rows, dims=64):
    v = rng.standard_normal((rows, dims))
    return np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None]).astype(np.int64)


VECTORS = {
    "even": lambda rng: unit_vectors(rng, 700),
    "copies": lambda rng: np.repeat(unit_vectors(rng, 70, 20), 10, axis=0)[rng.permutation(700)],
    "one": lambda rng: np.full((300, 5), 7),
    "far from zero": lambda rng: 1_000_000 + rng.integers(-3, 4, (400, 9)),
    "uneven": lambda rng: (rng.standard_normal((500, 12)) * 4.0 ** np.arange(12)).astype(np.int64),
    "wide": lambda rng: rng.integers(-2**28, 2**28, (400, 8)),
    "few values": lambda rng: rng.integers(-1, 2, (600, 16)),
}


@pytest.mark.parametrize("parts", [(0.012, 0.08), (0.0, 1.0), (1.0, 1.0), (0.0, -1.0)])
@pytest.mark.parametrize("kind", VECTORS)
def test_cells_give_what_all_products_give(monkeypatch, kind, parts):
    """By as few planes as will do, by all steps, by the first steps, by all planes."""
    for name, value in zip(("NEXT_PLANE", "ALL_PLANES"), parts):
        monkeypatch.setattr(negatives, name, value)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 7)
    monkeypatch.setattr(negatives, "ROWS_AT_ONCE", 50)
    monkeypatch.setattr(negatives, "PAIRS_AT_ONCE", 40)
    rng = np.random.default_rng(3)
    v = VECTORS[kind](rng)
    label = rng.integers(0, 4, len(v))
    label[0] = 9  # alone with its label
    assert cells_of(v, label, 20, 300) == plain_cells(v, label, 20)


def test_few_pairs_need_all_planes(monkeypatch):
    """Scoring every pair by all planes took too long on large tables."""
    exact = collections.Counter()

    def counted(name, pairs):
        old = getattr(*name)
        monkeypatch.setattr(*name, lambda *x: (exact.update(n=pairs(*x)), old(*x))[1])

    counted((negatives, "products"), lambda v, anchors, r, a: len(r))
    counted((negatives.Block, "whole"), lambda block, rows: (rows.stop - rows.start) * len(block.some))
    rng = np.random.default_rng(4)
    v, label = unit_vectors(rng, 60_000), rng.integers(0, 10, 60_000)
    cells_of(v, label, 1200, 32_768)
    assert exact["n"] < 0.1 * 1.1 * 60_000 * 50


# --- lexical search ----------------------------------------------------------

def plain_ranking(docs, items, top=10):
    terms = [(i, plain_words(t)) for i, t in docs]
    terms = [(i, collections.Counter(w), len(w)) for i, w in terms if w]
    total, n_docs = sum(n for *_, n in terms), len(terms)
    df = collections.Counter(t for _, c, _ in terms for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in terms:
            m = 100 - 90 + 90 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(plain_words(text)) if t in c)
            if score > 0:
                found.append((-score, i if i is not None else math.inf, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda f: f[:2])[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed_rows, block", [(8192, 1 << 22), (3, 300)])
def test_ranking(spark, monkeypatch, seed_rows, block):
    monkeypatch.setattr(lexical, "SEED_ROWS", seed_rows)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)]
    prose = lambda n: " ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(60)], k=n))
    docs = [(i, prose(rng.randint(0, 50))) for i in range(300)]
    docs += [(400 + i, docs[7][1]) for i in range(20)]  # ties
    docs += [(500, None), (501, ""), (502, "?!"), (None, docs[7][1]), (7, docs[7][1]), (503, prose(20_000)), (504, "Ünique")]
    items = [(1, prose(8)), (2, docs[7][1]), (3, None), (4, ""), (5, "absent words"), (None, "w3 w4"), (2, "W1"),
             (6, "w1 w1 w1"), (7, "ünique Ünique")]
    frame = spark.createDataFrame([(*d, "x", "x", "x") for d in docs], "doc_id long, text string, n string, terms string, length string")
    queries = spark.createDataFrame([(*i, "x", "x") for i in items], "item_id long, text string, doc_id string, h string")
    found = lexical.ranked(frame, queries)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_ranking(docs, items)
    assert lexical.ranked(frame.where("false"), queries).collect() == []
    assert lexical.ranked(frame, queries.where("false")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 8))
def test_buckets_lose_nothing(seed, top):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 12, 40)
    terms = [np.sort(rng.choice(12, size=s, replace=False)) for s in sizes]
    xs = [rng.integers(1, 50, size=s) for s in sizes]
    weight = rng.integers(0, 30, 12)
    query = lexical.Query(rng.choice(12, size=rng.integers(1, 12), replace=False).tolist(), weight)
    score = np.array([sum(int(weight[t]) * int(x) for t, x in zip(a, b) if t in query.terms) for a, b in zip(terms, xs)])
    order = [k for k in np.lexsort((np.arange(40), -score)) if score[k] > 0][:top]
    best = lexical.Best(0, top)
    for lo in range(0, 40, 10):
        part = range(lo, lo + 10)
        lengths = np.array([math.sqrt((xs[k] ** 2).sum()) for k in part])
        lexical.Bucket(np.arange(lo, lo + 10), lengths, sizes[lo:lo + 10], np.concatenate([terms[k] for k in part]),
                       np.concatenate([xs[k] for k in part])).search(query, best)
    assert best.id.tolist() == order and best.score.tolist() == score[order].tolist()
