"""Property checks: each generated example is a whole batch, run as one
Spark job and compared with a plain-Python model of the semantics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.operators import articles as A

WORDS = ["Java", "Java,", "JavaScript", "Scala", "scala", "C++", "C#", "", "x"]
SEPS = [" ", "  ", "\t", "\n", ", "]
VOCAB = ["Java", "Scala", "C++", "C#", "JavaScript"]

text = st.lists(st.tuples(st.sampled_from(WORDS), st.sampled_from(SEPS)), max_size=8).map(
    lambda parts: "".join(w + s for w, s in parts))


def model_counts(texts, vocab):
    return {t: sum(1 for x in texts if t in x.split(" ")) for t in vocab}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(text, min_size=0, max_size=30))
def test_rankings_match_model(spark, texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "title string, text string")
    want = model_counts(texts, VOCAB)
    got = A.rank_terms(df, VOCAB).collect()
    assert {r.term: r.n for r in got} == want
    counts = [r.n for r in got]
    assert counts == sorted(counts, reverse=True)
    assert [(r.term, r.n) for r in A.rank_terms_agg(df, VOCAB).collect()] == [(r.term, r.n) for r in got]
    idx = A.inverted_index(df, VOCAB).collect()
    assert sorted((r.term, r.title) for r in idx) == sorted(
        (t, str(i)) for i, x in enumerate(texts) for t in VOCAB if t in x.split(" "))


point = st.tuples(st.sampled_from([0, 100, 200]), st.integers(min_value=0, max_value=60))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(point, min_size=1, max_size=60), st.lists(point, min_size=1, max_size=5, unique=True))
def test_kmeans_matches_model(spark, pts, seeds):
    from test_clustering import brute_kmeans
    from quire.operators import clustering as K
    centers = [(i, x, y) for i, (x, y) in enumerate(seeds)]
    want = brute_kmeans(pts, centers, 5.0, 6)
    vec = spark.createDataFrame(pts, "x bigint, y bigint")
    res = K.kmeans(K.weighted_points(vec), centers, eta=5.0, max_iterations=6, checkpoint=False)
    assert ([c[1:] for c in res.centers], res.iterations, res.moved) == want


# --- posting lines ----------------------------------------------------------

def model_posting(line):
    """Plain-Python reading of one posting line: the parsed tuple, or None
    when the line is malformed."""
    f = line.split(",")
    if len(f) < 5:
        return None

    def num(s):
        return int(s) if s.lstrip("-").isdigit() else None
    t, i, s = num(f[0]), num(f[1]), num(f[4])
    opt = [None if f[k] == "" else num(f[k]) for k in (2, 3)]
    if None in (t, i, s) or any(f[k] != "" and opt[n] is None for n, k in enumerate((2, 3))):
        return None
    tag = f[5] if len(f) > 5 and f[5] != "" else None
    return (t, i, opt[0], opt[1], s, tag)


field = st.one_of(st.integers(-5, 99).map(str), st.just(""), st.sampled_from(["x", "Scala", "C#"]))
line = st.lists(field, min_size=2, max_size=8).map(",".join)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(line, min_size=1, max_size=25))
def test_posting_parse_matches_model(spark, lines):
    from quire.sources.lines import parse_postings
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, rejects = parse_postings(df, mode="permissive")
    want = [m for m in map(model_posting, lines) if m is not None]
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(r[0] for r in rejects.collect()) == sorted(x for x in lines if model_posting(x) is None)
    clean = [x for x in lines if model_posting(x) is not None]
    if clean:
        strict = parse_postings(spark.createDataFrame([(x,) for x in clean], "value string"))
        assert sorted(map(tuple, strict.collect()), key=repr) == sorted(want, key=repr)


# --- survey summary -----------------------------------------------------------

code = st.one_of(st.none(), st.integers(-2, 80))
minutes = st.one_of(st.none(), st.integers(0, 900).map(float))
respondent = st.tuples(code, code, code, minutes, minutes, minutes)


def model_summary(r):
    telfs, tesex, teage, p, w, o = r
    if telfs is None or telfs > 4:
        return None
    working = "working" if 1 <= telfs < 3 else "not working"
    sex = "male" if tesex == 1 else "female"
    age = ("young" if teage is not None and 15 <= teage <= 22
           else "active" if teage is not None and 23 <= teage <= 55 else "elder")
    hours = [None if m is None else m / 60 for m in (p, w, o)]
    return (working, sex, age, *hours)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(respondent, min_size=1, max_size=40))
def test_summary_matches_model(spark, data):
    from quire.operators import timeuse
    df = spark.createDataFrame([(f"r{i}", *r) for i, r in enumerate(data)],
                               "tucaseid string, telfs int, tesex int, teage int, "
                               "t010101 double, t050101 double, t020101 double")
    got = [tuple(r) for r in timeuse.time_usage_summary(df).collect()]
    want = [m for m in map(model_summary, data) if m is not None]
    assert sorted(got, key=repr) == sorted(want, key=repr)
