"""Each operator's query on the small shared tables against a plain version."""

import collections
import functools
import html
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quire.llm import lines, mixing, simple8b, tokens, webtext, wordpiece
from quire.llm.common import components
from quire.llm.queries import QUERIES
from quire.llm.tokens import PLAIN, encoder, tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def docs():
    return {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def result(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF).collect()]


@functools.cache
def whole_tokenizer(name):
    t = Tokenizer.from_file(tokenizer_path(name))
    t.encode_special_tokens = True
    return t


def plain_ids(name, end, text):
    t = whole_tokenizer(name)
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def classes(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(i) for i in range(n)]


def test_packing(spark, docs):
    by = collections.defaultdict(list)
    for r in result(spark, "op1_packing"):
        by[r["doc_id"]].append(r)
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024 and r["offset"] == 0
    sequences = [r["sequence_id"] for rows in by.values() for r in rows]
    assert len(set(sequences)) == len(sequences)
    for doc_id, d in docs.items():
        ids, at = plain_ids("byte_bpe_50k.json", 0, d["text"]), 0
        for r in sorted(by[doc_id], key=lambda r: r["start"]):
            piece = ids[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece.tobytes()))
            at += r["length"]
        assert at == len(ids)


def test_token_files(spark, docs):
    want, start = [], 0
    for doc_id in sorted(docs):
        ids = plain_ids("word_bpe_49k.json", 2, docs[doc_id]["text"])
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r.values()) for r in result(spark, "op7_simple8b_ids")) == want


def whole_texts(t, texts):
    return [np.array(t.tokenizer.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@settings(max_examples=300, deadline=None)
@given(text=st.text(st.one_of(st.sampled_from("  \n\n\t\x01!'sStTrRvVeElL1²İſéÉ<|>."), st.characters(codec="utf-8")), max_size=40))
def test_ids_equal_the_librarys(name, text):
    t = encoder(tokenizer_path(name))
    texts = [text, "a b", None, text + " b", "", f"b {text}"]
    assert list(t.encode(pa.array(texts))) == whole_texts(t, texts)


def test_plain_characters_one_by_one():
    every = [chr(c) for c in range(0x2100) if re.fullmatch(f"[{PLAIN}]", chr(c))]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        t = encoder(tokenizer_path(name))
        texts = [f"a{c}b {c}{c} 1{c}2 '{c}" for c in every]
        assert list(t.encode(pa.array(texts))) == whole_texts(t, texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_when_words_are_forgotten(name, docs, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 50)
    monkeypatch.setattr(tokens, "TEXT_BYTES", 5000)
    t = tokens.Encoder(tokenizer_path(name))
    texts = [docs[k]["text"] for k in sorted(docs)]
    assert list(t.encode(pa.array(texts, pa.string()))) == whole_texts(t, texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**32 - 1),
                          st.sampled_from([2**k - d for k in range(1, 33) for d in (1, 2)])), max_size=3000))
def test_simple8b_round_trip(values):
    ids = np.array(values, np.uint32)
    segment = simple8b.Segment(simple8b.pack_segment([7, None], [len(ids), 0], ids))
    assert (segment.ids() == ids).all()
    blocks = [segment.block(k) for k in range(-(-len(ids) // simple8b.BLOCK))]
    assert np.concatenate([ids[:0], *blocks]).tolist() == ids.tolist()


def plain_fingerprint(text):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs):
    ids = sorted(docs)
    fps = [plain_fingerprint(docs[i]["text"]) for i in ids]
    near = [(a, b) for a in range(len(ids)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = [(ids[k], f"{fps[k]:016x}", ids[c]) for k, c in enumerate(classes(len(ids), near))]
    assert sorted(tuple(r.values()) for r in result(spark, "op4_simhash_near_dedup")) == want


def test_quality_statistics(spark, docs):
    for r in result(spark, "op5_robust_outliers"):
        text = docs[r["doc_id"]]["text"]
        w, rows = re.findall(WORD, text), [x for x in text.split("\n") if re.search(WORD, x)]
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        repeated = {k + j for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for j in range(3)}
        failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
        n_symbols = len(re.findall(r"[#*$%&|<>]", text))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) \
            == (len(w), sum(map(len, w)), n_symbols, len(rows) - len(set(rows)), len(repeated), failed)
        assert r["kept"] == (not failed and n_symbols < 0.2 * len(w))  # the table's junk is full of symbols


def test_language_id(spark, docs):
    found = result(spark, "op10_language_id")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    held = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in found if r["held_out"]]
    assert np.mean(held) > 0.95 and all(0 <= r["score"] <= 1 for r in found)


def test_token_counts(spark, docs):
    initial, continuing = map(set, wordpiece.vocabulary(tokenizer_path(wordpiece.VOCABULARY)))

    def greedy(word):
        n = at = 0
        while at < len(word):
            at = next((e for e in range(len(word), at, -1) if word[at:e] in (continuing if at else initial)), -1)
            if at < 0:
                return None
            n += 1
        return n

    for r in result(spark, "op6_token_counts"):
        counts = [greedy(w) for w in re.findall(WORD, docs[r["doc_id"]]["text"])]
        assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (
            len(counts), sum(1 if c is None else c for c in counts), counts.count(None))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=4)), st.lists(st.text("ab", min_size=1, max_size=4)),
       st.text("abc", min_size=1, max_size=12))
def test_automaton_is_greedy(initial, continuing, word):
    n = at = 0
    while at < len(word) and n >= 0:
        pieces = continuing if at else initial
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), -1)
        at, n = (end, n + 1) if end > 0 else (len(word), wordpiece.UNKNOWN)
    assert wordpiece.Automaton(initial, continuing).count(word) == n


def test_main_text(spark):
    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    for r in result(spark, "op3_html_main_text"):
        body = re.search(r"<article>(.*?)(?:</article>|$)", pages[r["page_id"]], re.S)[1]
        body = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))
        want = " ".join(html.unescape(body).split())
        assert (r["text"], r["n_chars"]) == (want, len(want))


def test_undeclared_boilerplate_goes_by_its_repeats(spark):
    menu = "home products about us contact imprint press jobs blog help"
    rows = [(i, "http://h.example/x", f"<div>{menu}</div><div>{' '.join(f'w{i}x{k}' for k in range(20))}</div>")
            for i in range(30)]
    for r in webtext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert r["text"] == " ".join(f"w{r['page_id']}x{k}" for k in range(20))


def test_zones():
    page = ("<header>h</header><div class='cookie-notice'>n</div><main><article><h1>T</h1>a<b>b</b> c"
            "<div id=comments><article>reader</article></div><form>f</form></article></main><script>if(a<b){}</script>")
    assert [t for z, t in webtext.blocks(page) if z == webtext.ARTICLE] == ["T", "ab c"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), max_size=60))
def test_repeats_against_counting(a, b):
    pages = [np.array(x, np.uint64) + np.uint64(1) for x in (a, b)]
    seen = collections.defaultdict(set)
    for k, p in enumerate(pages):
        for i in range(len(p) - webtext.RUN + 1):
            seen[int(webtext.window_hashes(p, np.array([i]))[0])].add(k)
    hashes, n = webtext.repeats(pages)
    assert dict(zip(hashes.tolist(), n.tolist())) == {h: len(s) for h, s in seen.items() if len(s) > 1}


def test_embeddings(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet")
    x = np.array(table["embedding"].to_pylist(), float)
    x[1], x[2] = x[0] * 2, x[0] + 0.02 * x[3]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    ids = table["vec_id"].to_pylist()
    roots = classes(len(u), np.argwhere(near).tolist())
    want = [(ids[k], int(near[k].sum()), ids[roots[k]], roots[k] == k) for k in range(len(u))]
    from quire.llm import embeddings
    frame = spark.createDataFrame(list(zip(ids, x.tolist())), "vec_id long, embedding array<double>")
    assert sorted(map(tuple, embeddings.near_duplicates(frame).collect())) == want
    assert len(result(spark, "op8_embedding_near_dedup")) == len(ids)


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (502, 501)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500, 502: 500}


def test_line_dedup(spark, docs):
    first = {}
    for i in sorted(docs):
        for s in docs[i]["text"].split("\n"):
            first.setdefault(s.strip(" \t\r\v\f"), i)
    for r in result(spark, "op9_line_dedup"):
        before, after = docs[r["doc_id"]]["text"].split("\n"), r["text"].split("\n")
        gone = collections.Counter(before) - collections.Counter(after)
        assert all(not s.strip() or first[s.strip(" \t\r\v\f")] <= r["doc_id"] for s in gone)
        assert r["n_lines"] == len(before) and r["n_removed"] in (sum(gone.values()), sum(gone.values()) + (r["text"] == ""))


def test_line_dedup_of_blocks_and_hot_lines(spark):
    shared = ["This passage of the text is shared by two documents.", "And so is the line that follows it here."]
    hot = "A license line that very many of the documents have in common."
    rows = [(i, "\n".join([f"Document number {i} begins in its own words.", hot, f"and ends so, {i}"])) for i in range(40)]
    rows += [(50, "\n".join(["opening", *shared, "closing"])), (51, "\n".join(["another opening", *shared, "end"]))]
    rows += [(60, rows[0][1])]
    found = {r["doc_id"]: r["text"] for r in lines.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0] == rows[0][1] and found[50] == rows[40][1]
    assert all(hot not in found[i] and f"and ends so, {i}" in found[i] for i in range(1, 40))
    assert found[51] == "another opening\nend" and found[60] == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=25), st.lists(st.integers(0, 9), max_size=25))
def test_patience_aligns(a, b):
    found = lines.patience(a, b)
    assert all(a[i] == b[j] for i, j in found)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))
    assert a != b or len(found) == len(a)


def plain_schedule(weights, counts):
    """Slot by slot: of the released blocks, the one with the earliest deadline."""
    total, sent, out = sum(weights), [0] * len(weights), []
    while len(out) < sum(counts):
        ready = [i for i, n in enumerate(counts) if sent[i] < n and sent[i] * total // weights[i] <= len(out)]
        if ready:
            i = min(ready, key=lambda i: (-(-(sent[i] + 1) * total // weights[i]), i))
        else:
            i = min((k for k, n in enumerate(counts) if sent[k] < n), key=lambda k: (sent[k] * total // weights[k], k))
        sent[i] += 1
        out.append(i)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(1e-3, 1e3), min_size=1, max_size=12), st.integers(1, 400))
def test_schedule_against_a_plain_one(given_weights, slots):
    weights = mixing.whole_weights(given_weights)
    counts = [-(-slots * w // sum(weights)) for w in weights]
    found = mixing.schedule(weights, counts)
    order = plain_schedule(weights, counts)
    assert found == [[t for t, k in enumerate(order) if k == i] for i in range(len(weights))]


@pytest.mark.parametrize("given_weights", [
    [0.501] + [0.499 / 399] * 399, [0.9] + [0.1 / 99] * 99, [1e-6, 1.0], [1 / 3] * 3, [3.0]])
def test_deviation_from_the_given_weights_is_under_a_block(given_weights):
    weights, slots = mixing.whole_weights(given_weights), 5000
    found = mixing.schedule(weights, [-(-slots * w // sum(weights)) for w in weights])
    t = np.arange(1, slots + 1)
    for w, own in zip(given_weights, found):
        served = np.searchsorted(own, t)  # slots before t
        assert (np.abs(served - w / sum(given_weights) * t) < 1 + 1e-6).all()


def test_small_sources_beyond_the_bound_are_pooled(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    rows = [(i, "x" * (50 if i % 12 > 2 else 500), f"s{i % 12}") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(frame, block_chars=200).collect()
    assert {r["doc_id"] for r in found} == set(range(600))
    assert all(r["slot"] is not None for r in found)


def test_mixture(spark, docs):
    found = result(spark, "op2_pfair_mixing")
    assert {r["doc_id"] for r in found} == set(docs)
    assert all(r["slot"] < r["deadline"] for r in found)
    size, order = collections.Counter(), collections.defaultdict(list)
    for r in found:
        size[r["source"]] += max(1, len(docs[r["doc_id"]]["text"] or "")) * (r["copy"] == 0)
        order[r["source"]].append(r)
    for source, rows in order.items():
        at = 0
        for r in sorted(rows, key=lambda r: r["position"]):
            assert r["position"] == at and r["block"] == at // mixing.BLOCK_CHARS
            at += max(1, len(docs[r["doc_id"]]["text"] or ""))


def test_given_weights_hold(spark):
    rows = [(i, "x" * 100, "big" if i % 10 else "small") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(frame, {"big": 3.0, "small": 1.0}, block_chars=200)
    share = collections.Counter(r["source"] for r in mixed.collect())
    assert abs(share["small"] / sum(share.values()) - 0.25) < 0.01
    with pytest.raises(ValueError):
        mixing.mix(frame, {"big": 1.0})
