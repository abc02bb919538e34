"""Each stage of the pipeline against a plain version, on what its predecessor kept."""

import zlib

import numpy as np

import corpus_pipeline
from quire.llm import langid, mixing, packing
from test_against_brute_force import SF, classes, plain_fingerprint, plain_ids


def rows(df):
    return [r.asDict() for r in df.collect()]


def by_id(found):
    return {r["doc_id"]: r for r in found}


def test_every_stage(spark):
    docs = corpus_pipeline.read_table(spark, SF, "documents")
    before, stages = rows(docs), dict(corpus_pipeline.STAGES)

    # language ID: rejected documents go, the others stay as they are
    kept = corpus_pipeline.scratch_table(stages["language_id"](spark, docs, SF), "kept")
    model = langid.fit(docs)
    want = [r for r in before if not model.predict([r["text"]])[0][2]]
    after = rows(kept)
    assert sorted(map(str, after)) == sorted(map(str, want)) and len(after) > 0.9 * len(before)

    # line dedup: what goes from a text are lines that an earlier text has
    lined = corpus_pipeline.scratch_table(stages["line_dedup"](spark, kept, SF), "lined")
    old, new = by_id(after), by_id(rows(lined))
    first = {}
    for i in sorted(old):
        for line in (old[i]["text"] or "").split("\n"):
            first.setdefault(line.strip(" \t\r\v\f"), i)
    for i, r in new.items():
        lines = (old[i]["text"] or "").split("\n")
        it = iter(lines)
        assert r["text"] in (None, old[i]["text"]) or all(line in it for line in r["text"].split("\n"))  # in order
        gone = set(lines) - set((r["text"] or "").split("\n"))
        assert all(not g.strip() or first[g.strip(" \t\r\v\f")] <= i for g in gone)
        assert {k: v for k, v in r.items() if k not in ("text", "n_chars")} == {
            k: v for k, v in old[i].items() if k not in ("text", "n_chars")}
    assert all(first[line.strip(" \t\r\v\f")] < i for i in set(old) - set(new)
               for line in old[i]["text"].split("\n") if line.strip())

    # near duplicates: the smallest id of each class of fingerprints
    single = corpus_pipeline.scratch_table(stages["simhash_near_dedup"](spark, lined, SF), "single")
    ids = sorted(new)
    fps = [plain_fingerprint(new[i]["text"]) for i in ids]
    near = [(a, b) for a in range(len(ids)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = sorted({ids[c] for c in classes(len(ids), near)})
    found = rows(single)
    assert sorted(r["doc_id"] for r in found) == want and all(r == new[r["doc_id"]] for r in found)

    # mixture: every document, and each source's share of the characters
    mixed = corpus_pipeline.scratch_table(stages["mix_sources"](spark, single, SF), "mixed")
    known, drawn = by_id(found), rows(mixed)
    assert {r["doc_id"] for r in drawn} == set(known) and all(r == known[r["doc_id"]] for r in drawn)
    size = {}
    for r in found:
        size[r["source"]] = size.get(r["source"], 0) + max(1, len(r["text"] or ""))
    got, longest = {}, max(len(r["text"] or "") for r in found)
    for r in drawn:
        got[r["source"]] = got.get(r["source"], 0) + max(1, len(r["text"] or ""))
    power = {s: n ** mixing.ALPHA for s, n in size.items()}
    for s in size:
        share = power[s] / sum(power.values())
        assert abs(got[s] - share * sum(got.values())) <= mixing.BLOCK_CHARS + longest

    # packing: the mixture's documents in order, each cut without a gap
    packed = rows(stages["pack"](spark, mixed, SF))
    packed.sort(key=lambda r: r["sequence_id"])
    assert [r["sequence_id"] for r in packed] == list(range(len(packed)))
    at, seen = 0, []
    while at < len(packed):
        ids_ = plain_ids(packing.TOKENIZER, packing.END_ID, known[packed[at]["doc_id"]]["text"])
        seen.append(packed[at]["doc_id"])
        start = 0
        for length in packing.piece_lengths(len(ids_)):
            r = packed[at]
            assert (r["doc_id"], r["start"], r["length"], r["doc_tokens"]) == (seen[-1], start, length, len(ids_))
            assert r["ids_crc32"] == zlib.crc32(np.ascontiguousarray(ids_[start:start + length]).tobytes())
            start, at = start + length, at + 1
    assert sorted(seen) == sorted(r["doc_id"] for r in drawn)
