"""Language ID by nearest centroid.

A text is a vector of byte 2- and 3-grams over its lower-cased letters,
hashed to `DIMS` places, weighted by TF-IDF and normalised. Each language has
several centroids, clustered from a bounded sample of its labelled texts, and
a text takes the language of the centroid with the highest cosine. A text
farther from its centroid than almost all of that language's sample is
rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import map_arrow, scratch_table

DIMS = 1 << 13
CENTROIDS = 3
ROUNDS = 8
#: Labelled texts drawn per language to fit the classifier, at most.
PER_LANGUAGE = 1000
#: Rows of languages' counts that are broadcast, by count.
BROADCAST_LANGUAGES = 100_000
#: A text is rejected when its cosine is under this share of the lowest
#: percentile of its language's sample. A text of fewer than `FULL` different
#: grams can't come as near, so its limit shrinks with the root of their number.
REJECT_SHARE = 0.5
FULL = 100
TEXTS_AT_ONCE = 128

_LETTER = re.compile(r"[^\W\d_]").search
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)


def grams(text: str) -> np.ndarray:
    """Places of the 2- and 3-grams of a text's words, spaces at word ends."""
    folded = _FOLD[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    folded = folded[np.concatenate([[True], (folded[1:] != 32) | (folded[:-1] != 32)])].astype(np.uint32)
    two = folded[:-1] * np.uint32(256) + folded[1:]
    three = two[:-1] * np.uint32(256) + folded[2:]
    hashed = np.concatenate([two * np.uint32(2654435761), (three + np.uint32(1 << 24)) * np.uint32(2654435761)])
    return (hashed >> np.uint32(32 - DIMS.bit_length() + 1)).astype(np.int64)


def weights(texts: list[str | None]) -> np.ndarray:
    """1 + ln(count) of each place, a row per text."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for row, text in enumerate(texts):
        if text:
            counts = np.bincount(grams(text), minlength=DIMS)
            at = np.flatnonzero(counts)
            out[row, at] = 1 + np.log(counts[at])
    return out


def normalised(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(size > 0, size, 1)


def cluster(x: np.ndarray, k: int = CENTROIDS) -> np.ndarray:
    """Spherical k-means from a farthest-first start; rows of x are unit vectors."""
    picks = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(picks) < min(k, len(x)):
        picks.append(int(np.argmin((x @ x[picks].T).max(axis=1))))
    centres = x[picks]
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        centres = normalised(np.stack([x[own == c].sum(axis=0) if (own == c).any() else centres[c]
                                       for c in range(len(centres))]))
    return centres


class Model:
    """Languages in order, their centroids (a row each) and least cosines."""

    def __init__(self, idf: np.ndarray, langs: list[str], centres: np.ndarray, least: np.ndarray):
        self.idf, self.langs, self.centres, self.least = idf, langs, centres, least

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) per text; `und` is always rejected."""
        worded = np.array([bool(t) and _LETTER(t) is not None for t in texts], bool)
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        if not self.langs or not worded.any():
            return out
        rows = np.flatnonzero(worded)
        x = weights([texts[r] for r in rows])
        cosines = normalised(x * self.idf) @ self.centres.T
        best = np.argmax(cosines, axis=1)  # the first language wins ties
        limits = self.least[best] * np.sqrt(np.minimum(1, np.count_nonzero(x, axis=1) / FULL))
        for r, b, c, limit in zip(rows.tolist(), best.tolist(), cosines[np.arange(len(rows)), best].tolist(),
                                  limits.tolist()):
            out[r] = (self.langs[b], min(1.0, max(0.0, c)), c < limit)
        return out


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text) of at most PER_LANGUAGE labelled training texts a language:
    the lowest hashes of all texts that are not held out."""
    c = {"doc_id": F.col(f"`{id_col}`"), "text": F.col(f"`{text_col}`"), "lang": F.col(f"`{lang_col}`")}
    rows = docs.select(*[v.alias(k) for k, v in c.items()]).where(
        "lang is not null and text is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    # a hash threshold per language leaves few texts to shuffle; the row number then holds the bound
    counts = scratch_table(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    if counts.count() <= BROADCAST_LANGUAGES:  # else the texts meet their languages' counts in a shuffle
        counts = F.broadcast(counts)
    share = (F.col("h") / F.lit(2.0 ** 64) + 0.5) * F.col("n")
    near = rows.join(counts, "lang").where(share <= 1.5 * PER_LANGUAGE)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", F.xxhash64("text")))
    return near.withColumn("_n", first).where(f"_n <= {PER_LANGUAGE}").select("lang", "text")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model, from a bounded sample of the rows that are not held out. It
    holds every language, in CENTROIDS * DIMS * 4 bytes each."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(lo, TEXTS_AT_ONCE)
                x = weights(part.column(1).to_pylist())
                places = [np.flatnonzero(row).astype(np.int32) for row in x]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([p.tolist() for p in places], pa.list_(pa.int32())),
                     pa.array([row[p].tolist() for row, p in zip(x, places)], pa.list_(pa.float32()))],
                    ["lang", "place", "weight"])

    sample = scratch_table(map_arrow(training_rows(docs, id_col, text_col, lang_col), spread,
                                     "lang string, place array<int>, weight array<float>"), "language-sample")
    n = sample.count()
    found = sample.select(F.explode("place").alias("place")).groupBy("place").count().collect()
    idf = np.zeros(DIMS, np.float32)
    for place, count in found:  # at most DIMS rows
        idf[place] = np.log((1 + n) / (1 + count)) + 1

    def centres(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(rows), DIMS), np.float32)
        for i, (place, weight) in enumerate(zip(rows["place"], rows["weight"])):
            x[i, np.asarray(place, np.int64)] = weight
        x = normalised(x * idf)
        c = cluster(x)
        own = np.percentile((x @ c.T).max(axis=1), 1)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "k": range(len(c)),
                             "centre": [v.astype("<f4").tobytes() for v in c], "least": REJECT_SHARE * float(own)})

    rows = sorted(sample.groupBy("lang").applyInPandas(centres, "lang string, k int, centre binary, least double")
                  .collect(), key=lambda r: (r["lang"], r["k"]))
    matrix = np.array([np.frombuffer(r["centre"], "<f4") for r in rows], np.float32).reshape(len(rows), DIMS)
    return Model(idf, [r["lang"] for r in rows], matrix, np.array([r["least"] for r in rows]))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(lo, TEXTS_AT_ONCE)
                lang, score, rejected = zip(*model.predict(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang), pa.array(score, pa.float64()), pa.array(rejected)],
                    ["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(rows, run, "doc_id long, lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs`, all columns, that the model does not reject."""
    model = fit(docs, id_col, text_col, lang_col)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep: list[bool] = []
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                found = model.predict(batch.column(place).slice(lo, TEXTS_AT_ONCE).to_pylist())
                keep += [not rejected for _, _, rejected in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) per row of `docs`.

    The model learns only from texts with a language whose crc32(doc_id) mod 5
    is not 0. A text that is null or has no letter is `und` with score 0, as
    is every text when nothing could be learned. A null doc_id is neither held
    out nor learned from. Repeated rows are predicted one by one; the first
    language in order wins a tie. An empty table gives no rows. Other columns
    are not read.
    """
    predicted = predict(docs, fit(docs, id_col, text_col, lang_col), id_col, text_col)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
