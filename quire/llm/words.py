"""Words of whole texts as numbers, many texts at once.

A word is a run of characters other than ASCII punctuation, blanks and
controls, in which only A-Z become lower case; every character beyond ASCII
belongs to a word. Texts are cut in their UTF-8 bytes by array operations, so
no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ASCII = bytes(range(128))
_SEPARATORS = bytes(c for c in _ASCII if not chr(c).isalnum())
_FOLD = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))
_FOLD = bytes(_FOLD[c + 32] if 65 <= c <= 90 else _FOLD[c] for c in range(256))


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows whose texts in `column` have about `limit` bytes
    together; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    total = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, bounds, words): the texts' words in order as places in `words`,
    the distinct words, each followed by one space; text i has the codes
    bounds[i] to bounds[i + 1]. A null text has none."""
    nothing, blank = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    joined = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), nothing), nothing, blank)
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
    raw = np.frombuffer(bytes(memoryview(joined.buffers()[2])[offsets[0]:offsets[-1]]).translate(_FOLD), np.uint8)
    blank = raw == 32
    kept = ~blank
    kept[1:] |= ~blank[:-1]  # a word's bytes and the one blank after it
    packed = raw[kept]
    ends = np.flatnonzero(packed == 32) + 1
    before = np.concatenate([[0], np.cumsum(kept & blank)])
    bounds = before[offsets - offsets[0]]
    cuts = np.concatenate([[0], ends]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(packed)])
    found = words.dictionary_encode()
    return np.asarray(found.indices), bounds, found.dictionary


def words_of(text: str | None) -> list[bytes]:
    """The words of one text, as `coded` has them (with the space)."""
    codes, _, words = coded(pa.array([text], pa.string()))
    return [words[k].as_py() for k in codes.tolist()]
