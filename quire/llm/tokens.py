"""Token ids of whole texts by the tokenizers library.

BPE never merges across pre-tokens, so a text's ids are those of its
pre-tokens in order. Texts whose characters all lie in `PLAIN` (where every
Unicode version agrees on letters, digits, spaces and case) are cut in their
bytes by array operations, many texts at once; each distinct piece is cut into
pre-tokens here, and each distinct pre-token is encoded by the library and
remembered by the worker. Any other text goes to the library whole. Both
ways give the same ids.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core

PLAIN = "\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ſ‐-‧€"
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
MEMO_ENTRIES = 250_000  # of each of two generations, about 70 MB a worker
TEXT_BYTES = 1 << 21  # of text whose pieces are looked up together

# The pre-token rules that the tokenizer files state, over PLAIN.
BYTE_LEVEL = rf" ?[{LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
WORD_LEVEL = rf"[{LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s{LETTERS}0-9]+"

CUT = "\x01"

# Where texts are cut: before a space, at both ends of a run of other white
# space, and before ASCII punctuation that follows an ASCII letter or digit.
# No pre-token of either rule reaches across such a place in a plain text, so
# every piece holds whole pre-tokens.
SPACE, BREAK, MARK, WORD = 1, 2, 3, 4
KINDS = np.zeros(256, np.uint8)
KINDS[33:127] = MARK
KINDS[[c for c in range(128) if chr(c).isalnum()]] = WORD
KINDS[[9, 10, 13]] = BREAK
KINDS[32] = SPACE


def pieces_of(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The first byte of each piece of texts that stand one after another from
    bounds[i] to bounds[i + 1]."""
    kinds = KINDS[raw]
    begin = kinds == SPACE
    broken = kinds == BREAK
    begin[1:] |= broken[1:] != broken[:-1]
    begin[1:] |= (kinds[1:] == MARK) & (kinds[:-1] == WORD)
    begin[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(begin)


_ENCODERS: dict[str, "Encoder"] = {}


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary:
    visible Latin-1 characters for themselves, the rest by rising codes from 256 on."""
    visible = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
    hidden = sorted(set(range(256)).difference(visible))
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.path = path
        loaded = self._load(path)
        self.lower, self.model = loaded.normalizer is not None, loaded.model
        self.pretokens = re.compile(WORD_LEVEL if self.lower else BYTE_LEVEL).findall
        self.bytes_as = byte_characters() | {1: CUT}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _load(path: str) -> Tokenizer:
        found = Tokenizer.from_file(path)
        found.encode_special_tokens = True  # their strings in a text are ordinary text
        return found

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """The tokenizer as it is, for texts that are not plain."""
        return self._load(self.path)

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each pre-token by the library's model, which takes them
        as byte characters; all are translated in one call."""
        known = CUT.join(words).encode().decode("latin-1").translate(self.bytes_as).split(CUT)
        return (array("I", [t.id for t in ids]).tobytes() for ids in map(self.model.tokenize, known))

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces of texts, each cut and encoded on its own."""
        if not pieces:
            return []
        if len(self.memo) > MEMO_ENTRIES:  # words unseen for a generation are forgotten
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        # read in one call, between marks that no plain text has
        marked = CUT.encode().join(pieces).decode()
        if self.lower:  # spaces belong to no pre-token
            marked = marked.lower().replace(CUT + " ", CUT).lstrip(" ")
        texts = marked.split(CUT)
        found = list(map(memo.get, texts))
        open_, parted, new = [], [], {}
        for i, ids in enumerate(found):
            if ids is None:
                text = texts[i]
                if (ids := older.get(text)) is not None:
                    memo[text] = found[i] = ids
                    continue
                parts = self.pretokens(text)
                open_.append(i)
                parted.append(parts)
                for w in parts:
                    if w not in memo:
                        if (ids := older.get(w)) is not None:
                            memo[w] = ids
                        else:
                            new[w] = None
        if new:
            memo.update(zip(new, self._words(list(new))))
        for i, parts in zip(open_, parted):
            found[i] = memo[parts[0]] if len(parts) == 1 else b"".join(map(memo.__getitem__, parts))
        return found

    def _plain(self, texts: pa.Array) -> list[bytes]:
        """The ids of plain texts: cut into pieces, one look at each distinct
        piece, and the pieces' ids gathered in text order."""
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        begin = pieces_of(raw, bounds)
        offsets = np.searchsorted(begin, bounds)
        cuts = np.append(begin, len(raw)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(cuts), pa.py_buffer(raw)]
                                      ).dictionary_encode()
        code, ids = np.asarray(coded.indices), self._pieces(coded.dictionary.to_pylist())
        # fewer ids than bytes of text, which an Arrow array counts in 32 bits
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        flat, begins = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes, dtype=np.int32) - sizes
        n = sizes[code]
        ends = np.zeros(len(code) + 1, np.int32)
        np.cumsum(n, out=ends[1:])
        at = np.repeat(begins[code] - ends[:-1], n)
        at += np.arange(len(at), dtype=np.int32)
        raw = flat[at].tobytes()
        cuts = (4 * ends[offsets].astype(np.int64)).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text in turn; a null text has none. About
        `TEXT_BYTES` of text are in work at a time."""
        texts = pc.fill_null(texts, "")
        total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < len(texts):
            before = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, before + TEXT_BYTES, "right")))
            yield from self._some(texts.slice(lo, hi - lo))
            pa.default_memory_pool().release_unused()  # the executor's memory bounds the worker's
            lo = hi

    def _some(self, texts: pa.Array) -> list[bytes]:
        odd = pc.match_substring_regex(texts, f"[^{PLAIN}]")
        if not self.lower:  # a space beside other white space doesn't begin a pre-token
            odd = pc.or_(odd, pc.match_substring_regex(texts, r" (?:\s|$)|[\t\n\r] "))
        odd = odd.to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._plain(texts)
        plain = iter(self._plain(texts.filter(pa.array(~odd))))
        whole = self.tokenizer.encode_batch_fast(texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)
        whole = iter([array("I", e.ids).tobytes() for e in whole])
        return [next(whole) if o else next(plain) for o in odd.tolist()]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on the machine that asks."""
    import public_tokenizers
    return public_tokenizers.path(name)
