"""Token counts by a linear longest-match automaton.

A trie of the vocabulary, with a failure link and the number of tokens popped
along it at every node, gives the number of greedy word pieces of a word in
one pass over its characters, without building the pieces. Pieces that start
a word hang from one root, pieces that continue one from another.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import map_arrow
from quire.llm.tokens import tokenizer_path

VOCABULARY = "piece_bpe_32k.model"
WORD_START = "▁"
UNKNOWN = -1
MEMO_ENTRIES = 500_000
START, SUFFIX = 0, 1

_COUNTERS: dict[str, "Counter"] = {}


class Automaton:
    """Greedy longest-match piece counts over (initial, continuing) pieces."""

    def __init__(self, initial: Iterable[str], continuing: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        self.fail: list[int] = [-1, -1]
        self.popped: list[int] = [0, 0]
        whole: set[int] = set()
        for root, pieces in ((START, initial), (SUFFIX, continuing)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        self.fail.append(-1)
                        self.popped.append(0)
                    node = self.next[node][c]
                if node != root:
                    whole.add(node)
        # by depth: a node's link needs only links of shallower nodes
        queue = deque([START, SUFFIX])
        while queue:
            parent = queue.popleft()
            for c, node in self.next[parent].items():
                queue.append(node)
                if node in whole:
                    self.fail[node], self.popped[node] = SUFFIX, 1
                    continue
                at, popped = self.fail[parent], self.popped[parent]
                while at >= 0 and c not in self.next[at]:
                    popped += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.next[at][c], popped

    def count(self, word: str) -> int:
        """Pieces of a word, or UNKNOWN if greedy matching gets stuck."""
        node, pieces = START, 0
        step, fail, popped = self.next, self.fail, self.popped
        for c in word:
            while c not in step[node]:
                if fail[node] < 0:
                    return UNKNOWN
                pieces += popped[node]
                node = fail[node]
            node = step[node][c]
        while node > SUFFIX:
            if fail[node] < 0:
                return UNKNOWN
            pieces += popped[node]
            node = fail[node]
        return pieces


class Counter(dict):
    """Counts by word, computed by the automaton when first asked for."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        found = self[word] = self.automaton.count(word)
        return found


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """(initial, continuing) pieces of a sentencepiece model's vocabulary."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return ([p[1:] for p in pieces if p.startswith(WORD_START) and WORD_START not in p[1:] and len(p) > 1],
            [p for p in pieces if WORD_START not in p])


def counter(name: str) -> Counter:
    if name not in _COUNTERS:
        _COUNTERS[name] = Counter(Automaton(*vocabulary(tokenizer_path(name))))
    return _COUNTERS[name]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary_name: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) per row of `docs`.

    Words are runs of characters outside ASCII white space; a word that greedy
    matching cannot cover is one unknown token. A null or empty text has none.
    Repeated rows and rows with a null doc_id are counted like any other. An
    empty table gives no rows. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(vocabulary_name).__getitem__
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column(1).to_pylist():
                # bytes.split knows ASCII white space only
                own = list(map(counts, [w.decode() for w in text.encode().split()])) if text else []
                stuck = own.count(UNKNOWN)
                words.append(len(own))
                unknown.append(stuck)
                tokens.append(sum(own) + (1 - UNKNOWN) * stuck)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                ["doc_id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(rows, run, "doc_id long, n_words long, n_tokens long, n_unknown long")
