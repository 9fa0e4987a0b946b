"""Token counts by a linear longest-match automaton.

The vocabulary is a byte trie. Each node has a failure link and, computed once,
the number of tokens that are popped on the way along it; greedy longest-match
word pieces are counted in one pass over a word's bytes and none is built.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, ship
from .tokens import Memo, vocabulary

#: Byte-level vocabularies write bytes that are no printable characters as these.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_alphabet() -> dict[str, int]:
    rest = [b for b in range(256) if b not in PRINTABLE]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


def word_pieces(path: str) -> tuple[list[bytes], list[bytes]]:
    """(pieces that begin a word, pieces that go on in it) of a byte-level vocabulary:
    tokens with the space before them begin words, all others go on in them. Those of the
    others that no such token begins, too, may begin a word, as after a lone space."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    letters = byte_alphabet()
    begin, inner = [], []
    for token in vocab:
        raw = bytes(letters[c] for c in token) if all(c in letters for c in token) else b""
        if raw[:1] == b" " and len(raw) > 1:
            begin.append(raw[1:])
        elif raw and raw != b" ":
            inner.append(raw)
    spaced = set(begin)
    begin += [w for w in inner if not any(w[:k] in spaced for k in range(1, len(w) + 1))]
    return begin, inner


class LongestMatch:
    """count(word): greedy longest-match pieces, or None if some rest of it matches none."""

    def __init__(self, begin: list[bytes], inner: list[bytes]):
        # node 0: begin of a word, node 1: begin of a further piece
        self.child: list[dict[int, int]] = [{}, {}]
        token = [False, False]
        order: list[tuple[int, int, int]] = []
        for root, words in ((0, begin), (1, inner)):
            for w in words:
                at = root
                for b in w:
                    nxt = self.child[at].get(b)
                    if nxt is None:
                        nxt = len(self.child)
                        self.child[at][b] = nxt
                        self.child.append({})
                        token.append(False)
                    at = nxt
                token[at] = True
        # failure links and popped counts, breadth first; -1: nothing matches
        self.fail, self.popped = [-1] * len(self.child), [0] * len(self.child)
        level = [0, 1]
        while level:
            below = []
            for u in level:
                for b, v in self.child[u].items():
                    below.append(v)
                    if token[v]:
                        self.fail[v], self.popped[v] = 1, 1
                        continue
                    z, n = self.fail[u], self.popped[u]
                    while z >= 0 and b not in self.child[z]:
                        z, n = self.fail[z], n + self.popped[z]
                    if z >= 0:
                        self.fail[v], self.popped[v] = self.child[z][b], n
            level = below
        self.fail[1] = -1

    def count(self, word: bytes) -> int | None:
        at, n = 0, 0
        child, fail, popped = self.child, self.fail, self.popped
        for b in word:
            while b not in child[at]:
                n += popped[at]
                at = fail[at]
                if at < 0:
                    return None
            at = child[at][b]
        while at > 1:
            n += popped[at]
            at = fail[at]
            if at < 0:
                return None
        return n


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Memo:
    automaton = LongestMatch(*word_pieces(path))

    def count(word: bytes) -> tuple[int, int]:
        n = automaton.count(word)
        return (1, 1) if n is None else (n, 0)

    return Memo(count, 400_000)


def count_tokens(docs: DataFrame, vocab: str) -> DataFrame:
    """Per row: doc_id, n_words, n_tokens, n_unknown.

    Words stand between ASCII white space. A word that begins with no token with the space
    before it is spelled by the others from its first byte on; the lone space before it
    is not counted, as no space is. A word that the vocabulary can't spell counts as one
    unknown token: none where each byte is a token. Null and empty texts have 0 of each; long texts are
    counted whole; repeated rows each count; other columns don't matter.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            memo = counter(vocab)
            rows = []
            for text in batch.column(1).cast(pa.large_binary()):
                words = (text.as_py() or b"").split()
                found = np.array([memo[w] for w in words], np.int64).reshape(-1, 2)
                rows.append((len(words), *found.sum(0).tolist()))
            n = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(n[:, i]) for i in range(3))], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the counts of every document; see count_tokens."""
    return count_tokens(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
