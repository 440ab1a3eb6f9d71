"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary becomes a byte trie.  Where a word cannot go on from a node,
the node's failure link leads to the node that stands for what is left after
the greedy pieces on the way are taken, and a stored number says how many
pieces that takes off.  A word is thus read once from left to right and its
count comes from sums of stored numbers; no piece is ever built.

Words are runs without ASCII white space and are matched with a leading blank,
as byte-level vocabularies write word starts.

Defined results: a null or empty text has no words and no tokens; a word that
the vocabulary cannot spell counts as one token and as unknown; repeated rows
get one result each; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, slices, table
from eventstar.llm.packing import byte_of_char, default_tokenizer

NONE = -1


class LongestMatch:
    """The automaton over byte pieces."""

    def __init__(self, pieces: Iterable[bytes], keep: int = 500_000) -> None:
        step: dict[int, int] = {}                  # node * 256 + byte -> node
        is_piece, parent, by = [False], [NONE], [0]
        for piece in pieces:
            node = 0
            for b in piece:
                nxt = step.get(node << 8 | b)
                if nxt is None:
                    nxt = step[node << 8 | b] = len(parent)
                    parent.append(node)
                    by.append(b)
                    is_piece.append(False)
                node = nxt
            is_piece[node] = bool(piece)
        self.step = step
        self.fail, self.popped = [NONE] * len(parent), [0] * len(parent)
        depth = [0] * len(parent)
        for v in range(1, len(parent)):            # a parent precedes its children
            depth[v] = depth[parent[v]] + 1
        for v in sorted(range(1, len(parent)), key=depth.__getitem__):
            if is_piece[v]:                        # the whole path is one piece
                self.fail[v], self.popped[v] = 0, 1
                continue
            u, b = parent[v], by[v]
            taken, z = self.popped[u], self.fail[u]
            while z != NONE and z << 8 | b not in step:
                taken += self.popped[z]
                z = self.fail[z]
            if z != NONE:
                self.fail[v], self.popped[v] = step[z << 8 | b], taken
        self.known: dict[bytes, int] = {}
        self.keep = keep

    def count(self, word: bytes) -> int:
        """Pieces of ``word`` by greedy longest match, NONE if there are none."""
        step, fail, popped = self.step, self.fail, self.popped
        node = total = 0
        for b in word:
            nxt = step.get(node << 8 | b)
            while nxt is None:
                total += popped[node]
                node = fail[node]
                if node == NONE:
                    return NONE
                nxt = step.get(node << 8 | b)
            node = nxt
        while node:
            total += popped[node]
            node = fail[node]
            if node == NONE:
                return NONE
        return total

    def counts(self, words: list[bytes]) -> list[int]:
        """``count`` of each word after a blank; counts of words seen are kept."""
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.count(b" " + w)
        return list(map(known.__getitem__, words))


def pieces_of(path: str) -> list[bytes]:
    """The byte pieces of a byte-level vocabulary file."""
    at = byte_of_char()
    vocab = json.loads(Path(path).read_text())["model"]["vocab"]
    return [bytes(at[c] for c in p) for p in vocab
            if all(c in at for c in p) and not p.startswith("<|endoftext")]


_AUTOMATA: dict[str, LongestMatch] = {}


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every document.  The vocabulary
    is read once on the driver; each Python worker builds its automaton once."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(pieces_of(vocabulary_path))

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if vocabulary_path not in _AUTOMATA:
            _AUTOMATA[vocabulary_path] = LongestMatch(vocabulary.value)
        automaton = _AUTOMATA[vocabulary_path]
        for part in slices(batch, "text"):
            n_words, n_tokens, n_unknown = [], [], []
            for text in part.column(1).to_pylist():
                counts = automaton.counts((text or "").encode().split())
                bad = counts.count(NONE)
                n_words.append(len(counts))
                n_unknown.append(bad)
                n_tokens.append(sum(counts) + 2 * bad)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, pa.int64()) for c in (n_words, n_tokens, n_unknown))],
                ["doc_id", "n_words", "n_tokens", "n_unknown"])
    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), count,
                     "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document, 50k byte-level vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"), default_tokenizer())
