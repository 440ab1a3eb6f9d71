"""Best-fit packing of token sequences by bin completion.

A document is tokenized, closed with id 0, and cut into pieces of at most
``CAPACITY`` tokens if it is longer (only its first piece may then be
shorter).  Lengths are integers from 1 to the capacity, so the packing
problem is fully described by a histogram of at most ``CAPACITY`` counts,
whatever the number of documents.  The histogram is solved by bin completion:

* around the longest unpacked length, enumerate the undominated fillings of
  the rest of the sequence, least waste first (a filling is dominated if a
  length left over can replace some of its parts and fill more, or as much
  with fewer parts; an exact single part dominates all);
* branch over the fillings and over how often they are used, most often first;
  prune a branch whose waste leaves no room to beat the incumbent, which
  best-fit decreasing provides first;
* stop when the incumbent meets the lower bound or the search has made
  ``MAX_STEPS`` steps.

The result is a list of patterns with repeat counts.  Pieces find their place
from their rank among the pieces of the same length; ranks are counted in
blocks, so that no task holds all pieces of a common length.

Defined results: a null or empty text is one piece holding id 0 alone; rows
that repeat a doc_id are separate documents; extra columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, deque
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, materialize, slices, table

CAPACITY = 2048
#: Steps of the search (of enumeration, too).  Beyond them the best packing
#: found stands; it is whole and valid, but not proven least.
MAX_STEPS = 6_000_000
#: Tables of the search that are kept, of up to 0.6 MB each.
KEPT = 64
_LENGTHS = list(range(CAPACITY + 1))

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# ---------------------------------------------------------------- tokens

def byte_of_char() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for bytes:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Ids of texts by a byte-level BPE file of the tokenizers library.

    In such a file a merged piece has the id after the piece merged before it,
    so the ids are merge ranks, and tiktoken yields the same ids several times
    faster (the tests compare the two).  The pre-token pattern starts a new
    pre-token at every blank that follows a non-blank: a text is the
    concatenation of its blank-led chunks, and the ids of a chunk are kept for
    its next occurrence.  Texts with other runs of white space are encoded
    whole.
    """

    def __init__(self, path: str, keep: int = 150_000) -> None:
        import public_tokenizers
        import tiktoken

        file = json.loads(Path(path).read_text())
        model = file["model"]
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        at = byte_of_char()
        ranks = {bytes(at[c] for c in piece): i for piece, i in model["vocab"].items()
                 if all(c in at for c in piece)}
        ranks = {piece: i for piece, i in ranks.items() if i not in special.values()}
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                                     mergeable_ranks=ranks, special_tokens=special)
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, i in ranks.items():
            self.width[i] = len(piece)
        self.kept: dict[str, bytes] = {}            # ids of " " + chunk
        self.keep = keep
        self.odd = re.compile("|".join([r"\s ", *map(re.escape, special)]))

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of each " " + chunk: all in one call, cut at the chunks' ends."""
        text = " " + " ".join(chunks)
        ids = np.asarray(self.bpe.encode_to_numpy(text, disallowed_special=()), "<u4")
        ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) + 1 for c in chunks])
        cuts = [0, *np.searchsorted(np.cumsum(self.width[ids]), ends, "left") + 1]
        raw = ids.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.bpe.encode_to_numpy(text, allowed_special="all"), "<u4").tobytes()

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        heads, rests = [], []
        for t in texts:
            if self.odd.search(t):
                heads.append(t)
                rests.append([])
            else:
                head, *rest = t.split(" ")
                heads.append(head)
                rests.append(rest)
        new = list({c for r in rests for c in r}.difference(self.kept))
        if len(self.kept) + len(new) > self.keep:
            self.kept = {}
            new = list({c for r in rests for c in r})
        for i in range(0, len(new), 20_000):
            block = new[i:i + 20_000]
            self.kept.update(zip(block, self._encode(block), strict=True))
        get = self.kept.__getitem__
        return [np.frombuffer((self._whole(h) if h else b"") + b"".join(map(get, r)), "<u4")
                for h, r in zip(heads, rests, strict=True)]


_TOKENS: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def cut(ids: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``ids``: whole capacities from the
    end, the rest first."""
    n = len(ids)
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(s, min(e, n) - s) for s, e in zip(starts, [*starts[1:], n], strict=True)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its document, place and checksum."""
    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tok = tokens(tokenizer_path)
        for part in slices(batch, "text", 1 << 20):
            rows = []
            ids_of = tok.batch([t or "" for t in part.column(1).to_pylist()])
            for doc_id, ids in zip(part.column(0).to_pylist(), ids_of, strict=True):
                ids = np.append(ids, np.uint32(0)).astype("<u4")
                for k, (start, n) in enumerate(cut(ids, capacity)):
                    rows.append((doc_id, k, start, n, zlib.crc32(ids[start:start + n].tobytes())))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), *[pa.int64()] * 3),
                                                strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
                     encode, PIECES)


# ---------------------------------------------------------------- packing

def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of best-fit decreasing: lengths from the longest down, each into
    the sequence with the least room that holds it.  Sequences of equal content
    are one entry, so the work does not grow with the counts."""
    rooms: dict[int, dict[tuple[int, ...], int]] = {}
    order: list[int] = []                                # rooms of open sequences, ascending

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in rooms:
            rooms[room] = {}
            insort(order, room)
        rooms[room][pattern] = rooms[room].get(pattern, 0) + n

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect_left(order, length)
            room = order[at] if at < len(order) else capacity
            if at < len(order):
                pattern, n = rooms[room].popitem()
                if not rooms[room]:
                    del rooms[room]
                    del order[at]
            else:
                pattern, n = (), left                    # new sequences
            # what is left of a room after one part is the least room again
            each = min(room // length, left)
            full = min(n, left // each)
            put(room - each * length, (*pattern, *[length] * each), full)
            left -= full * each
            if pattern and n > full:
                put(room, pattern, n - full)
    return [(pattern, n) for group in rooms.values() for pattern, n in group.items()]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The larger of the volume bound and the bounds that pair lengths above
    ``capacity - k`` with nothing of ``k`` or longer."""
    n = np.arange(len(counts))
    best = -(-int((counts * n).sum()) // capacity)
    above = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])
    mass = np.concatenate([np.cumsum((counts * n)[::-1])[::-1], [0]])
    half = capacity // 2
    for k in range(1, half + 1):
        large = int(above[capacity - k + 1])                        # alone with parts under k
        middle = int(above[half + 1]) - large
        room = middle * capacity - int(mass[half + 1] - mass[capacity - k + 1])
        small = int(mass[k] - mass[half + 1])
        best = max(best, large + middle + max(0, -(-(small - room) // capacity)))
    return best


class Exhausted(Exception):
    """The search has made all its steps."""


class Steps:
    """Steps left of a search, and the tables it keeps: those of its latest
    ``KEPT`` enumerations.  The search can be thousands of patterns deep, where
    every table kept would take gigabytes; one that is needed again is made
    again."""

    def __init__(self, most: int) -> None:
        self.left = most
        self.tables: deque[list[list[int]]] = deque()

    def take(self, n: int = 1) -> None:
        self.left -= n
        if self.left < 0:
            raise Exhausted

    def keep(self, table: list[list[int]]) -> None:
        """Keep ``table`` (a list that holds it) among the latest; empty the oldest."""
        self.tables.append(table)
        if len(self.tables) > KEPT:
            self.tables.popleft().clear()


def undominated(parts: tuple[int, ...], waste: int, left: list[int]) -> bool:
    """Whether no length that is left over could take the place of some parts
    (of none: be added) and fill more, or fill the same with fewer parts.
    Such an exchange never costs a sequence, so dominated fillings need not be
    tried.  ``left`` are the lengths of which some remain beside ``parts``."""
    none, some, two = 1, 0, 0                            # sums of no, one or more, two or more parts
    for p in parts:
        two |= (two | some) << p
        some |= (some | none) << p
    sums = none | some
    for x in left:
        low = max(0, x - waste)
        if sums >> low & ((1 << x - low) - 1) or two >> x & 1:
            return False
    return True


def fillings(counts: np.ndarray, room: int, steps: Steps) -> Iterator[tuple[int, ...]]:
    """All undominated fillings of ``room``, least waste first, made as they
    are asked for.  An exact single part dominates all others."""
    # the numbers themselves are shared by all enumerations
    have = [_LENGTHS[x] if x < len(_LENGTHS) else x
            for x in np.flatnonzero(counts[:room + 1])[::-1].tolist()]
    if not have:
        yield ()
        return
    if have[0] == room:
        yield (room,)
        return
    steps.take(len(have))
    within = (1 << room + 1) - 1
    table: list[list[int]] = []

    def reach() -> list[int]:
        """Sums that lengths from the k-th on can make, whatever their counts."""
        if not table:
            sums = [1]
            for length in reversed(have):
                last, by = sums[-1], length
                while by <= room:
                    last |= last << by & within
                    by *= 2
                sums.append(last)
            sums.reverse()
            table.append(sums)
        return table[0]

    def exact(total: int) -> Iterator[tuple[int, ...]]:
        """Parts that add up to ``total``: of each length, from the longest down,
        as many as fit, then fewer."""
        taken: list[tuple[int, int, int]] = []       # place in ``have``, total before, parts taken
        k = 0
        while True:
            steps.take()
            if not total:
                yield tuple(have[at] for at, _, n in taken for _ in range(n))
            elif reach()[k] >> total & 1:
                n = min(total // have[k], int(counts[have[k]]))
                if n:
                    taken.append((k, total, n))
                k, total = k + 1, total - n * have[k]
                continue
            if not taken:
                return
            k, total, n = taken.pop()
            if n > 1:
                taken.append((k, total, n - 1))
            k, total = k + 1, total - (n - 1) * have[k]

    for waste in range(room + 1):
        for parts in exact(room - waste):
            used = Counter(parts)
            steps.take(len(have))
            if undominated(parts, waste, [x for x in have if counts[x] > used[x]]):
                if table:
                    steps.keep(table)
                yield parts


def complete(counts: np.ndarray, capacity: int = CAPACITY, most_steps: int = MAX_STEPS
             ) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and their repeats that hold every length exactly ``counts``
    times: the fewest sequences, if the search ends within ``most_steps``, else
    the best found, best-fit decreasing at first (``lower_bound`` tells how far
    from the least it can be)."""
    counts = counts.astype(np.int64)
    best = best_fit(counts, capacity)
    least = sum(t for _, t in best)
    bound = lower_bound(counts, capacity)
    volume = int((counts * np.arange(len(counts))).sum())
    steps = Steps(most_steps)

    def spare(lost: int) -> bool:
        """Whether a packing that has wasted ``lost`` can still beat the incumbent."""
        return lost <= (least - 1) * capacity - volume

    def choices(left: np.ndarray, lost: int, before: tuple[int, ...]) -> Iterator[tuple]:
        """Patterns around the longest length left, and their repeats.  The
        pattern before is not chosen again: its repeats were."""
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1
        found = fillings(left[:capacity - top + 1].copy(), capacity - top, steps)
        left[top] += 1
        for filling in found:
            pattern = (top, *filling)
            waste = capacity - sum(pattern)
            if not spare(lost + waste):
                return                                   # later ones waste more
            if pattern == before:
                continue
            values, per = np.unique(pattern, return_counts=True)
            for times in range(int((left[values] // per).min()), 0, -1):
                if spare(lost + times * waste):
                    yield pattern, times, lost + times * waste

    chosen: list[tuple[tuple[int, ...], int]] = []
    left = counts.copy()
    stack = [choices(left, 0, ())] if least > bound else []
    try:
        while stack and least > bound:
            steps.take()
            step = next(stack[-1], None)
            if step is None:
                stack.pop()
                if chosen:
                    pattern, times = chosen.pop()
                    np.add.at(left, list(pattern), times)
                continue
            pattern, times, lost = step
            chosen.append((pattern, times))
            np.subtract.at(left, list(pattern), times)
            if left.any():
                stack.append(choices(left, lost, pattern))
                continue
            if sum(t for _, t in chosen) < least:
                best, least = list(chosen), sum(t for _, t in chosen)
            chosen.pop()
            np.add.at(left, list(pattern), times)
    except Exhausted:
        pass
    return best


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset, repeats): the pieces
    of ``length`` with ranks from the first on fill one place of a pattern."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, rank.get(length, 0), sequence, offset, times))
            rank[length] = rank.get(length, 0) + times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` (written once) with sequence_id and offset."""
    spark = cut_pieces.sparkSession
    blocks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut_pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                                  F.lit(blocks)))
    # one small row per (length, block): at most capacity * blocks of them
    sizes = dealt.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(
        "length", "block",
        (F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")).alias("before"))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():   # capacity rows at most
        histogram[length] = n
    where = slots(complete(histogram, capacity))
    # a pattern uses up at least one length, so these are few rows as well
    keys = where[:, 0] * (1 << 44) + where[:, 1]
    shared = spark.sparkContext.broadcast((keys, where))

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, where = shared.value
        length = batch.column(3).to_numpy()
        rank = batch.column(5).to_numpy()
        slot = where[np.searchsorted(keys, length * (1 << 44) + rank, "right") - 1]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array(slot[:, 2] + rank - slot[:, 1]), pa.array(slot[:, 3])],
            [*batch.schema.names[:5], "sequence_id", "offset"])

    ranked = (dealt.join(before, ["length", "block"])
              .withColumn("rank", F.row_number().over(
                  Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32"))
                  + F.col("before") - 1)
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      F.col("rank").cast("bigint").alias("rank")))
    return arrow_map(ranked, find, PIECES + ", sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return place(materialize(pieces(docs, tokenizer_path, capacity), "pieces"), capacity)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
