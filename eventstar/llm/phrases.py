"""Phrase collocation mining with stripes.

A stripe is a prefix of words with an associative counter of the words that
follow it.  Tasks build stripes over slices of text, sorted partitions merge
them elementwise in one pass, and all figures come from the merged stripes:

* extensions: an entry is the count of the phrase ``prefix + word``;
* prefix totals: a slot for occurrences that end a piece, or that no frequent
  phrase continues, makes the entries of a stripe add up to the count of its
  prefix;
* subsumption maxima: the largest entry is the most frequent one-word
  extension to the right.  A phrase's extensions to the left are entries of
  other stripes, grouped by the words behind the first.  Longer phrases that
  hold a phrase are no more frequent than the one-word extension within them,
  so these maxima decide.

Stripes are built a phrase length at a time, over the whole table.  A phrase
is counted where the phrases one word shorter at both its ends are frequent;
these are known to tasks through a Bloom filter of bounded size, whose false
positives cost work and change no count.  The empty prefix, and prefixes that
hold a hundredth of all words or more (a hundred at most), are split into
segments by the next word, so no task merges the whole vocabulary of a
frequent word.  Phrases are compared as text: no count rests on a hash.

Defined results: null and empty texts have no words; a null lang counts as
``und``; every row counts, repeated rows too; text parts (pieces) end at
``.,;:!?`` and line ends, and no phrase crosses them or the end of a text;
doc_id and extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, materialize, slices, table

MAX_WORDS, MIN_COUNT, TOP = 5, 100, 2000
SEGMENTS, FIRST_SEGMENTS = 64, 1024
HOT_SHARE = 100                          # a prefix with 1/100 of all words is split
MAX_FILTER_BITS = 28                     # 2**28 bits, 32 MB, whatever the corpus
SLICE_BYTES = 16 << 20
WHOLE = -1                               # segment of a stripe that is not split
BREAK = b"\xff"                          # no byte of a text

_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(BREAK[0] if c in _SEPARATORS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_STRIPE = "lang string, prefix string, segment int, next array<string>, counts array<bigint>"
_MERGED = "lang string, prefix string, total bigint, longest bigint, next array<string>, counts array<bigint>"


# ------------------------------------------------------------------- hashes

def chain(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` words in a row."""
    out = hashes
    for j in range(1, size):
        head = out[:len(hashes) - j]
        out = (head ^ head >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) + hashes[j:]
    return out


def lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), 11))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def phrase_hash(lang: str, phrase: str) -> int:
    words = phrase.encode().split(b" ")
    return int(chain(word_hashes(words), len(words))[0] ^ lang_seed(lang))


class Filter:
    """A Bloom filter with two probes."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.bits = words, len(words) * 64

    @staticmethod
    def probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        mixed = (hashes ^ hashes >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
        return mixed >> np.uint64(1) & np.uint64(bits - 1), mixed >> np.uint64(32) & np.uint64(bits - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for bit in self.probes(hashes, self.bits):
            found &= (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def filter_of(counts: DataFrame, n: int) -> Filter:
    """A filter of the (lang, phrase) rows of ``counts``, of at most
    2**MAX_FILTER_BITS bits."""
    bits = 1 << min(MAX_FILTER_BITS, max(10, ceil(log2(16 * max(1, n)))))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        hashes = np.array([phrase_hash(lang, phrase) for lang, phrase in rows], np.uint64)
        at = np.concatenate(Filter.probes(hashes, bits))
        yield pa.RecordBatch.from_arrays(
            [pa.array((at >> np.uint64(6)).astype(np.int64)),
             pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["slot", "mask"])

    slots = (arrow_map(counts.select("lang", "phrase"), run, "slot bigint, mask bigint")
             .groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow())      # bits / 64 rows at most
    words = np.zeros(bits // 64, np.uint64)
    words[slots.column("slot").to_numpy()] = slots.column("mask").to_numpy().view(np.uint64)
    return Filter(words)


# ------------------------------------------------------------------- stripes

def encode(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Word numbers of all texts in a row, -1 between pieces and at the end,
    and the words."""
    blob = b"\n".join([*texts, b""]).translate(_TABLE).replace(BREAK, b" \xff ")
    enc = pa.array(blob.split(), pa.binary()).dictionary_encode()
    words = enc.dictionary.to_pylist()
    ids = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    at = words.index(BREAK)
    return np.where(ids == at, -1, ids - (ids > at)), words[:at] + words[at + 1:]


def _lists(row: np.ndarray, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Starts of the runs of ``row``, and the runs as lists."""
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    ends = pa.array(np.r_[starts, len(row)].astype(np.int32))
    return starts, pa.ListArray.from_arrays(ends, words), pa.ListArray.from_arrays(ends, pa.array(counts))


def first_stripes(lang: str, ids: np.ndarray, words: list[bytes]) -> pa.RecordBatch:
    """The stripe of the empty prefix, in segments."""
    counts = np.bincount(ids[ids >= 0], minlength=len(words))
    segment = (word_hashes(words) % np.uint64(FIRST_SEGMENTS)).astype(np.int32)
    order = np.argsort(segment, kind="stable")
    spelled = pa.array(words, pa.binary()).cast(pa.string()).take(pa.array(order))
    starts, nexts, numbers = _lists(segment[order], spelled, counts[order])
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(starts)), pa.array([""] * len(starts)), pa.array(segment[order][starts]),
         nexts, numbers], ["lang", "prefix", "segment", "next", "counts"])


def longer_stripes(lang: str, ids: np.ndarray, words: list[bytes], size: int, known: Filter,
                   hot: np.ndarray) -> pa.RecordBatch | None:
    """Stripes of the prefixes of ``size`` words that pass the filter."""
    hashes = word_hashes(words)
    spread = np.where(ids >= 0, hashes[ids] if len(words) else 0, 0).astype(np.uint64)
    if len(ids) <= size:
        return None
    grams = chain(spread, size) ^ lang_seed(lang)
    breaks = np.r_[0, np.cumsum(ids < 0)]
    frequent = breaks[size:] == breaks[:-size]
    frequent[frequent] = known.has(grams[frequent])
    at = np.flatnonzero(frequent)                        # a break follows the last word
    if not len(at):
        return None
    after = np.where(frequent[at + 1], ids[at + size], -1)

    def differ(order: np.ndarray) -> np.ndarray:
        p = at[order]
        return np.logical_or.reduce([ids[p[1:] + j] != ids[p[:-1] + j] for j in range(size)])

    order = np.lexsort((after, grams[at]))
    fresh = differ(order)
    if (fresh & (grams[at[order]][1:] == grams[at[order]][:-1])).any():
        # two prefixes of one hash: order by the words themselves
        order = np.lexsort([after, *(ids[at + j] for j in reversed(range(size)))])
        fresh = differ(order)
    at, after = at[order], after[order]
    entry = np.flatnonzero(np.r_[True, fresh | (after[1:] != after[:-1])])
    counts = np.diff(np.r_[entry, len(at)])
    prefix = np.cumsum(np.r_[0, fresh])[entry]
    at, after = at[entry], after[entry]
    split = np.isin(grams[at], hot)
    segment = np.where(split, np.where(after >= 0, (hashes % np.uint64(SEGMENTS)).astype(np.int64)[after], 0),
                       WHOLE)
    order = np.lexsort((segment, prefix))
    at, after, segment, counts = at[order], after[order], segment[order], counts[order]
    spelled = pa.array([*words, b""], pa.binary()).cast(pa.string())         # the last for -1
    starts, nexts, numbers = _lists(prefix[order] * (SEGMENTS + 1) + segment, spelled.take(
        pa.array(np.where(after < 0, len(words), after))), counts)
    parts = [spelled.take(pa.array(ids[at[starts] + j])) for j in range(size)]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(starts)), pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0],
         pa.array(segment[starts].astype(np.int32)), nexts, numbers],
        ["lang", "prefix", "segment", "next", "counts"])


def stripes_of(docs: DataFrame, size: int, known: Filter | None, hot: list[int]) -> DataFrame:
    """Partial stripes of prefixes of ``size`` words, in no order."""
    shared = docs.sparkSession.sparkContext.broadcast((known.words, np.array(hot, np.uint64))
                                                      if known else None)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text", SLICE_BYTES):
            langs = np.array(part.column(0).to_pylist(), object)
            texts = part.column(1).cast(pa.binary()).to_pylist()
            for lang in sorted(set(langs)):
                ids, words = encode([texts[i] for i in np.flatnonzero(langs == lang)])
                if not words:
                    continue
                if size == 0:
                    out = first_stripes(lang, ids, words)
                else:
                    out = longer_stripes(lang, ids, words, size, Filter(shared.value[0]), shared.value[1])
                for start in range(0, out.num_rows if out else 0, 20_000):
                    yield out.slice(start, 20_000)

    rows = docs.filter("text IS NOT NULL").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return arrow_map(rows, run, _STRIPE)


def merge_stripes(stripes: DataFrame, min_count: int) -> DataFrame:
    """lang, prefix, total, longest, next, counts of merged stripes (of the
    segments of split ones), with the entries of at least ``min_count``."""
    key = ["lang", "prefix", "segment"]

    def finished(heads: pa.RecordBatch, rows: pa.Table) -> pa.RecordBatch:
        """The stripes of ``heads``, whose entries are ``rows``, by stripe."""
        starts, n = np.searchsorted(rows.column("stripe").to_numpy(), np.arange(heads.num_rows)), \
            rows.column("n").to_numpy()
        word = pc.not_equal(rows.column("next"), "").to_numpy()
        total = np.add.reduceat(n, starts)
        stays = word & (n >= min_count)
        longest = np.maximum.reduceat(np.where(stays, n, 0), starts)
        offsets = pa.array(np.r_[0, np.cumsum(np.add.reduceat(stays.astype(np.int64), starts))].astype(np.int32))
        kept = rows.filter(pa.array(stays)).combine_chunks()
        lists = [pa.ListArray.from_arrays(offsets, pa.array(kept.column(c).to_pylist(), t))
                 for c, t in (("next", pa.string()), ("n", pa.int64()))]
        out = pa.RecordBatch.from_arrays(
            [heads.column(0), heads.column(1), pa.array(total), pa.array(longest), *lists],
            ["lang", "prefix", "total", "longest", "next", "counts"])
        whole = heads.column(2).to_numpy() == WHOLE
        return out.filter(pa.array(~whole | (total >= min_count)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_head, open_rows = None, None          # the last stripe met, and its entries
        for batch in batches:
            if not batch.num_rows:
                continue
            heads = pa.Table.from_batches([batch.select(key)])
            if open_head is not None:
                heads = pa.concat_tables([open_head, heads])
            heads = heads.combine_chunks().to_batches()[0]
            fresh = np.zeros(heads.num_rows - 1, bool)
            for col in heads.columns:
                fresh |= pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
            stripe = np.cumsum(np.r_[0, fresh])
            lists = batch.column(3)
            each = np.repeat(stripe[-batch.num_rows:], pc.list_value_length(lists).to_numpy())
            rows = pa.table([pa.array(each), lists.flatten(), batch.column(4).flatten()], ["stripe", "next", "n"])
            if open_rows is not None:
                rows = pa.concat_tables([open_rows, rows])
            rows = rows.group_by(["stripe", "next"]).aggregate([("n", "sum")]).rename_columns(
                ["stripe", "next", "n"]).sort_by("stripe")
            heads = heads.take(pa.array(np.flatnonzero(np.r_[True, fresh])))
            last = int(np.searchsorted(rows.column("stripe").to_numpy(), heads.num_rows - 1))
            if last:
                yield finished(heads.slice(0, heads.num_rows - 1), rows.slice(0, last))
            open_head = pa.Table.from_batches([heads.slice(heads.num_rows - 1)])
            open_rows = rows.slice(last)
            open_rows = open_rows.set_column(0, "stripe", pa.array(np.zeros(open_rows.num_rows, np.int64)))
        if open_head is not None:
            yield finished(open_head.combine_chunks().to_batches()[0], open_rows)

    return stripes.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, _MERGED)


def mined_stripes(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT
                  ) -> list[DataFrame]:
    """Merged stripes of prefixes of 0, 1, ... words, as far as phrases of
    ``min_count`` occurrences reach."""
    levels, known, hot, n_words = [], None, [], 0
    for size in range(max_words):
        merged = materialize(merge_stripes(stripes_of(docs, size, known, hot), min_count), "stripes")
        levels.append(merged)
        counts = extensions(merged)
        if size == 0:
            n_words = merged.agg(F.sum("total")).first()[0] or 0
        n = counts.count()
        if not n or size == max_words - 1:
            break
        known = filter_of(counts, n)
        # HOT_SHARE rows at most
        hot = [phrase_hash(r["lang"], r["phrase"]) for r in
               counts.filter(F.col("f") * HOT_SHARE >= n_words).select("lang", "phrase").collect()]
    return levels


# ------------------------------------------------------------------- scoring

def extensions(merged: DataFrame) -> DataFrame:
    """lang, phrase, f of the entries of merged stripes."""
    entry = merged.select("lang", "prefix", F.explode(F.arrays_zip("next", "counts")).alias("e"))
    return entry.select("lang", F.when(F.col("prefix") == "", F.col("e.next"))
                        .otherwise(F.concat_ws(" ", "prefix", "e.next")).alias("phrase"),
                        F.col("e.counts").alias("f"))


#: floor(1000 a n / (l r)) in whole numbers of up to 38 digits.
SCORE = """CAST(a AS DECIMAL(18,0)) * CAST(n AS DECIMAL(18,0)) * 1000
           div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"""


def first_by_lang(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each lang with their rank: the first of
    parts of each lang, then the first of these."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = parts.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top).drop("part")
    return some.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)


def mine_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                 top: int = TOP, subsumed_percent: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each
    lang of 2 to ``max_words`` words and ``min_count`` occurrences.

    The score is the least over all cuts of a phrase in two; a phrase that lies
    in a longer one with ``subsumed_percent`` of its occurrences goes.
    """
    levels = mined_stripes(docs, max_words, min_count)
    n = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))
    if len(levels) == 1:
        levels = [*levels, levels[0].limit(0)]
    longer = [df.select("lang", "prefix", "total", "longest") for df in levels[1:]]
    totals = longer[0]
    for df in longer[1:]:
        totals = totals.unionByName(df)
    totals = materialize(totals.groupBy("lang", "prefix").agg(
        F.sum("total").alias("total"), F.max("longest").alias("longest")), "prefix-totals")
    found = [extensions(df) for df in levels[1:]]
    phrases = found[0]
    for df in found[1:]:
        phrases = phrases.unionByName(df)
    phrases = materialize(phrases.withColumnRenamed("f", "a"), "phrases")
    behind = (phrases.select("lang", F.expr("substring_index(phrase, ' ', -(size(split(phrase, ' ')) - 1))")
                             .alias("phrase"), F.col("a").alias("f"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("before")))
    kept = (phrases.join(totals.select("lang", F.col("prefix").alias("phrase"), "longest"),
                         ["lang", "phrase"], "left")
            .join(behind, ["lang", "phrase"], "left")
            .filter(100 * F.greatest(F.coalesce("longest", F.lit(0)), F.coalesce("before", F.lit(0)))
                    < subsumed_percent * F.col("a"))
            .select("lang", "phrase", "a"))
    cuts = (kept.withColumn("w", F.split("phrase", " "))
            .withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
            .select("lang", "phrase", "a", "cut",
                    F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("first"),
                    F.array_join(F.slice("w", F.col("cut") + 1, F.size("w") - F.col("cut")), " ").alias("rest")))
    scored = (cuts.join(totals.select("lang", F.col("prefix").alias("first"), F.col("total").alias("l")),
                        ["lang", "first"])
              .join(totals.select("lang", F.col("prefix").alias("rest"), F.col("total").alias("r")),
                    ["lang", "rest"])
              .join(F.broadcast(n), "lang")                       # a row per lang
              .withColumn("score", F.expr(SCORE)))
    best = (scored.groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
            .select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score"))
    return first_by_lang(best, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of every lang of the whole table."""
    return mine_phrases(table(spark, sf_dir, "documents").select("lang", "text"))


#: The same in DuckDB: all phrases of all pieces counted.
OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, w[i:i + k - 1] AS g FROM (
        SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, array_to_string(g, ' ') AS phrase, k, any_value(g) AS g, count(*) AS f
      FROM g GROUP BY lang, k, array_to_string(g, ' ') HAVING count(*) >= 100),
inside AS (SELECT lang, array_to_string(g[i:i + j - 1], ' ') AS phrase, max(f) AS f FROM (
             SELECT lang, k, g, f, j, unnest(range(1, k - j + 2)) AS i
             FROM f, (SELECT unnest([2, 3, 4]) AS j) WHERE j < k) GROUP BY ALL),
c AS (SELECT f.* FROM f LEFT JOIN inside i ON i.lang = f.lang AND i.phrase = f.phrase
      WHERE f.k >= 2 AND (i.f IS NULL OR 100 * i.f < 100 * f.f)),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, cut, array_to_string(g[1:cut], ' ') AS first,
                array_to_string(g[cut + 1:k], ' ') AS rest
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c),
s AS (SELECT cuts.lang, cuts.phrase, a, cut, l.f AS l, r.f AS r, t.n,
             (1000::HUGEINT * a * t.n) // (l.f::HUGEINT * r.f) AS score
      FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = cuts.first
      JOIN f r ON r.lang = cuts.lang AND r.phrase = cuts.rest JOIN t ON t.lang = cuts.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM o WHERE rank <= 2000
"""
