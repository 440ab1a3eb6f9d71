"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles.  MinHash bands propose candidate pairs;
their MinHash values are compared a few at a time, and a pair is dropped as
soon as the posterior probability that its similarity reaches the threshold
(uniform prior, binomial matches) falls below the tolerance.  Pairs that are
left are verified on their whole shingle sets.

Copies (equal shingle sets) form one class before any pairing.  Classes that
share a band key with others are gathered into candidate components; a
component is cut into blocks, every pair of blocks is one task, and a task
returns a row per class (its links, a forest edge), never a row per pair.  So
a group of near copies of any size is split over tasks by its block pairs.

At a similarity of exactly 0.8 a pair meets in no band with probability 3e-6,
and is pruned wrongly with about the tolerance.  Classes and shingles are
64-bit hashes.

Words are lower-case runs without white space and ASCII punctuation; a text of
fewer than five words is one shingle of all its words.  Defined results: null
and empty texts, and texts without words, are similar to nothing and their own
class; a class_id is the smallest doc_id of the class (null only if all are
null); repeated rows are copies of each other; extra columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, materialize, slices, small_side, table
from eventstar.llm.components import components

SHINGLE = 5
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP = 16                                # MinHash values compared at a time
TOLERANCE = 1e-9
BLOCK_CLASSES, BLOCK_SHINGLES = 2000, 2_000_000
_CLEAN = str.maketrans(dict.fromkeys(string.punctuation, " "))
_RNG = np.random.default_rng(20240101)
_MULTIPLY = _RNG.integers(0, 1 << 63, HASHES, np.uint64) << np.uint64(1) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, HASHES, np.uint64)
_PLACE = _RNG.integers(0, 1 << 63, SHINGLE, np.uint64) << np.uint64(1) | np.uint64(1)


# ------------------------------------------------------------ sets and hashes

class Shingler:
    """64-bit hashes of shingles; word hashes seen are kept up to a bound."""

    def __init__(self, keep: int = 200_000) -> None:
        self.known: dict[str, int] = {}
        self.keep = keep

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingle hashes of a text."""
        words = (text or "").lower().translate(_CLEAN).split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array(list(map(known.__getitem__, words)), np.uint64)
        n = max(1, len(h) - SHINGLE + 1)
        out = np.zeros(n, np.uint64)
        for k in range(min(SHINGLE, len(h))):
            out += (h[k:k + n] ^ h[k:k + n] >> np.uint64(29)) * _PLACE[k]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        return np.unique(out)


def class_of(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def minhashes(shingles: np.ndarray, chunk: int = 4096) -> np.ndarray:
    """HASHES values of 16 bits."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for s in range(0, len(shingles), chunk):
        part = shingles[None, s:s + chunk] * _MULTIPLY[:, None]
        part += _ADD[:, None]
        part >>= np.uint64(32)
        low = np.minimum(low, part.min(axis=1))
    return ((low * np.uint64(0x9E3779B1)) >> np.uint64(8)).astype(np.uint16)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(n, BANDS) keys of (n, HASHES) signatures."""
    s = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signatures), 1))
    for r in range(ROWS):
        key = (key ^ s[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


@cache
def least_matches(threshold: float, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For STEP, 2 STEP, ... compared values, the fewest matches with which the
    similarity still reaches ``threshold`` with probability ``tolerance``.

    With a uniform prior, m matches of n leave a Beta(m + 1, n - m + 1)
    posterior, whose mass above t is P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


# ------------------------------------------------------------------ one task

class Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def links_of_task(node: np.ndarray, block: np.ndarray, copies: np.ndarray, signatures: np.ndarray,
                  sets: list[np.ndarray], first: int, second: int, threshold: float) -> list[tuple]:
    """(node, linked documents, linked classes, forest parent) of each class
    with links; pairs within a block if ``first == second``, else across."""
    n = len(node)
    keys = band_keys(signatures)
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(local.max()) + 1 if len(local) else 1, bool)
    least = least_matches(threshold)
    docs, classes, forest = np.zeros(n, np.int64), np.zeros(n, np.int64), Forest(n)
    left = np.flatnonzero(block == first)
    right = left if first == second else np.flatnonzero(block == second)
    for i, a in enumerate(left):
        others = right[i + 1:] if first == second else right
        # sizes differ too much to reach the threshold
        ratio = np.minimum(sizes[others], sizes[a]) >= threshold * np.maximum(sizes[others], sizes[a]) - 1e-9
        others = others[ratio]
        others = others[(keys[others] == keys[a]).any(axis=1)]
        matches = np.zeros(len(others), np.int64)
        for k, need in enumerate(least):
            if not len(others):
                break
            cols = slice(k * STEP, (k + 1) * STEP)
            matches += (signatures[others, cols] == signatures[a, cols]).sum(axis=1)
            stay = matches >= need
            others, matches = others[stay], matches[stay]
        if not len(others):
            continue
        mine = local[begins[a]:ends[a]]
        mark[mine] = True
        spots = np.concatenate([np.arange(begins[b], ends[b]) for b in others])
        starts = np.concatenate([[0], np.cumsum(sizes[others])[:-1]])
        common = np.add.reduceat(mark[local[spots]].astype(np.int64), starts)
        mark[mine] = False
        union = sizes[a] + sizes[others] - common
        linked = others[common >= threshold * union - 1e-9]
        docs[a] += copies[linked].sum()
        classes[a] += len(linked)
        docs[linked] += copies[a]
        classes[linked] += 1
        for b in linked.tolist():
            forest.link(int(a), b)
    return [(int(node[x]), int(docs[x]), int(classes[x]), int(node[forest.root(int(x))]))
            for x in np.flatnonzero(classes)]


# ------------------------------------------------------------------ the join

def signatures_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, node (null without words), n_shingles, signature."""
    shingler = Shingler()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text"):
            sets = [shingler.shingles(t) for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([minhashes(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "text_key", "node", "n_shingles", "signature"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64("text").alias("text_key"), "text")
    return arrow_map(rows, run, "doc_id bigint, text_key bigint, node bigint, n_shingles bigint, "
                                "signature binary")


def candidate_components(nodes: DataFrame) -> DataFrame:
    """node, root of the classes that share a band key with another class."""
    def keys(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, HASHES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)), pa.array(band_keys(sig).ravel())],
            ["node", "band"])
    bands = arrow_map(nodes.select("node", "signature"), keys, "node bigint, band bigint")
    shared = (bands.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"))
              .filter("low <> high").select("band", "low"))
    edges = bands.join(shared, "band").select(F.col("node").alias("a"), F.col("low").alias("b"))
    return components(edges)


def class_links(docs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """node, docs, classes, parent rows of all block-pair tasks."""
    members = materialize(
        candidate_components(nodes).join(nodes.drop("signature"), "node"), "members")
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("s") / BLOCK_SHINGLES))
    total = members.count()
    # small components share tasks: no pair of theirs meets across components
    shares = max(1, ceil(total / (BLOCK_CLASSES // 2)))
    placed = (members.join(sizes.select("root", blocks.cast("int").alias("blocks")), "root")
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .withColumn("task_root", F.when(F.col("blocks") > 1, F.col("root")))
              .withColumn("share", F.pmod(F.xxhash64("root"), F.lit(shares)))
              .select("node", "rep", "copies", "blocks", "block", "task_root", "share"))
    placed = small_side(placed, total)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = (rows.join(placed, F.col("doc_id").eqNullSafe(F.col("rep")))
             .drop("doc_id", "rep"))
    shingler = Shingler()

    def sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = batch.schema.get_field_index("text")
        for part in slices(batch, "text", 2 << 20):
            found = [shingler.shingles(t) for t in part.column(at).to_pylist()]
            node = part.column(part.schema.get_field_index("node")).to_pylist()
            # rows that share the doc_id of a class but not its text
            same = pa.array([len(s) > 0 and class_of(s) == k for s, k in zip(found, node, strict=True)])
            out = pa.RecordBatch.from_arrays(
                [*(part.column(part.schema.get_field_index(c)) for c in
                   ("node", "copies", "blocks", "block", "task_root", "share")),
                 pa.array([s.tobytes() for s in found], pa.binary()),
                 pa.array([minhashes(s).tobytes() if len(s) else b"" for s in found], pa.binary())],
                ["node", "copies", "blocks", "block", "task_root", "share", "shingles", "signature"])
            yield out.filter(same)

    dealt = (arrow_map(texts, sets, "node bigint, copies bigint, blocks int, block int, "
                                    "task_root bigint, share bigint, shingles binary, signature binary")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("first", F.least("block", "other"))
             .withColumn("second", F.greatest("block", "other"))
             .withColumn("share", F.when(F.col("blocks") == 1, F.col("share")))
             .drop("other", "blocks"))

    def task(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node")
        found = links_of_task(
            rows["node"].to_numpy(), rows["block"].to_numpy(), rows["copies"].to_numpy(),
            np.frombuffer(b"".join(rows["signature"]), np.uint16).reshape(-1, HASHES),
            [np.frombuffer(s, np.uint64) for s in rows["shingles"]], key[2], key[3], threshold)
        return pd.DataFrame(found, columns=["node", "docs", "classes", "parent"])

    return materialize(dealt.groupBy("task_root", "share", "first", "second").applyInPandas(
        task, "node bigint, docs bigint, classes bigint, parent bigint"), "links")


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per document: doc_id, text_key, class_id, n_links (similar
    documents, copies included), n_copies (documents of equal sets, itself
    included), keeper (the document of its class to keep)."""
    signed = materialize(signatures_of(docs), "signatures")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    nodes = materialize(
        signed.filter("node IS NOT NULL").groupBy("node")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
             F.min(rank).alias("low"), F.first("signature").alias("signature"))
        .withColumn("rep", F.col("low.doc_id")), "classes")
    links = class_links(docs, nodes, threshold)
    counts = links.groupBy("node").agg(F.sum("docs").alias("docs"))
    roots = components(links.select(F.col("node").alias("a"), F.col("parent").alias("b")))
    known = (nodes.select("node", "copies", "low").join(counts, "node", "left")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    known = materialize(known, "class-members")
    lows = known.groupBy("root").agg(F.min("low").alias("class_low"))
    info = known.join(lows, "root").select("node", "copies", F.coalesce("docs", F.lit(0)).alias("docs"),
                                           "class_low")
    own = signed.select("doc_id", "text_key", "node", rank.alias("own"))
    return own.join(info, "node", "left").select(
        "doc_id", "text_key", F.coalesce("class_low", "own")["doc_id"].alias("class_id"),
        F.coalesce(F.col("docs") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        (F.coalesce("class_low", "own") == F.col("own")).alias("keeper"))


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without all but one document of each class, all
    columns; of rows that repeat doc_id and text, one stays if it has words."""
    report = materialize(near_duplicates(docs, threshold), "near-report")
    drop = report.filter(~F.col("keeper")).select(
        F.col("doc_id").alias("drop_id"), F.col("text_key").alias("drop_key")).distinct()
    twice = (report.filter("keeper AND n_copies > 1").groupBy("doc_id", "text_key")
             .agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select(F.col("doc_id").alias("drop_id"), F.col("text_key").alias("drop_key")))

    def match(side: DataFrame, how: str) -> DataFrame:
        return docs.join(small_side(side), docs["doc_id"].cast("bigint").eqNullSafe(side["drop_id"])
                         & (F.xxhash64(docs["text"]) == side["drop_key"]), how)

    if twice.isEmpty():
        return match(drop, "left_anti")
    again = match(twice, "left_semi").dropDuplicates(["doc_id", "text"])
    return match(materialize(drop.unionByName(twice), "dropped"), "left_anti").unionByName(again)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, links and copies of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "keeper")


#: The same in DuckDB: all pairs of classes that share a shingle.
OP5_SQL = r"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(lower(coalesce(text, '')),
        '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~', '                                '), '[^\s]+') AS w
      FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]))
        END AS s FROM d),
k AS (SELECT doc_id, len(s) AS n, s, md5(array_to_string(s, '|')) AS cid FROM s),
c AS (SELECT cid, any_value(s) AS s, any_value(n) AS n, count(*) AS copies, min(doc_id) AS low
      FROM k WHERE n > 0 GROUP BY cid),
t AS (SELECT cid, n, unnest(s) AS g FROM c),
links AS (SELECT a.cid AS a, b.cid AS b FROM t a JOIN t b ON a.g = b.g AND a.cid <> b.cid
          GROUP BY a.cid, b.cid, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n)),
near AS (SELECT a AS cid, sum(copies) AS linked FROM links JOIN c ON c.cid = links.b GROUP BY a),
r(cid, other) AS (SELECT cid, cid FROM c UNION SELECT r.cid, links.b FROM r JOIN links ON links.a = r.other),
roots AS (SELECT r.cid, min(c.low) AS class_id FROM r JOIN c ON c.cid = r.other GROUP BY r.cid)
SELECT k.doc_id, CASE WHEN k.n = 0 THEN k.doc_id ELSE roots.class_id END AS class_id,
       CASE WHEN k.n = 0 THEN 0 ELSE CAST(coalesce(near.linked, 0) + c.copies - 1 AS BIGINT) END AS n_links,
       CASE WHEN k.n = 0 THEN 1 ELSE c.copies END AS n_copies
FROM k LEFT JOIN c ON c.cid = k.cid LEFT JOIN near ON near.cid = k.cid LEFT JOIN roots ON roots.cid = k.cid
"""
