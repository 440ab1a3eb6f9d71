"""Near-duplicate removal by one-permutation MinHash.

One hash function deals the shingles of a text over ``ROWS x bands`` bins and
each bin keeps its least hash.  An empty bin takes the value of the first full
bin that a universal hash of (bin, attempt) meets (optimal densification), so
two texts agree in a bin with a probability equal to their similarity.  Bands
of ``ROWS`` bins are bucket keys.

Each bucket has one centre, the member that meets most others over all its
buckets; the candidates are the stars (centre, member), at most one per bucket
and member, never the pairs of a bucket.  A star is one task, which holds the
full shingle sets of its members: links to the centre are confirmed first;
members left loose are then compared with the others of the star, unless
their overlaps with the centre bound the common part below the threshold.  Every pair
that shares a bucket meets in the star of its centre, so no link is lost that
the bands propose; a task returns a forest, a row per member, never a row per
pair.  A star too large for one task is cut into blocks, and each pair of
blocks is a task.

The bands are as many as make a pair at the very threshold share none with a
probability of at most ``MISS``.  Shingles are 64-bit hashes, classes of equal
sets 128-bit hashes.

Words are runs without white space, ``A-Z`` in lower case; a text of fewer
words than a shingle is one shingle.  Defined results: null and empty texts
and texts without words have no shingles and are linked with nothing;
rows that repeat a text are copies; rows that share a doc_id but differ in
text are judged apart; component_id is the smallest doc_id reachable (null
only if all are null, and then kept); extra columns pass through
``drop_near_duplicates`` and are not read otherwise; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, join_hot, materialize, slices, small_side, table
from eventstar.llm.components import components

ROWS, MISS = 8, 1e-6
BLOCK_NODES, BLOCK_SHINGLES = 2000, 2_000_000
ATTEMPTS = 64                            # attempts of densification made at a time
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@cache
def bands_for(percent: int) -> int:
    """Bands with which a pair at the threshold shares none in MISS of cases."""
    return ceil(log(MISS) / log(1 - (percent / 100) ** ROWS))


# ------------------------------------------------------------ sets and hashes

class Shingles:
    """64-bit hashes of word shingles; word hashes seen are kept up to a bound."""

    def __init__(self, size: int, keep: int = 200_000) -> None:
        self.size, self.keep = size, keep
        self.known: dict[bytes, int] = {}
        rng = np.random.default_rng(13)
        self.place = rng.integers(0, 1 << 63, size, np.uint64) << np.uint64(1) | np.uint64(1)

    def of(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingles of a text."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array(list(map(known.__getitem__, words)), np.uint64)
        n = max(1, len(h) - self.size + 1)
        out = np.zeros(n, np.uint64)
        for k in range(min(self.size, len(h))):
            out += (h[k:k + n] ^ h[k:k + n] >> np.uint64(29)) * self.place[k]
        out ^= out >> np.uint64(32)
        out *= _MIX
        out ^= out >> np.uint64(29)
        return np.unique(out)


def set_key(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


@cache
def _sources(bins: int, block: int) -> np.ndarray:
    """(ATTEMPTS, bins): the bin that an empty bin asks at each attempt."""
    return np.random.default_rng([bins, block]).integers(0, bins, (ATTEMPTS, bins))


def one_permutation(shingles: np.ndarray, bins: int) -> np.ndarray:
    """The densified signature of a sorted, non-empty set."""
    at = ((shingles >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.r_[True, at[1:] != at[:-1]]
    out = np.zeros(bins, np.uint64)
    out[at[first]] = shingles[first]
    full = np.zeros(bins, bool)
    full[at[first]] = True
    empty = np.flatnonzero(~full)
    if len(empty) == bins - 1:
        out[:] = shingles[0]
        return out
    block = 0
    while len(empty):
        source = _sources(bins, block)[:, empty]
        met = full[source]
        hit = met.any(axis=0)
        out[empty[hit]] = out[source[met.argmax(axis=0), np.arange(len(empty))][hit]]
        empty, block = empty[~hit], block + 1
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ROWS bins."""
    s = signature.reshape(-1, ROWS)
    key = np.arange(1, len(s) + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = (key ^ s[:, r]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


# ------------------------------------------------------------------ one star

class Forest:
    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def star_links(sets: list[np.ndarray], block: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Forest edges (member, member) of the links of one star.  ``sets[0]`` is
    the centre (block -1); other members are compared within their block if
    all are of one, else across the two blocks."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(local.max()) + 1, bool)

    def common(x: int, others: np.ndarray) -> np.ndarray:
        mark[local[begins[x]:ends[x]]] = True
        spots = np.concatenate([np.arange(begins[y], ends[y]) for y in others])
        starts = np.r_[0, np.cumsum(sizes[others])[:-1]]
        found = np.add.reduceat(mark[local[spots]].astype(np.int64), starts)
        mark[local[begins[x]:ends[x]]] = False
        return found

    def enough(shared: np.ndarray, x: int, others: np.ndarray) -> np.ndarray:
        # 100 shared >= percent (a + b - shared)
        return (100 + percent) * shared >= percent * (sizes[x] + sizes[others])

    forest = Forest(n)
    rest = np.arange(1, n)
    if not len(rest):
        return []
    inside = np.r_[sizes[0], common(0, rest)]
    linked = np.r_[True, enough(inside[1:], 0, rest)]
    for y in np.flatnonzero(linked)[1:].tolist():
        forest.link(0, y)
    outside = sizes - inside
    across = len(np.unique(block[1:])) > 1
    # loose members last, so that each pair with a loose one is met once
    order = np.r_[np.flatnonzero(linked), np.flatnonzero(~linked)]
    order = order[order > 0]
    n_linked = int(linked[1:].sum())
    for k in range(n_linked, len(order)):
        x = int(order[k])
        others = order[:k]
        # the centre bounds what both can share
        bound = np.minimum(inside[x], inside[others]) + np.minimum(outside[x], outside[others])
        others = others[enough(bound, x, others)]
        if across:
            others = others[block[others] != block[x]]
        others = others[[forest.root(int(y)) != forest.root(x) for y in others]] if len(others) else others
        if len(others):
            for y in others[enough(common(x, others), x, others)].tolist():
                forest.link(x, y)
    return [(x, forest.root(x)) for x in range(n) if forest.root(x) != x]


# ---------------------------------------------------------------- the corpus

def set_classes(docs: DataFrame, percent: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, text_key, key, n_shingles) and the classes of equal
    sets (node, key, n_shingles, copies, low, bands)."""
    shingles = Shingles(shingle)
    n_bands = bands_for(percent)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text"):
            sets = [shingles.of(t) for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([band_keys(one_permutation(s, n_bands * ROWS)) if len(s) else None
                           for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "text_key", "key", "n_shingles", "bands"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64("text").alias("text_key"), "text")
    signed = materialize(arrow_map(rows, run, "doc_id bigint, text_key bigint, key binary, "
                                              "n_shingles bigint, bands array<bigint>"), "one-permutation")
    low = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    classes = (signed.filter("key IS NOT NULL").groupBy("key")
               .agg(F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
                    F.min(low).alias("low"), F.first("bands").alias("bands"))
               .withColumn("node", F.monotonically_increasing_id()))
    return signed.drop("bands"), materialize(classes, "set-classes")


def stars(classes: DataFrame) -> DataFrame:
    """center, node: candidate edges, the centre with itself included."""
    rows = classes.select("node", F.explode("bands").alias("band"))
    shared = (rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    met = materialize(rows.join(shared, "band"), "shared-bands")
    degree = met.groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = met.join(degree, "node").select("band", "node", "degree")
    centers = ranked.groupBy("band").agg(F.max_by("node", "degree").alias("center"))
    return materialize(ranked.join(centers, "band").select("center", "node").distinct(), "stars")


def star_sets(docs: DataFrame, classes: DataFrame, edges: DataFrame, shingle: int) -> DataFrame:
    """node, shingles: the full sets of the members of stars, read again from
    one document of each class."""
    wanted = classes.join(edges.select("node").distinct(), "node").select(
        "node", F.col("key").alias("set_key"), F.col("low.doc_id").alias("low_id"),
        F.col("low.text_key").alias("low_key"))
    wanted = small_side(materialize(wanted, "star-members"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64("text").alias("text_key"), "text")
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("low_id"))
                      & (F.col("text_key") == F.col("low_key"))).select("node", "set_key", "text")
    shingles = Shingles(shingle)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text", 2 << 20):
            sets = [shingles.of(t) for t in part.column(2).to_pylist()]
            out = pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])
            keys = part.column(1).to_pylist()
            yield out.filter(pa.array([len(s) > 0 and set_key(s) == k
                                       for s, k in zip(sets, keys, strict=True)]))

    return materialize(arrow_map(texts, run, "node bigint, shingles binary"), "star-sets")


def confirmed_links(edges: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: a forest of the confirmed links of every star."""
    sized = materialize(edges.join(classes.select("node", "n_shingles"), "node"), "sized-stars")
    whole = sized.groupBy("center").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    total = sized.agg(F.sum("n_shingles")).first()[0] or 0
    shares = max(1, ceil(total / BLOCK_SHINGLES))       # small stars share tasks
    is_center = F.col("node") == F.col("center")
    last = F.col("blocks") - 1
    pairs = F.expr("flatten(transform(sequence(0, blocks - 1), "
                   "i -> transform(sequence(i, blocks - 1), j -> struct(i AS first, j AS second))))")
    mine = F.transform(F.sequence(F.lit(0), last), lambda j: F.struct(
        F.least("block", j).alias("first"), F.greatest("block", j).alias("second")))
    dealt = (sized.join(whole.select("center", blocks.alias("blocks")), "center")
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("at", F.explode(F.when(is_center, pairs).otherwise(mine)))
             .select("center", "node", F.when(is_center, -1).otherwise(F.col("block")).alias("block"),
                     F.when(F.col("blocks") > 1, F.col("center")).alias("own"),
                     F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("center"), F.lit(shares)))
                     .alias("share"), "at.first", "at.second"))

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        rows = rows.drop_duplicates(["center", "node"]).sort_values(["center", "block", "node"])
        for _, star in rows.groupby("center", sort=False):
            sets = [np.frombuffer(s, np.uint64) for s in star["shingles"]]
            block, node = star["block"].to_numpy(), star["node"].to_numpy()
            if block[0] != -1:
                raise ValueError("a star without its centre")
            found += [(node[x], node[y]) for x, y in star_links(sets, block, percent)]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return materialize(dealt.join(sets, "node").groupBy("own", "share", "first", "second")
                       .applyInPandas(task, "a bigint, b bigint"), "star-links")


def near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_shingles, component_id, kept
    (the row's doc_id is its component_id), keeper (of rows that are alike, the
    one document to keep)."""
    signed, classes = set_classes(docs, percent, shingle)
    edges = stars(classes)
    links = confirmed_links(edges, classes, star_sets(docs, classes, edges, shingle), percent)
    roots = components(links)
    members = (classes.select("node", "key", "copies", "low").join(roots, "node", "left")
               .withColumn("root", F.coalesce("root", "node")))
    members = materialize(members, "component-members")
    lows = members.groupBy("root").agg(F.min("low").alias("component_low"))
    info = materialize(members.join(lows, "root").select("key", "copies", "component_low"), "components")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    rows = join_hot(signed, info, "key", "copies", signed.count(), "left")
    low = F.coalesce("component_low", own)
    return rows.select("doc_id", "text_key", "n_shingles", low["doc_id"].alias("component_id"),
                       F.col("doc_id").eqNullSafe(low["doc_id"]).alias("kept"),
                       (low == own).alias("keeper"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """The rows of ``docs`` without all but one document of each component, all
    columns; rows that repeat the doc_id and text of the kept one stay."""
    gone = (near_duplicates(docs, percent, shingle).filter(~F.col("keeper"))
            .select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct())
    gone = small_side(materialize(gone, "near-duplicates"))
    return docs.join(gone, docs["doc_id"].cast("bigint").eqNullSafe(gone["gone_id"])
                     & (F.xxhash64(docs["text"]) == gone["gone_key"]), "left_anti")


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document: three-word shingles, 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), 85, 3).drop("text_key", "keeper")


#: The same in DuckDB: all pairs of distinct sets that share a shingle.
OP13_SQL = r"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]))
        END AS s FROM d),
k AS (SELECT doc_id, len(s) AS n, s, md5(array_to_string(s, chr(10))) AS cid FROM s),
c AS (SELECT cid, any_value(s) AS s, any_value(n) AS n, min(doc_id) AS low FROM k WHERE n > 0 GROUP BY cid),
t AS (SELECT cid, n, unnest(s) AS g FROM c),
links AS (SELECT a.cid AS a, b.cid AS b FROM t a JOIN t b ON a.g = b.g AND a.cid <> b.cid
          GROUP BY a.cid, b.cid, a.n, b.n HAVING 185 * count(*) >= 85 * (a.n + b.n)),
r(cid, other) AS (SELECT cid, cid FROM c UNION SELECT r.cid, links.b FROM r JOIN links ON links.a = r.other),
roots AS (SELECT r.cid, min(c.low) AS low FROM r JOIN c ON c.cid = r.other GROUP BY r.cid)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles,
       CASE WHEN k.n = 0 THEN k.doc_id ELSE roots.low END AS component_id,
       CASE WHEN k.n = 0 THEN true ELSE k.doc_id = roots.low END AS kept
FROM k LEFT JOIN roots ON roots.cid = k.cid
"""
