"""Prefix trie of rebuilt conversations by composable fingerprints.

A conversation is rebuilt from the first ``head`` turns of its base
conversation and its own turns behind its first ``head``.  Rebuilt texts are
never made: a sequence of turns has the fingerprint (length n, H), H the sum of
turn hash x C**place modulo 2**31 - 1 in four lanes, and sequences compose as
(n, H) * (m, G) = (n + m, H + C**n G).  So the fingerprint of any rebuilt
prefix is that of a base head times that of a slice of own turns, which is a
difference of two prefix fingerprints of the stored conversation.

* Turns are sorted by range; each partition scans its own rows, and what runs
  on from the partition before is composed in front (a row per partition).  A
  conversation of any length is thus dealt over tasks.
* A (conversation, depth) pair refers to a stored turn.  Pairs of one depth and
  fingerprint are a node; the node is verified through these references: all
  must name turns of equal digest and the same parent.  If one does not, all
  is done again with another C.
* The smallest member of a node owns it.  A conversation owns the lower end of
  its path, so sums over subtrees are sums over members: each member adds all
  that it owns, the owner only what lies in the subtree.  There is a leaf per
  conversation that owns one.  Nothing is iterated by depth.
* The ids that end at a node are sorted and joined in blocks by range; the
  blocks of a node, digits only, are read in order into one SHA-256, which can
  only be computed in sequence.

Turns are equal if role and text are; their digest is SHA-256.  Defined
results: turns of one place (a repeated or null ``turn``) are ordered by role
and text; null role and text are empty; rows without a conv_id are no
conversation; repeated rows are turns of their own; a missing base has no
turns; extra columns are not read; an empty table gives no node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, join_hot, materialize, table

PRIME, LANES = (1 << 31) - 1, 4
BLOCK_IDS, BLOCK_DEPTHS = 4096, 100_000
ATTEMPTS = 3
NODE = ["depth", "k1", "k2"]
NO_IDS = sha256(b"").hexdigest()


# -------------------------------------------------------------- fingerprints

def bases(seed: int) -> np.ndarray:
    return np.random.default_rng([12, seed]).integers(1 << 20, PRIME, LANES)


def powers(base: np.ndarray, exponent: np.ndarray) -> np.ndarray:
    """(n, LANES) powers modulo PRIME; negative exponents invert."""
    e = exponent.astype(np.int64) % (PRIME - 1)
    out = np.ones((len(e), LANES), np.int64)
    square = base.astype(np.int64)
    for bit in range(int(e.max(initial=0)).bit_length()):
        out = np.where((e >> bit & 1)[:, None] == 1, out * square % PRIME, out)
        square = square * square % PRIME
    return out


def unpack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = (1 << 31) - 1
    return np.stack([a >> 31, a & low, b >> 31, b & low], axis=1)


def pack(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return h[:, 0] << 31 | h[:, 1], h[:, 2] << 31 | h[:, 3]


def turn_hashes(roles: list[bytes], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(n, LANES) turn hashes, and (n, 2) words of the other half of the digests."""
    digests = b"".join(sha256(b"%d:" % len(r) + r + t).digest() for r, t in zip(roles, texts, strict=True))
    halves = np.frombuffer(digests, np.uint32).reshape(-1, 8)[:, :LANES].astype(np.int64) % PRIME
    return halves, np.frombuffer(digests, np.int64).reshape(-1, 4)[:, 2:]


# ---------------------------------------------------------------- turn store

def stored_turns(conversations: DataFrame, base: np.ndarray) -> DataFrame:
    """part, conv_id, at, h1, h2 (fingerprint of the rows of this conversation
    in this partition up to here), t1, t2, v1, v2 (the turn), n_words."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # sampled bounds hold the first characters only; equal ones stay together
    ordered = (rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, 32), F.substring("text", 1, 32))
               .sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last_conv, last_at, last_h = None, 0, np.zeros(LANES, np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column(0).to_numpy()
            texts = batch.column(3).cast(pa.binary()).to_pylist()
            t, v = turn_hashes(batch.column(2).cast(pa.binary()).to_pylist(), texts)
            starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            run_of = np.cumsum(np.r_[0, conv[1:] != conv[:-1]])
            at = np.arange(n) - starts[run_of] + 1
            goes_on = conv[0] == last_conv
            if goes_on:
                at[run_of == 0] += last_at
            sums = np.cumsum(t * powers(base, at) % PRIME, axis=0)
            before = np.r_[np.zeros((1, LANES), np.int64), sums][starts]
            h = sums - before[run_of]
            if goes_on:
                h[run_of == 0] += last_h
            h %= PRIME
            last_conv, last_at, last_h = conv[-1], at[-1], h[-1]
            (h1, h2), (t1, t2) = pack(h), pack(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), batch.column(0), pa.array(at), pa.array(h1),
                 pa.array(h2), pa.array(t1), pa.array(t2), pa.array(v[:, 0]), pa.array(v[:, 1]),
                 pa.array([len(x.split()) for x in texts], pa.int64())],
                ["part", "conv_id", "at", "h1", "h2", "t1", "t2", "v1", "v2", "n_words"])

    return materialize(ordered.mapInArrow(
        run, "part int, conv_id bigint, at bigint, h1 bigint, h2 bigint, t1 bigint, t2 bigint, "
             "v1 bigint, v2 bigint, n_words bigint"), "turn-store")


def carried(store: DataFrame, base: np.ndarray) -> list[tuple]:
    """part, conv_id, turns and fingerprint of the conversation that goes on
    from the partitions before; a row per partition at most."""
    edges = store.groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"))
    tails = (store.join(F.broadcast(edges), "part").filter("conv_id = last")
             .groupBy("part", "first", "last")
             .agg(F.max("at").alias("n"), F.max_by("h1", "at").alias("h1"), F.max_by("h2", "at").alias("h2"))
             .orderBy("part").collect())
    out, before = [], None                     # (conv_id, turns, fingerprint) at the end of the part before
    for r in tails:
        h = unpack(np.array([r["h1"]]), np.array([r["h2"]]))
        if before and before[0] == r["first"]:
            out.append((r["part"], r["first"], before[1], *(int(x[0]) for x in pack(before[2]))))
            if r["last"] == r["first"]:
                h = (before[2] + powers(base, np.array([before[1]])) * h) % PRIME
                before = (r["last"], before[1] + r["n"], h)
                continue
        before = (r["last"], r["n"], h)
    return out


def prefix_fingerprints(store: DataFrame, base: np.ndarray) -> DataFrame:
    """conv_id, pos, h1, h2 (fingerprint of the conversation's first pos
    turns), t1, t2, v1, v2, n_words."""
    spark = store.sparkSession
    carry = spark.createDataFrame(carried(store, base),
                                  "part int, conv_id bigint, c_n bigint, c1 bigint, c2 bigint")
    both = store.join(F.broadcast(carry), ["part", "conv_id"], "left").select(
        "conv_id", "at", "h1", "h2", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("c_n", "c1", "c2")),
        "t1", "t2", "v1", "v2", "n_words")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, h1, h2, c_n, c1, c2 = (batch.column(i).to_numpy() for i in range(1, 7))
        h1, h2 = pack((unpack(c1, c2) + powers(base, c_n) * unpack(h1, h2)) % PRIME)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(at + c_n), pa.array(h1), pa.array(h2),
             *(batch.column(i) for i in range(7, 12))],
            ["conv_id", "pos", "h1", "h2", "t1", "t2", "v1", "v2", "n_words"])

    return arrow_map(both, run, "conv_id bigint, pos bigint, h1 bigint, h2 bigint, t1 bigint, t2 bigint, "
                                "v1 bigint, v2 bigint, n_words bigint")


# -------------------------------------------------------------------- pairs

def rebuilt_pairs(turns: DataFrame, rule: Callable[[Column], tuple[Column, Column]], max_head: int,
                  base: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length of the rebuilt one), and a row for every
    rebuilt conversation and depth: conv_id, depth, k1, k2 (fingerprint), p1, p2
    (of the depth before), v1, v2, n_words (of the turn referred to)."""
    base_id, head = rule(F.col("conv_id"))
    convs = materialize(turns.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))
                        .select("conv_id", "n_turns", base_id.cast("bigint").alias("base_id"),
                                head.cast("bigint").alias("head")), "conversations")
    first = materialize(turns.filter(F.col("pos") <= max_head), "head-turns")
    heads = first.withColumnRenamed("conv_id", "base_id")
    borrowed = convs.select("conv_id", "base_id", "head").join(heads, "base_id").filter("pos <= head")
    lent = borrowed.groupBy("conv_id").agg(F.max("pos").alias("lent"), F.max_by("h1", "pos").alias("b1"),
                                           F.max_by("h2", "pos").alias("b2"))
    own_head = first.select("conv_id", F.col("pos").alias("head"), F.col("h1").alias("o1"),
                            F.col("h2").alias("o2"))
    frame = convs.join(lent, "conv_id", "left").join(own_head, ["conv_id", "head"], "left").select(
        "conv_id", "n_turns", "head",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("lent", "b1", "b2", "o1", "o2")))
    frame = materialize(frame.withColumn(
        "length", F.col("lent") + F.greatest(F.lit(0), F.col("n_turns") - F.col("head"))), "frames")
    total = frame.agg(F.sum("n_turns")).first()[0] or 0
    of_turn = ["h1", "h2", "t1", "t2", "v1", "v2", "n_words"]
    own = (join_hot(turns.filter(F.col("pos") > rule(F.col("conv_id"))[1]), frame, "conv_id", "n_turns", total)
           .select("conv_id", "pos", *of_turn, "head", "lent", "b1", "b2", "o1", "o2"))
    zero = F.lit(0).cast("bigint")
    both = own.unionByName(borrowed.select(
        "conv_id", "pos", *of_turn, *(zero.alias(c) for c in ("head", "lent", "b1", "b2", "o1", "o2"))))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        col = {name: batch.column(i).to_numpy() for i, name in enumerate(batch.schema.names)}
        lent, depth = col["lent"], col["lent"] + col["pos"] - col["head"]
        # base head times (own head's inverse times own prefix)
        suffix = (unpack(col["h1"], col["h2"]) - unpack(col["o1"], col["o2"])) % PRIME
        h = (unpack(col["b1"], col["b2"]) + powers(base, lent - col["head"]) * suffix) % PRIME
        parent = (h - unpack(col["t1"], col["t2"]) * powers(base, depth)) % PRIME
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(depth), *(pa.array(x) for x in (*pack(h), *pack(parent))),
             *(pa.array(col[c]) for c in ("v1", "v2", "n_words"))],
            ["conv_id", "depth", "k1", "k2", "p1", "p2", "v1", "v2", "n_words"])

    pairs = arrow_map(both, run, "conv_id bigint, depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, "
                                 "v1 bigint, v2 bigint, n_words bigint")
    return frame.select("conv_id", "length"), materialize(pairs, "rebuilt-pairs")


def verified_nodes(convs: DataFrame, pairs: DataFrame) -> DataFrame | None:
    """depth, k1, k2, p1, p2, conv_id, n_convs, cost of every node; None if the
    references of one disagree."""
    same = ["p1", "p2", "v1", "v2"]
    nodes = pairs.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("n_words").alias("n_words"), *(F.min(c).alias(c) for c in same),
        *(F.max(c).alias(f"{c}_max") for c in same))
    nodes = materialize(nodes, "nodes")
    if not nodes.filter(" OR ".join(f"{c} <> {c}_max" for c in same)).isEmpty():
        return None
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(*(zero.alias(c) for c in (*NODE, "p1", "p2")), "conv_id", "n_convs", zero.alias("n_words"))
    return (nodes.select(*NODE, "p1", "p2", "conv_id", "n_convs", "n_words").unionByName(root)
            .withColumn("cost", (F.col("n_convs") - 1) * F.col("n_words")).drop("n_words"))


# ----------------------------------------------------------------- per node

def ends_digest(ends: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256: SHA-256 of the sorted conv_ids of each node,
    joined by commas."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            ids = batch.column(3).to_pylist()
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            cuts = [c for s, e in zip(starts, np.r_[starts[1:], len(ids)], strict=True)
                    for c in range(s, e, BLOCK_IDS)]
            spans = list(zip(cuts, [*cuts[1:], len(ids)], strict=True))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(key[cuts, i]) for i in range(3)), pa.array([ids[s] for s, _ in spans], pa.int64()),
                 pa.array([",".join(map(str, ids[s:e])) for s, e in spans], pa.string())],
                [*NODE, "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *here, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here == key:
                    state.update(b"," + ids.encode())
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = here, sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)],
                                                 [*NODE, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())],
                                             [*NODE, "ends_sha256"])

    node = "depth bigint, k1 bigint, k2 bigint"
    rows = ends.select(*NODE, "conv_id")
    joined = (rows.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
              .mapInArrow(blocks, f"{node}, first bigint, ids string"))
    return (joined.repartition(*NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(digests, f"{node}, ends_sha256 string"))


def owned_before(nodes: DataFrame) -> DataFrame:
    """depth, k1, k2, before: the cost of what a node's owner owns above it.
    Sums run within blocks of depths, so a long path is no single group."""
    rows = nodes.withColumn("block", F.floor(F.col("depth") / BLOCK_DEPTHS))
    above = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("cost").alias("in_block"))
    offset = blocks.withColumn("offset", F.sum("in_block").over(
        Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    return (rows.withColumn("here", F.sum("cost").over(above))
            .join(offset.drop("in_block"), ["conv_id", "block"])
            .select(*NODE, (F.coalesce("here", F.lit(0)) + F.coalesce("offset", F.lit(0))).alias("before")))


def prefix_trie(conversations: DataFrame, rule: Callable[[Column], tuple[Column, Column]],
                max_head: int) -> DataFrame:
    """The nodes of the trie of rebuilt conversations: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rule`` gives of a conv_id column the base's id and the number of turns
    (at most ``max_head``) that are taken from it and left out of the own ones.
    """
    for seed in range(ATTEMPTS):
        base = bases(seed)
        turns = prefix_fingerprints(stored_turns(conversations, base), base)
        convs, pairs = rebuilt_pairs(turns, rule, max_head, base)
        nodes = verified_nodes(convs, pairs)
        if nodes is not None:
            break
    else:
        raise ArithmeticError(f"fingerprints collided with {ATTEMPTS} bases")
    children = (nodes.filter("depth > 0")
                .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    nodes = materialize(nodes.join(children, NODE, "left")
                        .withColumn("n_children", F.coalesce("n_children", F.lit(0))), "family")
    total = nodes.count()
    parents = nodes.filter("n_children > 0").select(
        F.struct(*NODE).alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below = nodes.filter("depth > 0").select(*NODE, F.struct(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).alias("parent"))
    named = join_hot(below, parents, "parent", "n_children", total).select(*NODE, "parent_conv_id")
    owned = (nodes.groupBy("conv_id").agg(F.sum("cost").alias("owned"),
                                          F.count_if(F.col("n_children") == 0).alias("leaves"))
             .filter("owned > 0 OR leaves > 0"))
    owned = materialize(owned.join(convs, "conv_id"), "owners")
    met = join_hot(pairs.select("conv_id", *NODE), owned, "conv_id", "length", pairs.count())
    zero = F.lit(0).cast("bigint")
    sums = (met.groupBy(*NODE).agg(F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves"))
            .unionByName(owned.agg(F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves"))
                         .select(*(zero.alias(c) for c in NODE), "owned", "leaves")))
    ends = (pairs.join(convs.withColumnRenamed("length", "depth"), ["conv_id", "depth"])
            .select(*NODE, "conv_id").unionByName(
                convs.filter("length = 0").select(*(zero.alias(c) for c in NODE), "conv_id")))
    out = (nodes.join(named, NODE, "left").join(sums, NODE).join(owned_before(nodes), NODE)
           .join(ends_digest(ends), NODE, "left"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                      F.col("leaves").alias("n_leaves"), (F.col("owned") - F.col("before")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))


def twentieth_rule(conv_id: Column) -> tuple[Column, Column]:
    """The base is the last id that 20 divides; the head is crc32 modulo 4."""
    return conv_id - conv_id % 20, F.crc32(conv_id.cast("string")) % 4


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"), twentieth_rule, 3)


#: The same in DuckDB: rebuilt conversations as lists, prefixes as text.
OP12_SQL = r"""
WITH RECURSIVE
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc(conv_id, s, i, x) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT conv_id, s, i + 1, CASE WHEN i % 9 = 0 THEN xor(x, CAST(ascii(s[i // 9 + 1]) AS BIGINT))
         ELSE xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END) END
  FROM crc WHERE i < 9 * length(s)),
heads AS (SELECT conv_id, xor(x, CAST(4294967295 AS BIGINT)) % 4 AS h FROM crc WHERE i = 9 * length(s)),
lists AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                 ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
built AS (SELECT o.conv_id, list_concat(coalesce(b.l[1:h], []), o.l[h + 1:]) AS l
          FROM lists o JOIN heads USING (conv_id)
          LEFT JOIN lists b ON b.conv_id = o.conv_id - o.conv_id % 20),
m AS (SELECT conv_id, len(l) AS n, d, md5(CAST(to_json(l[1:d]) AS VARCHAR)) AS k,
             CASE WHEN d > 0 THEN md5(CAST(to_json(l[1:d - 1]) AS VARCHAR)) END AS p,
             CASE WHEN d > 0 THEN len(regexp_extract_all(l[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w
      FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM built)),
nodes AS (SELECT d, k, any_value(p) AS p, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                                 FILTER (WHERE n = d), '')) AS ends
          FROM m GROUP BY d, k),
kids AS (SELECT p AS k, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY p, d - 1),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children
               FROM nodes LEFT JOIN kids ON kids.k = nodes.k AND kids.d = nodes.d),
up(d, k, leaf, cost, ad, ak) AS (
  SELECT d, k, (n_children = 0)::INT, (n_convs - 1) * w, d, k FROM full_nodes
  UNION ALL
  SELECT up.d, up.k, leaf, cost, ad - 1, nodes.p
  FROM up JOIN nodes ON nodes.k = up.ak AND nodes.d = up.ad WHERE ad > 0),
sums AS (SELECT ad AS d, ak AS k, sum(leaf) AS n_leaves, sum(cost) AS saved FROM up GROUP BY ad, ak)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, par.conv_id AS parent_conv_id,
       CAST(n.n_convs AS BIGINT) AS n_convs, CAST(n.n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM full_nodes n JOIN sums ON sums.d = n.d AND sums.k = n.k
LEFT JOIN nodes par ON par.k = n.p AND par.d = n.d - 1
"""
