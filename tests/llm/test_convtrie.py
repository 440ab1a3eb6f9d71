import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from eventstar.llm import convtrie as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int"


def brute(rows):
    """The definition on lists of turns."""
    turns = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    lists = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        built[c] = tuple(lists.get(base, [])[:h] + own[h:])
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def below(node):
        stack, out = [node], []
        while stack:
            out.append(stack.pop())
            stack += kids.get(out[-1], [])
        return out

    result = []
    for node, convs in members.items():
        sub = below(node)
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == node)
        result.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                       len(kids.get(node, [])), sum(v not in kids for v in sub),
                       sum((len(members[v]) - 1) * len(v[-1][1].encode().split()) for v in sub if v),
                       hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=str)


def trie(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in C.prefix_trie(df, C.twentieth_rule, 3).collect()), key=str)


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 10 * n), n):
        for turn in range(rng.randrange(1, 7)):
            text = rng.choice(["hi there", "ok", "", None, "a  long\ttext\nof words", f"own {c}"])
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), text, 1))
    return rows


def test_equals_brute_force(spark):
    rows = conversations(1, 120)
    rows += rows[:10] + [(None, 0, "user", "x", 1), (7, 0, "user", "x", 1), (7, 0, "assistant", "x", 1)]
    assert trie(spark, rows) == brute(rows)


def test_copies_and_turnless_conversations(spark):
    # ids of base 0, which has one turn; some borrow more than there are and own fewer than they leave out
    rows = [(0, 0, "user", "shared", 1)]
    rows += [(c, t, "user", f"turn {t}", 1) for c in range(1, 20) for t in range(1 + c % 3)]
    rows += [(c, 0, "user", "only", 1) for c in range(21, 40)]           # base 20 is missing
    want = brute(rows)
    assert trie(spark, rows) == want
    assert any(d == 0 and ends != C.NO_IDS for _, d, *_, ends in want)


def test_a_conversation_over_many_partitions(spark, monkeypatch):
    rows = [(40, t, "user", f"w{t % 7}", 1) for t in range(400)] + [(41, t, "user", f"w{t % 7}", 1) for t in range(300)]
    rows += [(60, 0, "user", "x", 1)]
    monkeypatch.setattr(C, "BLOCK_DEPTHS", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        base = C.bases(0)
        store = C.stored_turns(spark.createDataFrame(rows, SCHEMA), base)
        assert store.select("part").distinct().count() > 1 and C.carried(store, base)
        got = {(r["conv_id"], r["pos"]): (r["h1"], r["h2"])
               for r in C.prefix_fingerprints(store, base).collect()}
        assert sorted(p for c, p in got if c == 40) == list(range(1, 401))
        hashes = C.turn_hashes([b"user"] * 400, [b"w%d" % (t % 7) for t in range(400)])[0]
        want = np.cumsum(hashes * C.powers(base, np.arange(1, 401)) % C.PRIME, axis=0) % C.PRIME
        assert [got[40, p] for p in range(1, 401)] == list(zip(*(x.tolist() for x in C.pack(want))))
        assert trie(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ends_of_one_node_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_IDS", 3)
    rows = [(c, 0, "user", "same", 1) for c in range(0, 4000, 20)]
    assert trie(spark, rows) == brute(rows)


def test_powers_and_composition():
    base = C.bases(1)
    rng = np.random.default_rng(5)
    t = rng.integers(0, C.PRIME, (50, C.LANES))
    h = np.cumsum(t * C.powers(base, np.arange(1, 51)) % C.PRIME, axis=0) % C.PRIME
    for n in (0, 1, 20, 49):
        head = h[n - 1] if n else np.zeros(C.LANES, np.int64)
        rest = np.sum(t[n:] * C.powers(base, np.arange(1, 51 - n)) % C.PRIME, axis=0) % C.PRIME
        assert ((head + C.powers(base, np.array([n]))[0] * rest) % C.PRIME == h[49]).all()
    there = C.powers(base, np.array([3, -3]))
    assert (there[0] * there[1] % C.PRIME == 1).all()
    assert (C.unpack(*C.pack(t)) == t).all()


def test_collided_fingerprints_are_done_again(spark, monkeypatch):
    rows = conversations(2, 30)
    good = C.bases
    # with a zero base all turns of one depth collide
    monkeypatch.setattr(C, "bases", lambda seed: np.zeros(C.LANES, np.int64) if seed == 0 else good(seed))
    assert trie(spark, rows) == brute(rows)


def test_empty_table_and_long_text(spark):
    assert trie(spark, []) == []
    rows = [(1, 0, "user", "word " * 200_000, 1), (2, 0, "user", "word " * 200_000, 1), (0, 0, None, None, 1)]
    assert trie(spark, rows) == brute(rows)
    assert C.prefix_trie(spark.createDataFrame(rows, SCHEMA), lambda c: (c, F.lit(0)), 0).count() == 3
