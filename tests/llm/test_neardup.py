import random

import numpy as np
import pytest

from eventstar.llm import neardup as N
from tests.llm.helpers import awkward, docs_frame, prose


def shingle_set(text, size):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(texts, percent, size):
    """Component (smallest index) of each text."""
    sets = [shingle_set(t, size) for t in texts]
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in text.split())


def test_equals_brute_force_on_chains_and_hubs(spark):
    texts = []
    for group in range(4):
        base = prose(100 + group, 150 + 100 * group)
        texts += [edited(base, share / 1000, 7 * group + share) for share in range(0, 120, 6)]
        chain = base
        for step in range(5):
            chain = edited(chain, 0.02, 50 * group + step)
            texts.append(chain)
    texts += [prose(900 + i, 40) for i in range(20)] + ["one", "one", "One", "one two", "A  b\tc", "a b c"]
    random.Random(3).shuffle(texts)
    for percent, size in ((85, 3), (80, 5)):
        got = {r["doc_id"]: r for r in N.near_duplicates(docs_frame(spark, texts), percent, size).collect()}
        roots, sizes = brute(texts, percent, size)
        assert [got[i]["component_id"] for i in range(len(texts))] == roots
        assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
        assert [got[i]["kept"] for i in range(len(texts))] == [r == i for i, r in enumerate(roots)]
        assert len(set(roots)) > 20 and max(np.bincount(roots)) > 5


def test_blocks_of_a_large_star_give_the_same(spark, monkeypatch):
    base = prose(5, 120)
    texts = [edited(base, 0.002 * i, i) for i in range(60)]
    monkeypatch.setattr(N, "BLOCK_NODES", 7)
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(docs_frame(spark, texts), 85, 3).collect()}
    assert [got[i] for i in range(60)] == brute(texts, 85, 3)[0]


def test_star_links_are_those_of_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(200):
        hub = np.sort(rng.choice(10**6, 40, False).astype(np.uint64))
        sets = [hub] + [np.unique(np.where(rng.random(40) < rng.choice([0, .05, .1, .2]), rng.integers(0, 10**6, 40),
                                           hub).astype(np.uint64)) for _ in range(8)]
        up = list(range(9))
        for _ in range(9):
            for i in range(9):
                for j in range(9):
                    inter = len(np.intersect1d(sets[i], sets[j]))
                    if 100 * inter >= 85 * (len(sets[i]) + len(sets[j]) - inter):
                        up[i] = up[j] = min(up[i], up[j])
        block = np.r_[-1, np.zeros(8, int)]
        forest = N.Forest(9)
        for a, b in N.star_links(sets, block, 85):
            forest.link(a, b)
        assert [forest.root(i) for i in range(9)] == up
        # two blocks: each alone, and across
        block = np.r_[-1, np.arange(8) % 2]
        forest = N.Forest(9)
        for part in ([0], [1], [0, 1]):
            at = np.r_[0, np.flatnonzero(np.isin(block, part))]
            for a, b in N.star_links([sets[i] for i in at], block[at], 85):
                forest.link(int(at[a]), int(at[b]))
        assert [forest.root(i) for i in range(9)] == up


def test_densified_bins_agree_as_often_as_sets_do():
    rng = np.random.default_rng(2)
    for n in (1, 3, 20, 2000):
        seen = []
        for _ in range(60):
            both = np.unique(rng.integers(0, 1 << 63, n * 4, np.uint64))
            a, b = both[rng.permutation(len(both))[:max(1, len(both) * 3 // 4)]], both
            sa, sb = (N.one_permutation(np.sort(x), 384) for x in (a, b))
            assert np.isin(sa, a).all()
            seen.append((sa == sb).mean())
        assert abs(np.mean(seen) - max(1, n * 3) / (n * 4)) < 0.05
    assert N.bands_for(85) > 40 and (1 - 0.85 ** N.ROWS) ** N.bands_for(85) <= N.MISS


@pytest.mark.parametrize("clash", ["text_key", "node", "key", "gone_id"])
def test_awkward_rows(spark, clash):
    docs = awkward(spark, clash)
    rows = N.near_duplicates(docs, 85, 3).collect()
    assert len(rows) == docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], r)
    assert all(by_id[i]["n_shingles"] == 0 and by_id[i]["component_id"] == i and by_id[i]["kept"]
               for i in (0, 1, 2))                                   # null, empty, blank
    assert by_id[3]["n_shingles"] == by_id[4]["n_shingles"] - 1 == 1
    assert by_id[6]["component_id"] == 5 and not by_id[6]["kept"]
    assert by_id[None]["component_id"] == 11 and not by_id[None]["kept"]
    kept = N.drop_near_duplicates(docs, 85, 3)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect())
    assert [i for none, i in ids if not none] == [0, 1, 2, 3, 4, 5, 7, 7, 8, 9, 10, 11]


def test_empty_table(spark):
    docs = docs_frame(spark, [])
    assert N.near_duplicates(docs).count() == 0 and N.drop_near_duplicates(docs).count() == 0
