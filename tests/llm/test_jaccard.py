import itertools
import random
import string

import numpy as np
import pytest

from eventstar.llm import jaccard as J
from eventstar.llm.components import components
from tests.llm.helpers import awkward, docs_frame, prose

CLEAN = str.maketrans(dict.fromkeys(string.punctuation, " "))


def shingles(text):
    w = (text or "").lower().translate(CLEAN).split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(texts):
    sets = [shingles(t) for t in texts]
    up, links = list(range(len(texts))), [0] * len(texts)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
            links[a] += 1
            links[b] += 1
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (root(i), links[i]) for i in range(len(texts))}


def variants():
    rng = random.Random(9)
    texts = []
    for g in range(6):
        base = prose(300 + g, 60 + 60 * g).split()
        for _ in range(rng.randint(1, 25)):
            w = list(base)
            for _ in range(rng.randint(0, 3 + g)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(999)}"
            texts.append(" ".join(w))
    texts += [None, "", "a b", "a b", "A, b!", "a b c", " . ", prose(400, 5000), prose(400, 5000) + " tail"]
    return texts


@pytest.mark.parametrize("block", [J.BLOCK_CLASSES, 4])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK_CLASSES", block)
    texts = variants()
    docs = docs_frame(spark, texts, clash="node")
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.near_duplicates(docs).collect()}
    assert got == brute(texts)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, (c, _) in got.items() if i == c]


def test_shuffled_sides_give_the_same(spark, monkeypatch):
    texts = variants()[-30:]
    docs = docs_frame(spark, texts)
    want = sorted(map(str, J.near_duplicates(docs).collect()))
    monkeypatch.setattr(J, "small_side", lambda df, rows=None: df)
    assert sorted(map(str, J.near_duplicates(docs).collect())) == want


def test_awkward_rows(spark):
    docs = awkward(spark, clash="signature")
    rows = J.near_duplicates(docs).collect()
    assert len(rows) == 14
    by = {r.doc_id: r for r in rows}
    assert (by[5].n_links, by[6].class_id, by[7].n_copies) == (1, 5, 2)
    assert by[None].class_id == 11 and by[0].n_links == by[1].n_links == 0
    kept = J.keep_one(docs).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11]
    assert J.near_duplicates(docs_frame(spark, [])).count() == 0
    assert J.keep_one(docs_frame(spark, [])).count() == 0


def test_one_doc_id_with_two_texts(spark):
    docs = docs_frame(spark, [prose(1, 50), prose(2, 50), prose(1, 50)]).selectExpr(
        "CASE WHEN doc_id = 2 THEN 9 ELSE 1 END AS doc_id", "text", "lang", "source", "n_chars")
    assert sorted((r.doc_id, r.n_links) for r in J.near_duplicates(docs).collect()) == [
        (1, 0), (1, 1), (9, 1)]
    assert sorted(r.text for r in J.keep_one(docs).collect()) == sorted([prose(1, 50), prose(2, 50)])


def test_pruning_keeps_pairs_at_the_threshold():
    """At similarity 0.8 a pair fails a step with about the tolerance."""
    from math import comb
    for n, need in zip(range(J.STEP, J.HASHES + 1, J.STEP), J.least_matches(0.8), strict=True):
        missed = sum(comb(n, k) * 0.8 ** k * 0.2 ** (n - k) for k in range(need))
        assert missed < 10 * J.TOLERANCE
    assert J.least_matches(0.8)[-1] > 0.5 * J.HASHES       # and drops what is clearly below


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 3000, np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:])
    same = (J.minhashes(a) == J.minhashes(b)).mean()
    assert abs(same - 0.5) < 0.15
    assert (J.minhashes(a, chunk=7) == J.minhashes(a)).all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(1000, 1200)] + [(5000, k) for k in range(5001, 5300)] + [(7, 7)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in
           components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in up}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
