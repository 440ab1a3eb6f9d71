import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from eventstar.llm import packing as P
from tests.llm.helpers import awkward, docs_frame, prose


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.default_tokenizer())
    return lambda t: tok.encode(t, add_special_tokens=False).ids


def test_ids_equal_those_of_tokenizers(reference):
    tok = P.Tokens(P.default_tokenizer())
    texts = ["", " ", "a  b", "a\n b", " a b", "a \nb", "a b ", "  x", "don't  s 's x's", "\n\n a",
             "é ñ 123 4 ..a, b", "a b c", "<|endoftext|> x <|endoftext|>", "<|endoftext|>",
             "a <|endoftext|>b<|endoftext|> c", "x<|endoftext|><|endoftext|>", "<|endoftext> |", "a  <|endoftext|>  b", "x\t y", "日本 語 　x",
             prose(1, 500), "a'll we'd it"]
    assert [x.tolist() for x in tok.batch(texts)] == [reference(t) for t in texts]
    assert [x.tolist() for x in tok.batch(texts)] == [reference(t) for t in texts]   # from what is kept
    rng = random.Random(3)
    odd = ["".join(rng.choice(" \n\tab.é'1") for _ in range(30)) for _ in range(300)]
    assert [x.tolist() for x in tok.batch(odd)] == [reference(t) for t in odd]


def test_forgetting_kept_chunks_changes_nothing(reference):
    tok = P.Tokens(P.default_tokenizer(), keep=10)
    texts = [prose(i, 40) for i in range(5)]
    assert [x.tolist() for x in tok.batch(texts)] == [reference(t) for t in texts]


def test_cut_leaves_the_short_piece_first():
    assert P.cut(np.zeros(10), 4) == [(0, 2), (2, 4), (6, 4)]
    assert P.cut(np.zeros(8), 4) == [(0, 4), (4, 4)]
    assert P.cut(np.zeros(3), 4) == [(0, 3)]


def exact_least(lengths, capacity):
    """Fewest bins by exhaustive search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                go(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1:]])
        go(i + 1, [*bins, lengths[i]])
    go(0, [])
    return best


def check_packing(lengths, capacity, found):
    used = np.zeros(capacity + 1, int)
    for pattern, times in found:
        assert sum(pattern) <= capacity and times > 0
        for x in pattern:
            used[x] += times
    assert (used == np.bincount(lengths, minlength=capacity + 1)).all()
    return sum(t for _, t in found)


def packed(lengths, capacity, **options):
    counts = np.bincount(lengths, minlength=capacity + 1)
    return check_packing(lengths, capacity, P.complete(counts, capacity, **options))


def plain_best_fit(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(bins) if room >= x]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= x
        else:
            bins.append(capacity - x)
    return len(bins)


def test_bin_completion_is_least_on_small_cases():
    rng = random.Random(1)
    beaten = 0
    for _ in range(10_000):
        capacity = rng.choice([10, 20, 30])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = np.bincount(lengths, minlength=capacity + 1)
        least = exact_least(lengths, capacity)
        assert packed(lengths, capacity) == least >= P.lower_bound(counts, capacity)
        beaten += plain_best_fit(lengths, capacity) > least
    assert beaten
    assert packed([3, 4, 4, 6, 10, 10, 10, 12, 12, 13, 17, 19], 30) == 4
    assert packed([7, 6, 5, 5, 4, 3], 10) == 3


def test_the_incumbent_is_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(500):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 80))]
        found = P.best_fit(np.bincount(lengths, minlength=41), 40)
        assert check_packing(lengths, 40, found) == plain_best_fit(lengths, 40)
        assert packed(lengths, 40, most_steps=0) == plain_best_fit(lengths, 40)


def test_fillings_are_all_undominated_ones():
    counts = np.bincount([6, 5, 4, 4], minlength=14)
    assert list(P.fillings(counts, 13, P.Steps(10**6))) == [(5, 4, 4), (6, 5)]
    assert list(P.fillings(counts, 4, P.Steps(10**6))) == [(4,)]
    assert list(P.fillings(counts, 3, P.Steps(10**6))) == [()]
    rng = random.Random(3)
    for _ in range(300):
        lengths = [rng.randint(1, 12) for _ in range(rng.randint(1, 8))]
        room = rng.randint(1, 20)
        counts = np.bincount(lengths, minlength=21)
        got = list(P.fillings(counts, room, P.Steps(10**7)))
        every = {tuple(sorted((x for i, x in enumerate(lengths) if m >> i & 1), reverse=True))
                 for m in range(1 << len(lengths))}
        fit = {f for f in every if sum(f) <= room}

        def dominated(f):
            rest = list(lengths)
            for x in f:
                rest.remove(x)
            for m in range(1 << len(f)):
                part = [x for i, x in enumerate(f) if m >> i & 1]
                for x in rest:
                    if sum(part) <= x <= sum(part) + room - sum(f) and (x > sum(part) or len(part) > 1):
                        return True
            return False

        want = {f for f in fit if not dominated(f)}
        assert set(got) == ({(room,)} if room in lengths else want) and len(got) == len(set(got))
        assert [sum(f) for f in got] == sorted(map(sum, got), reverse=True)


def test_a_deep_search_keeps_few_tables():
    import tracemalloc
    rng = np.random.default_rng(1)
    counts = np.bincount(np.clip(rng.lognormal(6.2, 0.6, 100_000), 1, P.CAPACITY).astype(int))
    counts = np.concatenate([counts, np.zeros(P.CAPACITY + 1 - len(counts), np.int64)])
    tracemalloc.start()
    try:
        packed = P.complete(counts, most_steps=400_000)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    used = np.zeros_like(counts)
    for pattern, times in packed:
        np.add.at(used, list(pattern), times)
    assert used.tolist() == counts.tolist()
    assert most < 80e6


def test_tables_are_made_again_when_needed(monkeypatch):
    rng = np.random.default_rng(5)
    counts = np.bincount(rng.integers(300, 1100, 60), minlength=P.CAPACITY + 1)
    whole = P.complete(counts, most_steps=50_000)
    monkeypatch.setattr(P, "KEPT", 1)
    assert P.complete(counts, most_steps=50_000) == whole


def test_large_counts_cost_no_more():
    rng = np.random.default_rng(4)
    counts = np.zeros(P.CAPACITY + 1, np.int64)
    counts[1:] = rng.integers(0, 10**9, P.CAPACITY)
    found = P.complete(counts)
    assert sum(t * sum(p) for p, t in found) == (counts * np.arange(len(counts))).sum()
    assert sum(t for _, t in found) <= 1.005 * P.lower_bound(counts, P.CAPACITY) + 1


def test_placement_is_whole_and_gapless(spark, reference):
    docs = awkward(spark, clash="rank")
    rows = P.pack(docs, P.default_tokenizer(), 64).collect()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(np.array([*reference(r.text or ""), 0], "<u4"))
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
        ids = texts[r.doc_id][0]
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for doc_id, pieces in by_doc.items():
        assert sum(p.length for p in pieces) == sum(map(len, texts[doc_id]))
    assert set(by_doc) == set(texts)
    assert P.pack(docs_frame(spark, []), P.default_tokenizer()).count() == 0
