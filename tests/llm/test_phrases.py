import random
import re
from collections import Counter

import numpy as np

from eventstar.llm import phrases as P
from tests.llm.helpers import awkward_texts, docs_frame

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, max_words, min_count, top, percent=100):
    """The definition, counted phrase by phrase."""
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i:i + k])] += 1
    frequent = {p: c for p, c in counts.items() if c >= min_count}
    inside = {}
    for (lang, w), c in frequent.items():
        for i in range(len(w)):
            for j in range(i + 1, len(w) + 1):
                if j - i < len(w):
                    part = lang, w[i:j]
                    inside[part] = max(inside.get(part, 0), c)
    out = []
    for lang in n:
        found = []
        for (other, w), a in frequent.items():
            if other != lang or len(w) < 2 or 100 * inside.get((lang, w), 0) >= percent * a:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k,
                                  counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w)))
            found.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").repartition(5)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in P.mine_phrases(frame(spark, rows), **options).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "a", "Zürich", "New", "york", "city", "x\x00y", "日本", "é"]
    stock = ["New York City", "in the middle of the night", "to be or", "of of of"]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice(stock) if rng.random() < 0.3 else rng.choice(words))
            parts.append(rng.choice([" ", " ", "  ", "\t", ". ", ",", "\r\n", " ;"]))
        texts.append("".join(parts))
    return [(rng.choice(["en", "de", None, "und"]), t) for t in texts]


def test_equals_brute_force(spark):
    rows = corpus(1, 400) + [("en", None), (None, ""), ("fr", " \n"), ("fr", "seul")]
    for options in ({"min_count": 5, "max_words": 5, "top": 50}, {"min_count": 3, "max_words": 3, "top": 4},
                    {"min_count": 4, "max_words": 4, "top": 30, "subsumed_percent": 60}):
        percent = options.get("subsumed_percent", 100)
        want = brute(rows, options["max_words"], options["min_count"], options["top"], percent)
        assert mined(spark, rows, **options) == want and len(want) > 5


def test_stripes_add_up_however_they_are_cut(spark, monkeypatch):
    rows = corpus(2, 300)
    want = brute(rows, 5, 3, 100)
    monkeypatch.setattr(P, "SLICE_BYTES", 200)          # many partial stripes
    assert mined(spark, rows, min_count=3, top=100) == want
    monkeypatch.setattr(P, "HOT_SHARE", 100_000)        # every prefix in segments
    assert mined(spark, rows, min_count=3, top=100) == want
    monkeypatch.setattr(P, "MAX_FILTER_BITS", 6)        # a filter that lets all pass
    assert mined(spark, rows, min_count=3, top=100) == want


def test_prefix_totals_are_the_counts_of_prefixes(spark):
    rows = corpus(3, 300)
    levels = P.mined_stripes(frame(spark, rows), 3, 5)
    counts = {(r["lang"], r["phrase"]): r["f"] for r in P.extensions(levels[0]).collect()}
    totals = Counter()
    for r in levels[1].collect():
        totals[r["lang"], r["prefix"]] += r["total"]
    assert totals == counts


def test_equal_hashes_do_not_merge_prefixes(monkeypatch):
    monkeypatch.setattr(P, "chain", lambda h, size: np.zeros(len(h) - size + 1, np.uint64))
    every = P.Filter(np.full(16, ~np.uint64(0)))
    ids, words = P.encode([b"a b c a b d x b c"])
    out = P.longer_stripes("en", ids, words, 2, every, np.zeros(0, np.uint64))
    got = {p: dict(zip(n, c)) for p, n, c in zip(*(out.column(i).to_pylist() for i in (1, 3, 4)))}
    assert got == {"a b": {"c": 1, "d": 1}, "b c": {"a": 1, "": 1}, "c a": {"b": 1}, "b d": {"x": 1},
                   "d x": {"b": 1}, "x b": {"c": 1}}


def test_wide_products(spark):
    big = 9 * 10**13
    row = spark.createDataFrame([(big, big + 1, big + 2, 10**15)], "a bigint, l bigint, r bigint, n bigint")
    assert row.selectExpr(f"{P.SCORE} AS s").first()[0] == 1000 * big * 10**15 // ((big + 1) * (big + 2))


def test_awkward_and_empty(spark):
    texts = awkward_texts() * 20
    docs = docs_frame(spark, texts, "prefix")
    want = brute([("en", t) for t in texts], 5, 20, 2000)
    assert sorted(tuple(r) for r in P.mine_phrases(docs, min_count=20).collect()) == want and want
    assert mined(spark, [("en", "a b"), ("de", None)]) == []
    assert P.mine_phrases(docs_frame(spark, [])).count() == 0
