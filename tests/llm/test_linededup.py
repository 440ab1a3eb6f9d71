import random
import re

import pytest

from eventstar.llm import linededup as L
from tests.llm.helpers import awkward, docs_frame, prose


def tokens(line):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """rows: (doc_id, text), doc_ids distinct."""
    seen, out = [], {}
    for doc_id, text in sorted(rows):
        kept = []
        for no, line in enumerate((text or "").split("\n")):
            t = tokens(line)
            if not any(len(t & s) * 9 >= 4 * (len(t) + len(s)) for s in seen if t):
                kept.append(line)
            if t:
                seen.append(t)
        out[doc_id] = None if text is None else "\n".join(kept)
    return out


def corpus():
    rng = random.Random(6)
    pool = [prose(500 + i, rng.randint(1, 60), 99) for i in range(25)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = rng.choice(pool).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"q{rng.randrange(99)}"
            if rng.random() < 0.2:
                w = w[rng.randint(0, 3):]
            lines.append(rng.choice(["", " "]) + " ".join(w))
        texts.append("\n".join(lines))
    return [*texts, None, "", "\n\n", "A b", "a, B.", pool[0].upper(), prose(1, 4000, 9999)]


def test_against_brute_force(spark):
    texts = corpus()
    docs = docs_frame(spark, texts, clash="line_no")
    cleaned = L.remove_duplicate_lines(docs, removed_count="gone")
    got = {r.doc_id: r.text for r in cleaned.collect()}
    assert got == brute(list(enumerate(texts)))
    assert cleaned.columns == [*docs.columns, "gone"]
    left = L.remove_duplicate_lines(docs, drop_emptied=True).collect()
    assert {r.doc_id for r in left} == {
        i for i, t in got.items() if t == texts[i] or any(map(tokens, t.split("\n")))}


def test_shuffled_sides_give_the_same(spark, monkeypatch):
    texts = corpus()[:20]
    monkeypatch.setattr(L, "small_side", lambda df, rows=None: df)
    got = {r.doc_id: r.text for r in L.remove_duplicate_lines(docs_frame(spark, texts)).collect()}
    assert got == brute(list(enumerate(texts)))


def test_awkward_rows(spark):
    docs = awkward(spark, clash="c1")
    got = L.remove_duplicate_lines(docs).collect()
    texts = {r.doc_id: r.text for r in got}
    assert len(got) == 14
    assert texts[0] is None and texts[6] == "" and texts[8] == "same line of five words."
    assert texts[11] == "" and texts[None] == prose(3, 60)         # a null doc_id comes first
    assert [r.text for r in got if r.doc_id == 7] == [prose(2, 3000)] * 2
    assert L.remove_duplicate_lines(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 40])
def test_token_sets(spark, n):
    line = prose(7, n, 99)
    frame = spark.createDataFrame([(line,)], "line string")
    row = L.with_tokens(frame, L.rarity(frame.selectExpr("1 AS doc_id", "line AS text"))).first()
    assert len(row.tokens) == len(set(row.tokens)) == len(tokens(line))


def test_no_python_in_the_plan(spark, capsys):
    L.remove_duplicate_lines(docs_frame(spark, corpus()[:5])).explain()
    assert not re.search("Python|Pandas|Arrow|Cartesian", capsys.readouterr().out)


def test_candidates_of_a_group_of_near_copies_grow_with_it(spark, monkeypatch):
    base = prose(11, 60, 9999).split()
    texts = [" ".join([*base[:-1], f"end{i}"]) for i in range(80)] + [prose(12, 40, 9999)]
    rows, write = [], L.materialize

    def counted(df, name):
        out = write(df, name)
        rows.append((name, out.count()))
        return out

    monkeypatch.setattr(L, "materialize", counted)
    got = {r.doc_id: r.text for r in L.remove_duplicate_lines(docs_frame(spark, texts)).collect()}
    assert got == brute(list(enumerate(texts)))
    # all pairs of the group are 3,160
    assert 79 <= sum(n for name, n in rows if name == "line-pairs") <= 79 * L.FIRST_PARTNERS


def test_lines_that_found_no_early_partner_meet_the_others(spark):
    # the two earliest classes of the common passage resemble neither late line
    passage, tail = prose(13, 30, 9999), prose(14, 40, 9999)
    texts = [f"{prose(20 + i, 40, 9999)} {passage}" for i in range(6)]
    texts += [f"{passage} {tail}", f"{passage} {tail} once", f"{passage} {tail} more"]
    got = {r.doc_id: r.text for r in L.remove_duplicate_lines(docs_frame(spark, texts)).collect()}
    assert got == brute(list(enumerate(texts)))
    assert got[7] == got[8] == ""


def test_lines_of_repeated_shingles(spark):
    rng = random.Random(15)
    texts = []
    for _ in range(60):
        cycle = [f"w{rng.randrange(9)}" for _ in range(rng.choice([1, 2, 5, 7]))]
        line = cycle * rng.randint(1, 9) + [f"w{rng.randrange(9)}" for _ in range(rng.randint(0, 12))]
        texts.append(" ".join(line[rng.randint(0, 2):]))
    got = {r.doc_id: r.text for r in L.remove_duplicate_lines(docs_frame(spark, texts)).collect()}
    assert got == brute(list(enumerate(texts)))


def test_marks_are_posted_once_and_classes_found_by_hash(spark, monkeypatch):
    plans, write = {}, L.materialize

    def planned(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(L, "materialize", planned)
    texts = corpus()[:30]
    got = {r.doc_id: r.text for r in L.remove_duplicate_lines(docs_frame(spark, texts)).collect()}
    assert got == brute(list(enumerate(texts)))
    assert plans["line-meeting"].count("Generate explode(marks") == 1
    assert "SortMergeJoin" not in plans["line-meeting"]
    assert "SortAggregate" not in plans["line-classes"]
    assert "posexplode" not in plans["line-sets"]              # lines of the wanted places only


@pytest.mark.parametrize("posters", [1, 20, 10 ** 6])
def test_repeated_lines_post_all_or_the_first(spark, monkeypatch, posters):
    monkeypatch.setattr(L, "POSTERS", posters)
    texts = [*corpus(), *["\n".join([prose(16, 20, 99), prose(17, 3, 99)] * 3)] * 9]
    got = {r.doc_id: r.text for r in L.remove_duplicate_lines(docs_frame(spark, texts)).collect()}
    assert got == brute(list(enumerate(texts)))


def test_order_of_extreme_ids(spark):
    ids = [None, -(1 << 63), -(1 << 63) + 1, -1, 0, (1 << 63) - 1]
    base = prose(18, 30, 99)
    rows = [(i, f"{prose(30 + k, 9, 99)}\n{base} n{k}\n{base} n{k}") for k, i in enumerate(ids)]
    got = {r.doc_id: r.text for r in L.remove_duplicate_lines(
        spark.createDataFrame(rows[::-1], "doc_id bigint, text string")).collect()}
    want = brute([(k, text) for k, (_, text) in enumerate(rows)])
    assert got == {i: want[k] for k, i in enumerate(ids)}


def test_equal_ids_of_different_texts(spark):
    near = prose(19, 30, 99)
    rows = [(1, f"{prose(40, 12, 99)}\n{near}"), (1, f"{prose(41, 12, 99)}\n{near} x"), (2, f"{near} y"),
            (1, f"{prose(40, 12, 99)}\n{near}")]
    got = sorted((r.doc_id, r.text) for r in L.remove_duplicate_lines(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    # one place in the order: these do not remove each other
    assert got == sorted([(1, rows[0][1]), (1, rows[0][1]), (1, rows[1][1]), (2, "")])
