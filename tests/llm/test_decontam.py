import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from eventstar.llm import decontam as D
from tests.llm.helpers import awkward, docs_frame, prose

ITEMS = "item_id bigint, text string, term string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, window=13):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(window, len(iw))
        if not n or item is None:
            continue
        grams = {tuple(iw[s:s + n]) for s in range(len(iw) - n + 1)}
        for s in range(len(w) - n + 1):
            if tuple(w[s:s + n]) in grams:
                hit |= set(range(s, s + n))
                found.add(str(item))
    listed = ",".join(sorted(found))
    return (len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(),
            bool(hit) and 20 * len(hit) >= len(w))


def test_the_statement_says_the_same_of_nameless_items_and_near_matches(spark, tmp_path):
    items, texts = planted(spark)
    rng = random.Random(9)
    for i in range(6):                                    # replaced, repeated and moved words
        item = items[i][1].split()
        for k in (1, 2, 4):
            edited = list(item)
            for at in rng.sample(range(len(edited)), k):
                edited[at] = rng.choice(["cut", item[0], item[-1]])
            texts.append(" ".join(["before", *edited, "behind"]))
    texts += ["a nameless item here indeed", "nameless " * 5, None]
    docs = docs_frame(spark, texts, clash="pos")
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS)
    con = duckdb.connect()
    for name, df in (("documents", docs.select("doc_id", "text")), ("benchmark", bench)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path / name}/*.parquet')")
    want = con.execute(D.OP7_SQL)
    columns = [c[0] for c in want.description]
    got = D.decontamination_report(docs, bench).drop("text_key")
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(map(tuple, got.select(*columns).collect()))
    assert rows == sorted(want.fetchall())
    assert [r[columns.index("n_hit")] for r in rows if r[0] == len(texts) - 3] == [3]


def planted(spark):
    rng = random.Random(4)
    items = [(i, prose(100 + i, rng.randint(15, 40))) for i in range(6)]
    items += [(6, "Two WORDS"), (7, "solo"), (8, ""), (9, None), (10, items[0][1]),
              (11, "the " * 20), (None, "nameless item here")]
    base = prose(50, 100).split()
    texts = [" ".join(base)]
    for i in range(6):
        item = items[i][1].split()
        texts += [" ".join([*base[:40], *item, *base[40:]]),           # whole
                  " ".join([*base[:40], *item[:12], "cut", *item[12:]]),  # too short a run at first
                  " ".join([*base, *item[1:14]]),                       # one window
                  items[i][1].upper() * 2]
    texts += ["so two, words and solo", "the " * 300, "the " * 12, prose(60, 4000) + " " + items[2][1],
              " ".join(prose(100 + 3, 40).split()[::-1])]
    return items, texts


def test_against_brute_force(spark):
    items, texts = planted(spark)
    docs = docs_frame(spark, texts, clash="pos")
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in D.decontamination_report(docs, bench).collect()}
    assert got == {i: brute(t, items) for i, t in enumerate(texts)}
    clean = D.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, r in got.items() if not r[4])


def test_shuffled_sides_give_the_same(spark, monkeypatch):
    """Beyond the broadcast bound every side is shuffled."""
    items, texts = planted(spark)
    docs = docs_frame(spark, texts)
    bench = spark.createDataFrame([(i, t, "") for i, t in items], ITEMS)
    want = sorted(map(str, D.decontamination_report(docs, bench).collect()))
    monkeypatch.setattr(D, "small_side", lambda df, rows=None, limit=0: df)
    assert sorted(map(str, D.decontamination_report(docs, bench).collect())) == want


def test_awkward_rows(spark):
    docs = awkward(spark, clash="item")
    bench = spark.createDataFrame([(1, prose(1, 80), ""), (2, "a b c d", "")], ITEMS)
    rows = D.decontamination_report(docs, bench).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == 14
    for r in rows:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute(
            texts[r.doc_id], [(1, prose(1, 80)), (2, "a b c d")])
    none = spark.createDataFrame([], ITEMS)
    assert {r.n_hit for r in D.decontamination_report(docs, none).collect()} == {0}
    assert D.decontamination_report(docs_frame(spark, []), bench).count() == 0


def test_nameless_items_count_as_hits(spark):
    docs = docs_frame(spark, ["a nameless item here", "named one", "none"])
    bench = spark.createDataFrame([(None, "nameless item here", ""), (3, "named one", "")], ITEMS)
    sha = [hashlib.sha256(x).hexdigest() for x in (b"", b"3")]
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated, r.n_near_items)
           for r in D.decontamination_report(docs, bench).collect()}
    assert got == {0: (3, 0, sha[0], True, 0), 1: (2, 1, sha[1], True, 1), 2: (0, 0, sha[0], False, 0)}


def test_proximity(spark):
    item = prose(200, 30)
    w = item.split()
    docs = docs_frame(spark, [" ".join([*w[:9], "extra", *w[9:18], "words", *w[18:]]), prose(201, 60)])
    bench = spark.createDataFrame([(1, item, "")], ITEMS)
    got = {r.doc_id: (r.n_near_items, r.n_hit) for r in D.decontamination_report(docs, bench).collect()}
    assert got == {0: (1, 0), 1: (0, 0)}


def near_brute(texts, items, window=13, slop=5):
    """Per text the number of items near it, by comparing all words."""
    docs = [words(t) for t in texts]
    freq = {}
    for w in docs:
        for t in w:
            freq[t] = freq.get(t, 0) + 1
    kinds = {}
    for item, t in items:
        if item is not None and words(t):
            kinds.setdefault(item, []).append(words(t))
    out = []
    for w in docs:
        near = set()
        for item, texts_of in kinds.items():
            for iw in texts_of:
                length = min(window, len(iw))
                need = length - (length + 2) // 6
                windows = [range(s, s + length) for s in range(len(iw) - length + 1)]
                rare = {p for ps in windows for p in sorted(
                    (p for p in ps if iw[p] in freq), key=lambda p: (freq[iw[p]], p))[:2]}
                met = [(p, q) for q, x in enumerate(w) for p, y in enumerate(iw) if x == y]
                for low in {q - p for p, q in met}:
                    box = [(p, q) for p, q in met if low <= q - p <= low + slop]
                    two = [(p, q) for p, q in box if p in rare]
                    if len(iw) == 1 or (len({p for p, _ in two}) > 1 and len({q for _, q in two}) > 1) \
                            or any(len({p for p, _ in box if p in ps}) >= need
                                   and len({q for p, q in box if p in ps}) >= need for ps in windows):
                        near.add(item)
        out.append(len(near))
    return out


def test_proximity_of_edited_copies(spark):
    """Replaced and repeated words, against brute force."""
    rng = random.Random(7)
    common = [f"c{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(common) if rng.random() < .8 else f"r{i}x{k}"
                          for k in range(rng.choice([4, 9, 13, 13, 20]))))
             for i in range(12)]
    items += [(20, "solo"), (21, "c1 c1 c2 c1 c1"), (22, items[0][1]), (23, "c1 " * 15),
              (24, "never seen words at all"), (None, "c1 c2 c3")]
    texts = [" ".join(rng.choice(common) for _ in range(40)) for _ in range(3)]
    texts += ["solo", "c1 " * 60, "c1 c1 c1 c2 c1", "", " ".join(f"r{i}x{k}" for i in range(12) for k in range(20))]
    for i in range(12):
        w = items[i][1].split()
        at = [k for k, x in enumerate(w) if x[0] == "r"] + [0, len(w) - 1]
        for n in (1, 2, 3, 5):
            copy = list(w)
            for k in at[:n]:
                copy[k] = f"new{k}"
            texts.append(" ".join([*texts[0].split()[:20], *copy[:6], "c1", *copy[6:], "c2"]))
        texts.append(" ".join(w))
    docs = docs_frame(spark, texts)
    bench = spark.createDataFrame([(i, t, "") for i, t in items], ITEMS)
    got = {r.doc_id: r for r in D.decontamination_report(docs, bench).collect()}
    assert [got[i].n_near_items for i in range(len(texts))] == near_brute(texts, items)
    assert all(r.n_near_items >= r.n_items for r in got.values())
    rare = " ".join(f"q{k}" for k in range(13))
    docs = docs_frame(spark, [rare.replace("q0 ", "other ").replace("q5", "words"), "q0 x q5", "c1"])
    bench = spark.createDataFrame([(1, rare, "")], ITEMS)
    assert {r.doc_id: r.n_near_items for r in D.decontamination_report(docs, bench).collect()}[0] == 1


def test_no_python_in_the_plan(spark, capsys):
    docs = docs_frame(spark, [prose(1, 50)])
    D.decontamination_report(docs, spark.createDataFrame([(1, prose(1, 50), "")], ITEMS)).explain()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", capsys.readouterr().out)


def test_words_are_made_once_per_document(spark):
    docs = docs_frame(spark, ["a b c", "d e", None])
    key = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    places = key.filter("doc_id < 2").crossJoin(spark.range(3).withColumnRenamed("id", "place"))
    found = D._with_words(docs, places)
    assert sorted((r.doc_id, r.place, r.w) for r in found.collect()) == [
        (i, k, w) for i, w in ((0, ["a", "b", "c"]), (1, ["d", "e"])) for k in range(3)]
    # split below the join that repeats documents, behind a generator
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_remove(split(") == 1
    assert plan.index("Join Inner") < plan.index("Generate explode(array(array_remove(split(")
