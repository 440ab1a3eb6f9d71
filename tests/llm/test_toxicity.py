import random
import zlib

import numpy as np

from eventstar.llm import toxicity as T
from tests.llm.helpers import awkward, docs_frame, prose

LABELS = "doc_id bigint, quality bigint, toxic bigint"


def corpus(n=400):
    rng = random.Random(1)
    texts, toxic = [], []
    for i in range(n):
        w = prose(700 + i, rng.randint(20, 120)).split()
        y = int(i % 3 == 0)
        if y:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "awful", "nasty"]))
        texts.append(" ".join(w))
        toxic.append(y)
    return texts, toxic


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    texts, toxic = corpus()
    docs = docs_frame(spark, texts, clash="score")
    labels = spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)], LABELS)
    model = T.fit(docs, labels)
    rows = {r.doc_id: r for r in T.score(docs, model).collect()}
    test = [i for i in range(len(texts)) if held(i)]
    right = sum(rows[i].predicted == toxic[i] for i in test) / len(test)
    assert right > 0.95
    assert all((r.score >= 0.5) == (r.predicted == 1) and 0 <= r.score <= 1 for r in rows.values())
    # labels of held-out rows, and the other columns, change nothing
    flipped = spark.createDataFrame([(i, 1, 1 - y if held(i) else y) for i, y in enumerate(toxic)], LABELS)
    again = T.score(docs.selectExpr("doc_id + 0 AS doc_id", "text", "lang"), T.fit(docs, flipped))
    assert {r.doc_id: r.score for r in again.collect()} == {i: r.score for i, r in rows.items()}


def test_scores_do_not_depend_on_batches():
    texts, toxic = corpus(60)
    words = T.Words()
    ids = [words.ids(t) for t in texts]
    model = T.train(ids, words.buckets, np.array(toxic), ["en"] * 60, epochs=1)
    together = model.scores(ids, words.buckets)
    assert np.allclose(together, [model.scores([x], words.buckets)[0] for x in ids], atol=1e-5)
    long = np.concatenate(ids * 60)
    assert len(long) > 3 * T.CHUNK
    assert np.allclose(model.scores([long], words.buckets)[0], model.scores(
        [np.concatenate([long, np.zeros(5, np.int32)])], words.buckets)[0], atol=1e-5)


def test_awkward_rows(spark):
    docs = awkward(spark, clash="predicted")
    none = spark.createDataFrame([], LABELS)
    rows = T.score(docs, T.fit(docs, none)).collect()
    assert len(rows) == 14 and {r.score for r in rows} == {0.0}
    odd = spark.createDataFrame([(None, None, None), (5, 1, None), (6, 0, 1), (6, 0, 0), (3, 1, 0), (7, 1, 0),
                                 (8, 1, 1), (9, 0, 1), (11, 1, 0)], LABELS)
    rows = T.score(docs, T.fit(docs, odd, epochs=1)).collect()
    assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert T.score(docs_frame(spark, []), T.fit(docs_frame(spark, []), odd)).count() == 0


def test_a_repeated_doc_id_is_trained_on_once(spark):
    texts, toxic = corpus(60)
    docs = docs_frame(spark, texts)
    again = docs.filter("doc_id = 3").crossJoin(spark.range(40)).selectExpr(
        "doc_id", "concat(text, ' ', id) AS text", "lang", "source", "n_chars", "text_key")
    labels = spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)], LABELS)
    ids, _, known, _ = T.training_rows(docs.unionByName(again), labels, 100, 4000)
    once, _, same, _ = T.training_rows(docs, labels, 100, 4000)
    assert len(ids) == len(once) == sum(not held(i) for i in range(60))
    assert list(known) == list(same)


def test_all_labelled_rows_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_ROWS", 8)
    texts, toxic = corpus(90)
    texts[2] = prose(5, 6000)                                  # a long one
    own = [i for i in range(90) if not held(i)]
    docs = docs_frame(spark, texts)
    again = docs.filter("doc_id = 2")
    labels = spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)], LABELS)
    found, many = T.blocks(docs.unionByName(again), labels)
    rows = found.collect()
    assert many == -(-len(own) // 8) and len({r.block for r in rows}) == len(rows)
    assert sum(len(r.sizes) // 8 for r in rows) == len(own)
    assert 2 not in own or any(len(texts[2].split()) in np.frombuffer(r.sizes, "<i8") for r in rows)
    by_row, by_label, names, words_of = T.count(found)
    assert by_label.sum(axis=0).tolist() == [sum(toxic[i] == y for i in own) for y in (0, 1)]
    assert by_row.max() <= len(own) and names == ["en"] and words_of.shape == (T.BUCKETS, 1)
    # the same model whatever the partitions of the rows
    one = T.fit(docs, labels, epochs=2)
    other = T.fit(docs.repartition(3).unionByName(again), labels.repartition(2), epochs=2)
    assert np.array_equal(one.embedding, other.embedding) and np.array_equal(one.threshold, other.threshold)
    assert one.offset == other.offset and one.constant is None


def test_blocks_learn_together(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_ROWS", 100)
    monkeypatch.setattr(T, "TURNS", 2)
    texts, toxic = corpus()
    docs = docs_frame(spark, texts)
    labels = spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)], LABELS)
    rows = {r.doc_id: r for r in T.score(docs, T.fit(docs, labels, epochs=32)).collect()}
    test = [i for i in range(len(texts)) if held(i)]
    assert sum(rows[i].predicted == toxic[i] for i in test) / len(test) > 0.9
