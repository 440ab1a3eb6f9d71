import duckdb
import pytest

import corpus_pipeline as C
from eventstar.llm import queries as Q
from tests.llm.helpers import awkward, docs_frame, prose
from tests.llm.test_decontam import brute as decontaminate
from tests.llm.test_jaccard import brute as near
from tests.llm.test_linededup import brute as dedup, tokens
from eventstar.llm.quality import clean_lines, judge
from eventstar.session import scratch_path

SF = "/root/testdata/sf0.001"


def brute_pipeline(rows, items):
    """doc_id -> text of what the filtering stages keep."""
    kept = {i: clean_lines(t) for i, t in rows if judge(t)[-1]}
    lines = dedup(list(kept.items()))
    kept = {i: t for i, t in lines.items() if t == kept[i] or any(map(tokens, t.split("\n")))}
    ids = sorted(kept)
    classes = near([kept[i] for i in ids])
    kept = {i: kept[i] for k, i in enumerate(ids) if classes[k][0] == k}
    return {i: t for i, t in kept.items() if not decontaminate(t, items)[4]}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 4000").limit(70)
    path = scratch_path(spark, "pipeline-docs")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        path = scratch_path(spark, "stage")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    want = brute_pipeline(rows, items)
    assert {r.doc_id: r.text for r in docs.collect()} == want
    packed = C.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == set(want)


def test_stages_stand_awkward_rows(spark):
    docs = awkward(spark, clash="drop_id")
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns[-1] == "drop_id"
        path = scratch_path(spark, "stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    # doc 5's text is the earlier one of two; the null doc_id precedes doc 11
    assert {r.doc_id for r in docs.collect()} == {None, 5, 7}


def test_stages_stand_empty_tables(spark):
    empty = docs_frame(spark, [])
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_queries_equal_their_statements(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(Q.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = Q.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    got = got.select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_prose_helper_is_stable():
    assert prose(1, 5) == prose(1, 5)
