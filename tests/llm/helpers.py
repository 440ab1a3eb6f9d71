"""Documents with the cases that every operator must stand."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

WORDS = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]


def prose(seed: int, n: int, line: int = 12) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + line]) + "." for i in range(0, n, line))


def awkward_texts() -> list[str | None]:
    return [None, "", " \n\t ", "one", "a b c d", prose(1, 80), prose(1, 80), prose(2, 3000),
            "\n".join(["same line of five words."] * 30), "x" * 5000, "é ñ 日本 " * 40, prose(3, 60)]


def docs_frame(spark: SparkSession, texts: list[str | None], clash: str = "text_key") -> DataFrame:
    """doc_id, text, lang, source, n_chars and an extra column of a name that
    the operators use themselves."""
    rows = [(i, t, "en", "s", len(t or ""), f"extra{i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {clash} string")


def awkward(spark: SparkSession, clash: str = "text_key") -> DataFrame:
    """All awkward texts, one row twice and one with a null doc_id."""
    docs = docs_frame(spark, awkward_texts(), clash)
    again = docs.filter("doc_id = 7")
    nameless = docs.filter("doc_id = 11").selectExpr(
        "CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars", clash)
    return docs.unionByName(again).unionByName(nameless)
