"""Line-first quality cleaning.

Each line of a text is judged on its own by three rules (punctuation,
navigation, boilerplate); failing lines are removed; a document is rejected
if it loses too large a share of its words, or if the whole-text base rule
fails (fewer than 50 words, or more than half of the words inside repeated
3-word windows).  A phrase of page furniture fails a line only if it makes a
fair part of it: an article may mention one.

Defined results: a null text counts as empty; a text without words fails the
base rule; lines are ``\n``-split, and a line without words is neither judged
nor lost; repeated rows get one result each; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, slices, table

SYMBOLS = "#*$%&|<>"
#: Marks that end a sentence, and the closing marks that may follow them.
#: Latin, Armenian, Arabic, Devanagari, Tibetan, Myanmar, Ethiopic,
#: Khmer and East Asian marks.
ENDS = ".!?…:;։؟۔।॥།။።។。！？．：；｡"
CLOSERS = "\"'”’»)]」』）］】〉》"
#: Tokens that separate links of a navigation bar.
SEPARATORS = {s.encode() for s in ("|", "»", "›", "•", "·", "/", ">")}
#: Phrases of page furniture, compared in lower case.
BOILERPLATE = ("lorem ipsum", "javascript", "cookie policy", "privacy policy", "terms of use",
               "terms of service", "all rights reserved", "subscribe to", "sign up to",
               "click here", "read more")


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: a line needs sentence-ending punctuation unless it is the last one;
    #: symbols may be at most this share (percent) of its words
    max_symbol_percent: int = 10
    #: separators per 100 words that make a line a navigation bar
    min_separator_percent: int = 20
    #: exclamation runs ("!!") per 100 words that make a line shouting
    max_shout_percent: int = 30
    #: words of boilerplate phrases per 100 words that fail a line
    min_boilerplate_percent: int = 10
    #: a document that loses more than this share (percent) of its words goes
    max_lost_percent: int = 30


def line_passes(line: str, words: list[bytes], last: bool, rules: QualityRules) -> bool:
    """The verdict on one line that has words."""
    n = len(words)
    symbols = sum(line.count(s) for s in SYMBOLS)
    if symbols * 100 > rules.max_symbol_percent * n:
        return False
    if "/" in line or "•" in line or "·" in line or "»" in line or "›" in line or symbols:
        bars = sum(1 for w in words if w in SEPARATORS)
        if bars * 100 >= rules.min_separator_percent * n:
            return False
    if line.count("!!") * 100 > rules.max_shout_percent * n:
        return False
    low = line.lower()
    if any(phrase in low for phrase in BOILERPLATE):
        found = sum(low.count(phrase) * len(phrase.split()) for phrase in BOILERPLATE)
        if found * 100 >= rules.min_boilerplate_percent * n:
            return False
    return last or line.rstrip().rstrip(CLOSERS)[-1:] in ENDS


def repeated_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a = np.array(list(map(ids.__getitem__, words)), np.int64)
    pair = a[:-1] * len(ids) + a[1:]
    if len(ids) >= 1 << 20:                     # keep the combined key below 2^63
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(ids) + a[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    at = np.concatenate([order[1:][same], order[:-1][same]])
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def judge(text: str | None, rules: QualityRules = QualityRules()) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, lost_words, kept) of one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "surrogatepass"))
    symbols = sum(text.count(s) for s in SYMBOLS)
    lost = 0
    lines = [(line, w) for line in text.split("\n")
             if (w := line.encode("utf-8", "surrogatepass").split())]
    dup = len(lines) - len({line for line, _ in lines})
    for i, (line, w) in enumerate(lines):
        if not line_passes(line, w, i == len(lines) - 1, rules):
            lost += len(w)
    repeat = repeated_words(words)
    failed = n < rules.min_words or 100 * repeat > rules.max_repeat_percent * n
    kept = not failed and 100 * lost <= rules.max_lost_percent * n
    return n, chars, symbols, dup, repeat, failed, lost, kept


SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
          "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
          "n_lost_words bigint, kept boolean")


def quality_report(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row of figures and verdict per document."""
    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text"):
            rows = [judge(t, rules) for t in part.column(1).to_pylist()]
            cols = [pa.array(c) for c in zip(*rows, strict=True)]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     "base_failed", "n_lost_words", "kept"]
            yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["doc_id", *names])
    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
                     score, SCHEMA)


def clean_lines(text: str | None, rules: QualityRules = QualityRules()) -> str | None:
    """The text without its failing lines."""
    if not text:
        return text
    lines = text.split("\n")
    worded = [i for i, line in enumerate(lines) if line.encode("utf-8", "surrogatepass").split()]
    last = worded[-1] if worded else -1
    keep = [line for i, line in enumerate(lines)
            if not (w := line.encode("utf-8", "surrogatepass").split())
            or line_passes(line, w, i == last, rules)]
    return "\n".join(keep)


def filter_documents(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows whose text is kept, all columns, failing lines removed."""
    def clean(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = batch.schema.get_field_index("text")
        for part in slices(batch, "text"):
            texts = part.column(at).to_pylist()
            keep = [judge(t, rules)[-1] for t in texts]
            part = part.set_column(at, part.schema.field(at), pa.array(
                [clean_lines(t, rules) if k else t for t, k in zip(texts, keep, strict=True)],
                part.schema.field(at).type))
            yield part.filter(pa.array(keep, pa.bool_()))
    return arrow_map(docs, clean, docs.schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures, base rule and line-first verdict of every document."""
    report = quality_report(table(spark, sf_dir, "documents"))
    return report.select(*[c for c in report.columns if c != "n_lost_words"], "n_lost_words")


#: The same in DuckDB.
OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
g AS (SELECT rid, i, concat(w[i], ' ', w[i + 1], ' ', w[i + 2]) AS k
      FROM (SELECT rid, w, unnest(range(1, greatest(1, len(w) - 1))) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat
        FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
ls AS (SELECT rid, string_split(t, chr(10)) AS ls FROM d),
l AS (SELECT rid, unnest(range(1, len(ls) + 1)) AS no, unnest(ls) AS line FROM ls),
lw AS (SELECT * FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM l) WHERE len(w) > 0),
f AS (SELECT rid, line, len(w) AS n, no = max(no) OVER (PARTITION BY rid) AS is_last, lower(line) AS low,
             length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols,
             (length(line) - length(replace(line, '!!', ''))) // 2 AS shouts,
             len(list_filter(w, lambda x: x IN ('|', '»', '›', '•', '·', '/', '>'))) AS bars,
             list_sum([(length(lower(line)) - length(replace(lower(line), x, ''))) // length(x)
                       * len(string_split(x, ' ')) for x in
                       ['lorem ipsum', 'javascript', 'cookie policy', 'privacy policy', 'terms of use',
                        'terms of service', 'all rights reserved', 'subscribe to', 'sign up to', 'click here',
                        'read more']]) AS furniture FROM lw),
j AS (SELECT rid, line, n, symbols * 100 <= 10 * n AND NOT (bars > 0 AND bars * 100 >= 20 * n)
        AND shouts * 100 <= 30 * n
        AND NOT (furniture > 0 AND furniture * 100 >= 10 * n)
        AND (is_last OR regexp_matches(line, '(^|[.!?…:;։؟۔।॥།။።។。！？．：；｡])["\x27”’»)\]」』）］】〉》]*\s*$')) AS passes FROM f),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup, coalesce(sum(n) FILTER (WHERE NOT passes), 0) AS lost
          FROM j GROUP BY rid),
b AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) for x in w]), 0) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
             coalesce(lost, 0) AS n_lost_words
      FROM w LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       CAST(n_lost_words AS BIGINT) AS n_lost_words,
       NOT base_failed AND 100 * n_lost_words <= 30 * n_words AS kept
FROM v
"""
