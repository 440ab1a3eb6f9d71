"""Benchmark decontamination with a positional inverted index.

Terms are the words of the benchmark items.  Their frequencies in the whole
corpus rank them; each window of an item is anchored at its rarest terms that
occur, and only postings (term, document, position) of anchor terms are stored.
Postings of an item's anchors, each offset by the term's place in the item,
meet where the item is aligned with a document: alignments where the lists of
two anchors intersect are candidates, which are then compared word by word.

Phrase matches are windows of ``window`` consecutive item words (an item with
fewer is one window).  Proximity matches are items with a window of which all
but ``missing(length)`` words, or of which two words out of the item's anchors
(the two rarest occurring terms of each of its windows), stand at different
document positions whose offsets from their places in the item differ by at
most ``slop``; a single-word item is matched where it occurs.  A window with
all but m words has two of its m + 2 rarest words, which find the candidates;
these are then compared on all words.

Only DataFrame operations are used.  Small sides (terms, anchors, candidates,
items) are broadcast up to a counted size and shuffled beyond it.

Defined results: null or empty texts have no words and no hits; an item
without words has no window; repeated rows of a document get the same result;
rows that share a doc_id but differ in text are judged apart; items that
repeat an item_id count as one item; items with a null item_id count for n_hit
and contaminated, but are neither listed nor counted as items; extra columns are not read; without items
nothing is hit.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventstar.functions.jsonpaths import with_column_once
from eventstar.llm.common import materialize, small_side, table

WINDOW, SLOP = 13, 5
#: Anything but digits, letters and characters beyond ASCII parts words.
_PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words in order, ``A-Z`` in lower case."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, _PARTS), "")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that tells rows of one doc_id apart."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.xxhash64("text").alias("text_key"))


def _join_docs(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the document, null doc_ids included."""
    right = right.withColumnsRenamed({"doc_id": "right_id", "text_key": "right_key"})
    both = left.join(right, F.col("doc_id").eqNullSafe(F.col("right_id"))
                     & (F.col("text_key") == F.col("right_key")), how)
    if how == "full":
        both = both.withColumns({"doc_id": F.coalesce("doc_id", "right_id"),
                                 "text_key": F.coalesce("text_key", "right_key")})
    return both.drop("right_id", "right_key")


def _with_words(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` with ``w``, the words of their document, which are made once
    per document, however many places it has."""
    wanted = small_side(places.select("doc_id", "text_key").distinct())
    worded = with_column_once(_join_docs(_keyed(docs), wanted, "left_semi"), "w", words(F.col("text")))
    return _join_docs(worded.drop("text"), small_side(places), "inner")


def item_words(benchmark: DataFrame) -> DataFrame:
    """item (``=`` and the item_id, empty if that is null), n, item_words of each
    distinct item with words."""
    named = F.concat(F.lit("="), F.col("item_id").cast("string"))
    return (benchmark.select(F.coalesce(named, F.lit("")).alias("item"),
                             words(F.col("text")).alias("item_words"))
            .filter(F.size("item_words") > 0).distinct()
            .withColumn("part", F.xxhash64("item_words"))
            .withColumn("n", F.size("item_words")))


def missing(length: Column) -> Column:
    """Words of a window that a proximity match may lack (2 of 13)."""
    return F.floor((length + 2) / 6)


def anchors(items: DataFrame, frequency: DataFrame, window: int, near: bool = True) -> DataFrame:
    """item, part, place, term, rare: the two rarest occurring terms of each
    window (rare), and with ``near`` those that find proximity matches."""
    placed = items.select("item", "part", "n", F.posexplode("item_words").alias("place", "term"))
    ranked = placed.join(frequency, "term").select(
        "item", "part", "place", "term", "freq", F.least("n", F.lit(window)).alias("length"),
        F.explode(F.sequence(F.greatest(F.lit(0), F.col("place") - (window - 1)),
                             F.greatest(F.lit(0), F.least(F.col("place"), F.col("n") - window))))
        .alias("start"))
    order = Window.partitionBy("item", "part", "start").orderBy("freq", "place")
    absent = F.count_if(F.col("freq") == 0).over(Window.partitionBy("item", "part", "start"))
    rank = F.row_number().over(order)
    kept = ranked.withColumns({"rare": rank - absent <= 2, "found": rank <= missing(F.col("length")) + 2})
    return (kept.filter((F.col("freq") > 0) & (F.col("rare") | (F.col("found") & F.lit(near))))
            .groupBy("item", "part", "place", "term").agg(F.bool_or("rare").alias("rare")))


def store_postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: term, doc_id, text_key, pos of every occurrence of ``terms``."""
    tokens = _keyed(docs).select("doc_id", "text_key", F.posexplode(words(F.col("text")))
                                 .alias("pos", "term"))
    return materialize(tokens.join(small_side(terms), "term", "left_semi"), "postings")


def frequencies(docs: DataFrame, items: DataFrame) -> DataFrame:
    """term, freq: occurrences in the corpus of every term of the items."""
    terms = items.select(F.explode("item_words").alias("term")).distinct()
    found = (docs.select(F.explode(words(F.col("text"))).alias("term"))
             .join(small_side(terms), "term", "left_semi")
             .groupBy("term").agg(F.count(F.lit(1)).alias("freq")))
    return materialize(terms.join(found, "term", "left")
                       .select("term", F.coalesce("freq", F.lit(0)).alias("freq")), "term-freq")


def aligned_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 near: bool = True) -> DataFrame:
    """item, part, doc_id, text_key, place, pos, rare: anchors met in documents."""
    items = item_words(benchmark)
    anchor = materialize(anchors(items, frequencies(docs, items), window, near), "anchors")
    postings = store_postings(docs, anchor.select("term").distinct())
    return materialize(postings.join(small_side(anchor), "term"), "hits")


def phrase_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   hits: DataFrame | None = None) -> DataFrame:
    """doc_id, text_key, item, part, first, length: every occurrence of a
    window, as the document positions it covers."""
    hits = aligned_hits(docs, benchmark, window) if hits is None else hits
    items = item_words(benchmark)
    lists = (hits.filter("rare").groupBy("doc_id", "text_key", "item", "part",
                          (F.col("pos") - F.col("place")).alias("shift"))
             .agg(F.count(F.lit(1)).alias("met")))
    candidates = materialize(
        lists.join(small_side(items.select("item", "part", "n")), ["item", "part"])
        .filter((F.col("met") >= 2) | (F.col("n") == 1)).drop("met", "n"), "candidates")
    found = _with_words(docs, candidates).select("doc_id", "text_key", "w", "item", "part", "shift")
    compared = found.join(small_side(items, limit=20_000), ["item", "part"]).select(
        "doc_id", "text_key", "item", "part", "shift", "n",
        F.expr("transform(item_words, (x, i) -> CASE WHEN shift + i >= 0 "
               "THEN coalesce(get(w, shift + i) = x, false) ELSE false END)").alias("same"))
    length = F.least(F.col("n"), F.lit(window))
    starts = F.filter(F.sequence(F.lit(0), F.col("n") - length),
                      lambda s: F.forall(F.slice("same", s + 1, length), lambda x: x))
    return (compared.select("doc_id", "text_key", "item", "part", "shift", length.alias("length"),
                            F.explode(starts).alias("start"))
            .select("doc_id", "text_key", "item", "part",
                    (F.col("shift") + F.col("start")).alias("first"), "length"))


def proximity_matches(docs: DataFrame, benchmark: DataFrame, hits: DataFrame,
                      window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """doc_id, text_key, item: items near a document."""
    key = ["doc_id", "text_key", "item", "part"]
    items = item_words(benchmark)
    hits = hits.withColumn("shift", F.col("pos") - F.col("place"))
    apart = (F.min("place") < F.max("place")) & (F.min("pos") < F.max("pos"))
    # two anchors: all ranges of shifts that hold a hit
    low = F.explode(F.sequence(F.col("shift") - slop, F.col("shift")))
    pairs = (hits.filter("rare").select(*key, "place", "pos", low.alias("low"))
             .groupBy(*key, "low").agg(apart.alias("apart")).filter("apart"))
    single = hits.join(small_side(items.filter("n = 1").select("item", "part")),
                       ["item", "part"], "left_semi")
    # most words: two hits in neighbouring buckets of shifts make a candidate
    bucket = F.floor(F.col("shift") / (slop + 1)).cast("int")
    candidates = materialize(
        hits.select(*key, "place", "pos", F.explode(F.array(bucket, bucket - 1)).alias("bucket"))
        .groupBy(*key, "bucket").agg(apart.alias("apart")).filter("apart")
        .select(*key, (F.col("bucket") * (slop + 1)).alias("low")), "near-candidates")
    first = F.greatest(F.col("low"), F.lit(0))
    end = F.col("low") + 2 * slop + 1 + F.col("n")
    compared = (
        _with_words(docs, candidates.join(small_side(items.select("item", "part", "n")), ["item", "part"]))
        .select(*key, "low", "n", first.alias("first"),
                F.posexplode(F.slice("w", first + 1, F.greatest(end - first, F.lit(0))))
                .alias("at", "term"))
        .join(small_side(items.select("item", "part", F.posexplode("item_words").alias("place", "term"))),
              ["item", "part", "term"])
        .withColumn("pos", F.col("first") + F.col("at"))
        .filter((F.col("pos") - F.col("place")).between(F.col("low"), F.col("low") + 2 * slop + 1))
        .groupBy(*key, "low", "n").agg(F.collect_set(F.struct("place", "pos")).alias("met")))
    length = F.least(F.col("n"), F.lit(window))
    need = length - missing(length)

    def enough(met: Column) -> Column:
        return ((F.size(F.array_distinct(met["place"])) >= need)
                & (F.size(F.array_distinct(met["pos"])) >= need))

    def in_window(met: Column) -> Column:
        return F.exists(F.sequence(F.lit(0), F.col("n") - length), lambda s: enough(
            F.filter(met, lambda h: (h["place"] >= s) & (h["place"] < s + length))))

    def in_range(low: Column) -> Column:
        return F.filter("met", lambda h: (h["pos"] - h["place"]).between(low, low + slop))

    most = compared.filter(enough(F.col("met"))).filter(
        F.exists(F.sequence(F.col("low"), F.col("low") + slop), lambda x: in_window(in_range(x))))
    found = [df.select("doc_id", "text_key", "item") for df in (pairs, single, most)]
    return found[0].unionAll(found[1]).unionAll(found[2]).distinct()


def decontamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                           slop: int | None = SLOP, percent: int = 5) -> DataFrame:
    """Per document: n_words, n_hit (words inside occurring windows), n_items,
    items_sha256, contaminated (hit words are at least ``percent`` per cent),
    and unless ``slop`` is None n_near_items (proximity matches)."""
    hits = aligned_hits(docs, benchmark, window, slop is not None)
    found = materialize(phrase_matches(docs, benchmark, window, hits), "phrases")
    # hit words of a document: what each occurrence adds to those before it
    order = Window.partitionBy("doc_id", "text_key").orderBy("first", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = (found.select("doc_id", "text_key", "first", (F.col("first") + F.col("length")).alias("end"))
             .distinct()
             .withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest(
                 F.col("first"), F.coalesce(before, F.col("first")))))
             .groupBy("doc_id", "text_key").agg(F.sum("new").alias("n_hit")))
    items = (found.groupBy("doc_id", "text_key")
             .agg(F.sort_array(F.collect_set(F.when(F.col("item") != "", F.expr("substring(item, 2)"))))
                  .alias("items")))
    per_doc = _join_docs(spans, items, "full")
    if slop is not None:
        near = (proximity_matches(docs, benchmark, hits, window, slop).filter("item != ''")
                .groupBy("doc_id", "text_key")
                .agg(F.count(F.lit(1)).alias("n_near_items")))
        per_doc = _join_docs(per_doc, near, "full")
    counted = _keyed(docs).select("doc_id", "text_key",
                                  F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    near = [] if slop is None else [
        F.coalesce("n_near_items", F.lit(0)).cast("bigint").alias("n_near_items")]
    return (_join_docs(counted, per_doc, "left")
            .select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"),
                    F.size(listed).cast("bigint").alias("n_items"),
                    F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
                    ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"),
                    *near))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        percent: int = 5) -> DataFrame:
    """The rows of documents that are not contaminated, all columns."""
    bad = materialize(decontamination_report(docs, benchmark, window, None, percent)
                      .filter("contaminated").select("doc_id", "text_key").distinct(), "contaminated")
    bad = small_side(bad).withColumnsRenamed({"doc_id": "bad_id", "text_key": "bad_key"})
    return docs.join(bad, docs["doc_id"].cast("bigint").eqNullSafe(bad["bad_id"])
                     & (F.xxhash64(docs["text"]) == bad["bad_key"]), "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return decontamination_report(table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "benchmark")).drop("text_key")


#: The same in DuckDB: all windows of documents compared with all of items, and
#: all words near each other with those of items.
OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS pid, item, w, len(w) AS n, least(13, len(w)) AS len FROM (
        SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item, len, array_to_string(w[s:s + len - 1], ' ') AS k
        FROM (SELECT item, w, len, unnest(range(1, n - len + 2)) AS s FROM b)),
lens AS (SELECT DISTINCT len FROM win),
dw AS (SELECT rid, s, len, array_to_string(w[s:s + len - 1], ' ') AS k
       FROM (SELECT rid, w, len, unnest(range(1, greatest(1, len(w) - len + 2))) AS s
             FROM d, lens WHERE len(w) >= len)),
m AS (SELECT dw.rid, dw.s, dw.len, win.item FROM dw JOIN win ON dw.k = win.k AND dw.len = win.len),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM
        (SELECT rid, unnest(range(s, s + len)) AS p FROM (SELECT DISTINCT rid, s, len FROM m)) GROUP BY rid),
i AS (SELECT rid, count(DISTINCT item) AS n_items,
             string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m WHERE item IS NOT NULL GROUP BY rid),
dp AS (SELECT rid, unnest(w) AS term, unnest(range(len(w))) AS pos FROM d),
ip AS (SELECT pid, n, len, unnest(w) AS term, unnest(range(n)) AS place FROM b WHERE item IS NOT NULL),
fr AS (SELECT t.term, count(dp.term) AS freq
       FROM (SELECT DISTINCT term FROM ip) t LEFT JOIN dp ON dp.term = t.term GROUP BY t.term),
rk AS (SELECT pid, place, term, len, freq, row_number() OVER (PARTITION BY pid, s ORDER BY freq, place) AS rank,
              count(*) FILTER (WHERE freq = 0) OVER (PARTITION BY pid, s) AS absent
       FROM (SELECT ip.*, freq, unnest(range(greatest(0, place - 12),
                                             greatest(0, least(place, n - 13)) + 1)) AS s
             FROM ip JOIN fr ON fr.term = ip.term)),
anchor AS (SELECT pid, place, term, bool_or(rank - absent <= 2) AS rare FROM rk
           WHERE freq > 0 AND (rank - absent <= 2 OR rank <= (len + 2) // 6 + 2) GROUP BY pid, place, term),
hits AS (SELECT rid, pid, place, pos, pos - place AS shift, rare
         FROM dp JOIN anchor ON anchor.term = dp.term),
two AS (SELECT DISTINCT x.rid, x.pid FROM hits x JOIN hits y
        ON x.rid = y.rid AND x.pid = y.pid AND x.place < y.place AND x.pos <> y.pos
        AND abs(x.shift - y.shift) <= 5 WHERE x.rare AND y.rare),
one AS (SELECT DISTINCT dp.rid, ip.pid FROM dp JOIN ip ON ip.term = dp.term WHERE ip.n = 1),
cand AS (SELECT rid, pid, low FROM (SELECT rid, pid, place, pos, 6 * CAST(unnest(
           [floor(shift / 6.0), floor(shift / 6.0) - 1]) AS BIGINT) AS low FROM hits)
         GROUP BY rid, pid, low HAVING min(place) < max(place) AND min(pos) < max(pos)),
met AS (SELECT c.rid, c.pid, low, n, len, place, pos FROM cand c JOIN dp ON dp.rid = c.rid
        JOIN ip ON ip.pid = c.pid AND ip.term = dp.term WHERE pos - place BETWEEN low AND low + 11),
most AS (SELECT DISTINCT rid, pid FROM (
           SELECT rid, pid, len, low, x, place, pos,
                  unnest(range(greatest(0, place - len + 1), least(place, n - len) + 1)) AS s
           FROM (SELECT *, unnest(range(low, low + 6)) AS x FROM met) WHERE pos - place BETWEEN x AND x + 5)
         GROUP BY rid, pid, len, low, x, s
         HAVING count(DISTINCT place) >= len - (len + 2) // 6 AND count(DISTINCT pos) >= len - (len + 2) // 6),
near AS (SELECT rid, count(DISTINCT item) AS n_near
         FROM (FROM two UNION FROM one UNION FROM most) u JOIN b ON b.pid = u.pid GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated,
       CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN h ON d.rid = h.rid LEFT JOIN i ON d.rid = i.rid LEFT JOIN near ON d.rid = near.rid
"""
