"""Line dedup by an exact set-similarity join.

A line is the set of its five-word shingles (a line of fewer words is one
shingle).  A line is removed if an earlier line, by (doc_id, line number), has
a Jaccard similarity of at least 0.8 to it; whether that earlier line is itself
removed does not matter, so the result does not depend on the order of work.

* Lines of equal words form a class first, by partial aggregation: a line that
  a third of the corpus repeats is one row per task in the shuffle.
* One scan marks each line with a prefix of its shingles, ordered by the hash
  of the first word, so that only these are made.  Similar lines share SHARED
  of their marks; classes that share fewer with others are set aside.  Marks
  are shuffled once, from the lines; a line that is repeated often posts once.
* Only of the rest full sets are made, from the texts with their first lines.  Their tokens are ordered by rarity:
  counts of their shingles in a fixed number of hash buckets (a table of
  constant size), ties by hash.  Any fixed order is exact; rarity only keeps
  the lists short.
* The prefix that a similar set must meet is joined on its tokens, with length
  and positional filters in the join.  A class needs one earlier class that it
  resembles, so it meets the earliest partners of each token first, and all
  others only if it found none.
* Candidates are verified on their full sets.

Only DataFrame operations are used.  Defined results: null and empty texts
have no lines and stay as they are; lines without words are never removed;
rows of one doc_id are one position in the order, so equal lines at the same
place of them do not remove each other; a null doc_id comes first; extra
columns are kept by ``remove_duplicate_lines`` and not read otherwise.  Shingles
are 64-bit hashes, tokens 48 bits of them beside their rarity, classes 126 bits.
"""

from __future__ import annotations

from decimal import Decimal
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventstar.functions.jsonpaths import with_column_once
from eventstar.llm.common import materialize, small_side, table
from eventstar.llm.decontam import words

SHINGLE = 5
BUCKETS = 1 << 16
#: The threshold 0.8 as a fraction; sizes and overlaps are compared in integers.
UP, DOWN = 4, 5
#: Marks that similar lines share at least, if their sets are as large (at
#: most 3, as two bits hold it).
SHARED = 3
#: Partners per token that a class meets before all others.
FIRST_PARTNERS = 2
PAIR = ("a", "a2", "b", "b2")
#: Of classes with such a part of all lines, one line posts its marks.
POSTERS = 100_000


#: Anything but digits, letters and characters beyond ASCII parts words.
_PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def line_words(line: Column) -> Column:
    """Hashes of a line's lower-case words."""
    return F.transform(F.array_remove(F.split(F.lower(line), _PARTS), ""), lambda x: F.xxhash64(x))


def with_shingles(lines: DataFrame) -> DataFrame:
    """``lines`` without ``line``, with ``shingles``: a hash of each five words
    in a row (of all words, if fewer), repeats included; empty without words.

    Each step is a column of its own, used by name in the next: written as one
    expression, Spark would evaluate the inner steps once per use.
    """
    part = lambda c, at, size: F.slice(c, at, F.greatest(F.lit(0), size))        # noqa: E731
    # word k of a shingle is shifted by 0, 5, 11, 16 and 17 bits: order counts
    pair = lambda by: lambda x, y: x.bitwiseXOR(F.shiftleft(y, by))              # noqa: E731
    keep = [c for c in lines.columns if c != "line"]
    n = F.size("w")
    one = lines.select(*keep, line_words(F.col("line")).alias("w"))
    two = one.select(*keep, "w", F.zip_with(part("w", 1, n - 1), part("w", 2, n - 1), pair(5)).alias("two"))
    four = two.select(*keep, "w", F.zip_with(part("two", 1, n - 3), part("two", 3, n - 3), pair(11))
                      .alias("four"))
    five = four.select(*keep, "w", F.zip_with(part("four", 1, n - 4), part("w", 5, n - 4), pair(17))
                       .alias("five"))
    return five.select(*keep, F.when(n >= SHINGLE, F.col("five")).when(n > 0, F.array(F.xxhash64("w")))
                       .otherwise(F.array().cast("array<bigint>")).alias("shingles"))


def _bucket(shingle: Column) -> Column:
    return F.shiftrightunsigned(shingle, 48).cast("int")


def with_ranked(sets: DataFrame, ranks: Column) -> DataFrame:
    """``sets`` without ``shingles``, with ``tokens``: its distinct shingles,
    rarity in the upper bits above 48 bits of the hash."""
    keep = [c for c in sets.columns if c != "shingles"]
    code = F.transform("shingles", lambda t: F.shiftleft(F.get(ranks, _bucket(t)).cast("bigint"), 48)
                       .bitwiseOR(t.bitwiseAND(F.lit((1 << 48) - 1))))
    return with_column_once(sets, "tokens", F.array_distinct(code)).select(*keep, "tokens")


def with_tokens(lines: DataFrame, ranks: Column) -> DataFrame:
    """``lines`` without ``line``, with the ``tokens`` of its shingles."""
    return with_ranked(with_shingles(lines), ranks)


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line_no, line of every line of a text that is not null."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                        F.split("text", "\n").alias("lines"))
    return keyed.select("doc_id", "text_key", F.posexplode("lines").alias("line_no", "line"))


def bucket_ranks(sets: DataFrame) -> Column:
    """Logarithmic counts of all ``shingles`` by hash bucket: a constant array
    of BUCKETS numbers, whatever the size of the corpus."""
    # outer: a plain explode adds a filter on its input, which would be pushed
    # below the steps of the shingles and evaluate them once more each
    counts = (sets.select(F.explode_outer("shingles").alias("t")).filter("t IS NOT NULL")
              .groupBy(_bucket(F.col("t")).alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
    ranks = [0] * BUCKETS
    for bucket, n in counts.collect():                           # BUCKETS rows at most
        ranks[bucket] = min(32767, int(log2(n + 1) * 512))
    # folded to one literal when the plan is optimized
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<int>")


def rarity(docs: DataFrame) -> Column:
    """:func:`bucket_ranks` of all lines of ``docs``."""
    return bucket_ranks(with_shingles(lines_of(docs).select("line")))


def _least_shared(n: Column) -> Column:
    """Tokens that a set of n shares with any similar set, at least."""
    return F.ceil(n * UP / DOWN).cast("int")


def _prefix_length(n: Column, shared: int = 1) -> Column:
    """In any order, a similar set has ``shared`` of the first n - least shared
    + ``shared`` tokens (or all that both have, if those are fewer)."""
    return F.least(n, n - _least_shared(n) + shared)


def marked_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line_no, c1, c2, marks of every line with words: c1 and
    c2 are 126 bits of its words and, lowest in c1, the number of marks that it
    shares at least with a similar line; ``marks`` holds at least the prefix for SHARED
    of its shingles, in the order of their first words' hashes.

    So only a part of the shingles is made.  All that start with a word up to
    the limit are taken, a whole start of that order; where repeats leave too
    few of them, all shingles are.
    """
    keep = ["doc_id", "text_key", "line_no"]
    lines = (with_column_once(lines_of(docs), "w", line_words(F.col("line"))).select(*keep, "w")
             .filter(F.size("w") > 0))
    starts = F.slice("w", 1, F.greatest(F.lit(0), F.size("w") - SHINGLE + 1))
    word = lambda i, k: F.coalesce(F.get("w", i + k), F.lit(0))                       # noqa: E731
    # the hash of with_shingles
    shingle = lambda x, i: (x.bitwiseXOR(F.shiftleft(word(i, 1), 5))                  # noqa: E731
                            .bitwiseXOR(F.shiftleft(word(i, 2), 11))
                            .bitwiseXOR(F.shiftleft(word(i, 3), 16))
                            .bitwiseXOR(F.shiftleft(word(i, 4), 17)))
    n = F.size("starts")
    # once: else the lambda below would sort for each word
    limited = with_column_once(lines.select(*keep, "w", starts.alias("starts")), "limit",
                               F.get(F.sort_array("starts"), _prefix_length(n, SHARED) - 1))
    chosen = limited.select("*", F.filter(
        F.transform("starts", lambda x, i: F.when(x <= F.col("limit"), shingle(x, i))),
        lambda x: x.isNotNull()).alias("chosen"))
    marked = chosen.select("*", F.array_distinct("chosen").alias("marks"))
    enough = F.size("marks") >= _prefix_length(n - F.size("chosen") + F.size("marks"), SHARED)
    marks = (F.when(enough, F.col("marks"))
             .when(n > 0, F.array_distinct(F.transform("starts", shingle))).otherwise(F.col("marks")))
    # in c1, so that postings of both sides are the same columns, shuffled once
    need = F.least(F.lit(SHARED), _least_shared(F.size("marks")))
    return materialize(marked.select(
        *keep, F.xxhash64("w").bitwiseAND(F.lit(-4)).bitwiseOR(need).alias("c1"),
        F.xxhash64(F.lit(1), "w").alias("c2"), marks.alias("marks")), "line-marks")


def _position() -> Column:
    """doc_id and line_no as one number of the same order (null first): its
    minimum is found by hash, that of a struct by sorting."""
    doc_id = F.coalesce(F.col("doc_id").cast("decimal(19,0)"), F.lit(Decimal(-(1 << 63) - 1)))
    return (doc_id * F.lit(Decimal(1 << 32)) + F.col("line_no")).cast("decimal(31,0)")


def line_classes(lines: DataFrame) -> DataFrame:
    """c1, c2, own, n of each class: position of its first line, number of lines."""
    return materialize(lines.groupBy("c1", "c2").agg(F.min(_position()).alias("own"), F.count(F.lit(1)).alias("n")),
                       "line-classes")


def meeting_classes(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """c1 of the classes with SHARED marks (or as many as a small set shares at
    least) that other classes have too; no other class can be similar to one.

    Lines post the marks of their class, of those with a POSTERS-th of all lines
    only the first, so that repeats of a line do not meet in one task.
    """
    often = (F.col("n") > 1) & (F.col("n") * POSTERS >= lines.count())           # POSTERS classes at most
    first = F.broadcast(classes.filter(often).select("c1", "c2", "own"))
    posted = (lines.join(first, ["c1", "c2"], "left").filter(F.col("own").isNull() | (F.col("own") == _position()))
              .select("c1", F.explode("marks").alias("mark")))
    with_mark = Window.partitionBy("mark")
    met = (posted.select("c1", "mark", F.min("c1").over(with_mark).alias("low"), F.max("c1").over(with_mark).alias("high"))
           .filter(F.col("low") < F.col("high")).select("c1", "mark").distinct())
    need = F.col("c1").bitwiseAND(F.lit(3))
    return materialize(met.groupBy("c1").agg(F.count(F.lit(1)).alias("n"))
                       .filter(F.col("n") >= need).select("c1"), "line-meeting")


def meeting_sets(docs: DataFrame, lines: DataFrame, classes: DataFrame) -> DataFrame:
    """c1, c2, own, shingles (distinct) of :func:`meeting_classes`, made from
    the first line of each; of other texts and lines nothing is made."""
    wanted = small_side(meeting_classes(lines, classes))
    at = F.struct("doc_id", "line_no", "text_key")
    places = (lines.join(wanted, "c1", "left_semi").groupBy("c1", "c2").agg(F.min(at).alias("at"))
              .select("c1", "c2", F.struct("at.doc_id", "at.line_no").alias("own"), "at.text_key"))
    places = materialize(places, "line-places")
    n = places.count()
    # at most the lines of a text in a list
    named = (places.groupBy(F.col("own.doc_id").alias("p_id"), F.col("text_key").alias("p_key"))
             .agg(F.collect_list(F.struct("c1", "c2", "own")).alias("places")))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("d_id"), "text").filter("text IS NOT NULL")
    found = texts.join(small_side(named, n), F.col("d_id").eqNullSafe(F.col("p_id"))
                       & (F.xxhash64("text") == F.col("p_key"))).select("places", "text")
    # once: else the lambda below would split for each place
    split = with_column_once(found, "lines", F.split("text", "\n")).select("places", "lines")
    placed = split.select(F.explode(F.transform("places", lambda p: F.struct(
        p["c1"].alias("c1"), p["c2"].alias("c2"), p["own"].alias("own"),
        F.get("lines", p["own"]["line_no"]).alias("line")))).alias("at")).select("at.*")
    shingled = with_shingles(placed)
    sets = materialize(shingled.select("c1", "c2", "own", F.array_distinct("shingles").alias("shingles")),
                       "line-sets")
    # more than places only where rows of documents repeat
    return sets if sets.count() == n else materialize(sets.dropDuplicates(["c1", "c2"]), "line-sets")


def postings(sets: DataFrame) -> DataFrame:
    """token, c1, c2, size, place, own, rank of the rarest tokens of each set,
    its prefix; ``rank`` counts the classes of a token by their first lines."""
    n = F.size("shingles")
    ranked = with_ranked(sets.select("c1", "c2", "own", n.alias("size"), "shingles"), bucket_ranks(sets))
    prefix = F.slice(F.sort_array("tokens"), 1, _prefix_length(F.col("size")))
    posted = ranked.select("c1", "c2", "size", "own", F.posexplode(prefix).alias("place", "token"))
    rank = F.row_number().over(Window.partitionBy("token").orderBy("own", "c1", "c2"))
    return materialize(posted.withColumn("rank", rank), "line-postings")


def candidate_pairs(probes: DataFrame, partners: DataFrame) -> DataFrame:
    """a, a2, b, b2: class keys of probes and of earlier partners (both rows of
    :func:`shared_postings`) that pass prefix, length and positional filters."""
    names = {"c1": "{}", "c2": "{}2"}
    left, right = (df.select("token", *(F.col(c).alias(names.get(c, "{}_" + c).format(x))
                                        for c in ("c1", "c2", "size", "place", "own")))
                   for x, df in (("a", probes), ("b", partners)))
    small, large = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    total = F.col("a_size") + F.col("b_size")
    # overlap / (total - overlap) >= 4/5 needs 9 overlap >= 4 total
    reach = 1 + F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place")) - 1
    small_place = F.when(F.col("a_size") <= F.col("b_size"), F.col("a_place")).otherwise(F.col("b_place"))
    return (left.join(right, (left["token"] == right["token"]) & (F.col("b_own") < F.col("a_own"))
                      & (small * DOWN >= large * UP)
                      & (reach * (UP + DOWN) >= total * UP)
                      & (small_place * (UP + DOWN) <= small * (DOWN - UP)))
            .select(*PAIR).distinct())


def similar_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of ``pairs`` whose sets are similar."""
    a, b = (sets.select("c1", "c2", "shingles").toDF(x, f"{x}2", f"{x}_set") for x in ("a", "b"))
    shared = F.size(F.array_intersect("a_set", "b_set"))
    total = F.size("a_set") + F.size("b_set")
    return (pairs.join(a, ["a", "a2"]).join(b, ["b", "b2"])
            .filter(shared * (UP + DOWN) >= total * UP).select(*PAIR))


def resembling_classes(docs: DataFrame, lines: DataFrame, classes: DataFrame) -> DataFrame:
    """c1, c2 of the classes that resemble an earlier one.

    One earlier class is enough, so each class first meets the FIRST_PARTNERS
    earliest classes of each of its prefix tokens: a group of near copies is
    settled by its first members.  Only classes that found none meet the others.
    """
    sets = meeting_sets(docs, lines, classes)
    posted = postings(sets)
    probes = lambda pairs: pairs.select(F.col("a").alias("c1"), F.col("a2").alias("c2")).distinct()
    early, late = F.col("rank") <= FIRST_PARTNERS, F.col("rank") > FIRST_PARTNERS
    first = materialize(candidate_pairs(posted, posted.filter(early)), "line-pairs")
    found = materialize(probes(similar_pairs(first, sets)), "line-found")
    rest = posted.filter(late).join(small_side(found), ["c1", "c2"], "left_anti")
    more = materialize(candidate_pairs(rest, posted.filter(late)), "line-pairs")
    return found.unionByName(probes(similar_pairs(more, sets)))


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, removed: the numbers of the lines to remove, for
    every document that has some."""
    lines = marked_lines(docs)
    classes = line_classes(lines)
    near = materialize(resembling_classes(docs, lines, classes), "line-links").withColumn("near", F.lit(True))
    # all lines of a class that resembles an earlier one; of others, all but the first
    gone = classes.join(small_side(near), ["c1", "c2"], "left").filter((F.col("n") > 1) | F.col("near")).drop("n")
    return (lines.select("doc_id", "text_key", "line_no", "c1", "c2").join(gone, ["c1", "c2"])
            .filter(F.col("near") | (F.col("own") < _position()))
            .groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("removed")))


def remove_duplicate_lines(docs: DataFrame, drop_emptied: bool = False,
                           removed_count: str | None = None) -> DataFrame:
    """``docs``, all columns, without the lines that an earlier line resembles;
    with ``drop_emptied``, without the documents that lose all words;
    ``removed_count`` names a column for the number of lines removed."""
    gone = materialize(removed_lines(docs), "removed-lines").withColumnsRenamed(
        {"doc_id": "gone_id", "text_key": "gone_key", "removed": "gone_lines"})
    both = docs.join(small_side(gone), docs["doc_id"].cast("bigint").eqNullSafe(gone["gone_id"])
                     & (F.xxhash64(docs["text"]) == gone["gone_key"]), "left")
    left = F.array_join(F.filter(F.split(docs["text"], "\n"),
                                 lambda x, i: ~F.array_contains(F.col("gone_lines"), i)), "\n")
    text = F.when(F.col("gone_lines").isNull(), docs["text"]).otherwise(left)
    out = both.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns],
                      F.col("gone_lines"))
    if drop_emptied:
        out = out.filter(F.col("gone_lines").isNull() | (F.size(words(F.col("text"))) > 0))
    if removed_count:
        out = out.withColumn(removed_count, F.coalesce(F.size("gone_lines"), F.lit(0)))
    return out.drop("gone_lines")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines that stay, and how many went."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)))
    return remove_duplicate_lines(docs, removed_count="n_removed").select(
        "doc_id", "n_lines", "n_removed", "text")


#: The same in DuckDB: all pairs of lines that share a shingle.
OP1_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS no, unnest(ls) AS line FROM d),
w AS (SELECT doc_id, no, line, regexp_extract_all(
        lower(line),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM l),
t AS (SELECT doc_id, no, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS t
      FROM w WHERE len(w) > 0),
c AS (SELECT list_sort(t) AS s, min((doc_id, no)) AS first, row_number() OVER () AS cid FROM t GROUP BY 1),
p AS (SELECT cid, len(s) AS n, unnest(s) AS tok FROM c),
pairs AS (SELECT a.cid AS a, b.cid AS b FROM p a JOIN p b ON a.tok = b.tok
          GROUP BY a.cid, b.cid, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n)),
f AS (SELECT pairs.a AS cid, min(c.first) AS first FROM pairs JOIN c ON c.cid = pairs.b GROUP BY pairs.a),
g AS (SELECT t.doc_id, t.no FROM t JOIN c ON list_sort(t.t) = c.s JOIN f ON f.cid = c.cid
      WHERE f.first < (t.doc_id, t.no)),
k AS (SELECT l.doc_id, l.no, l.line, g.no IS NOT NULL AS gone
      FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.no = g.no)
SELECT doc_id, CAST(count(*) AS INT) AS n_lines, CAST(sum(gone::INT) AS INT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '') AS text
FROM k GROUP BY doc_id
"""
