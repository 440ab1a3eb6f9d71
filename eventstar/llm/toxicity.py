"""Toxicity by a convolutional text classifier.

Words and their prefixes are hashed to buckets with learned embeddings, whose
sum embeds the word; filters of several widths
slide over the whole text, each keeps its largest response, and a linear layer
turns these into a logit.  Scores are computed where the texts are.

The network learns from all labelled rows, whole texts, in the tasks: rows are
dealt by doc_id to blocks of about ``BLOCK_ROWS``, blocks to at most ``TURNS``
turns.  In a turn every block of it trains the network of the turn before by
itself, and the changes are averaged; an embedding is averaged over the blocks
that use it.  Every block has its turn; few blocks are gone over more often in
theirs.  A fifth of each block is left out and calibrates the thresholds.  Row
and word counts, sums of changes and the histogram of the calibration are added
up by Spark, in integers, so that the model does not depend on the order or
the partitions of the rows.

The decision threshold is calibrated per language.  The language of a text is
itself inferred from its words (naive Bayes over the same buckets), so the
score of a text depends on the text alone; the logit is shifted by the
threshold, which puts the decision of every language at a score of 0.5.

Defined results: a null or empty text gets the logit of a text without
responses; without labelled rows of both classes every score is the share of
toxic rows (0 without rows); a doc_id with several labels is toxic if one of
them is; of rows that repeat a doc_id the first by language and text is trained
on; repeated documents get one result each; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, slices, small_side, table
from eventstar.session import scratch_path

BUCKETS = 1 << 18                      # bucket 0 is padding
DIM, WIDTHS, FILTERS = 8, (1, 2, 3), 16
CHUNK = 60_000                         # words convolved at a time
PREFIXES = (3, 4, 5, 6, 7)             # subword buckets beside the word's own
BLOCK_ROWS, BLOCK_CHARS = 4096, 64 << 20   # a training block, about
TURNS = 8
#: Changes are summed as multiples of 2**-STEP, calibrated logits rounded to
#: multiples of 2**-GRID.
STEP, GRID = 32, 10
#: Blanks, ASCII punctuation and digits part words.
_WORDS = re.compile(r"[^\s!-@\[-`{-~]+").findall


class Words:
    """Numbers words and keeps the buckets of each: of the word itself and of
    its prefixes.  Words seen are kept up to a bound."""

    def __init__(self, keep: int = 300_000) -> None:
        self.keep = keep
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.prefixes: dict[str, int] = {}
        self.buckets = np.zeros((1024, len(PREFIXES) + 1), np.int32)

    def ids(self, text: str | None) -> np.ndarray:
        """The number of each word of a text; 0 is padding."""
        words = _WORDS((text or "").lower())
        known = self.known
        self.add(set(words).difference(known))
        return np.array(list(map(known.__getitem__, words)), np.int32)

    def add(self, words: Iterable[str]) -> None:
        """Number new words in their order."""
        known, prefixes, found = self.known, self.prefixes, []
        first = len(known) + 1
        for w in words:
            known[w] = len(known) + 1
            found.append(_bucket(w))
            for k in PREFIXES:
                if len(w) <= k:
                    found.append(0)
                    continue
                part = w[:k]
                if part not in prefixes:
                    prefixes[part] = _bucket(part + "*")
                found.append(prefixes[part])
        end = len(known) + 1
        while end > len(self.buckets):
            self.buckets = np.concatenate([self.buckets, np.zeros_like(self.buckets)])
        self.buckets[first:end] = np.array(found, np.int32).reshape(-1, 1 + len(PREFIXES))


def _bucket(feature: str) -> int:
    return 1 + zlib.crc32(feature.encode()) % (BUCKETS - 1)


@dataclass
class Model:
    embedding: np.ndarray                          # BUCKETS x DIM
    kernels: list[np.ndarray]                      # per width: width x DIM x FILTERS
    bias: np.ndarray                               # of all filters
    weight: np.ndarray
    offset: float
    languages: list[str] = field(default_factory=list)
    log_share: np.ndarray | None = None            # BUCKETS x languages
    threshold: np.ndarray | None = None            # logit per language
    constant: float | None = None                  # share of toxic rows, if untrained

    def embed(self, buckets: np.ndarray) -> np.ndarray:
        out = self.embedding[buckets[:, 0]]
        for k in range(1, buckets.shape[1]):
            out += self.embedding[buckets[:, k]]
        return out

    def responses(self, x: np.ndarray) -> np.ndarray:
        """Filter responses at each position of embedded words ``x``; positions
        past the end see zeros."""
        n = len(x)
        out = x @ np.concatenate([kernel[0] for kernel in self.kernels], axis=1)
        for k in range(1, max(WIDTHS)):
            # the filters of more than k words are the last ones
            wide = [kernel[k] for kernel in self.kernels if len(kernel) > k]
            out[:n - k, -len(wide) * FILTERS:] += x[k:] @ np.concatenate(wide, axis=1)
        return out

    def logits(self, texts: list[np.ndarray], buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of texts, shifted by the threshold of their language, and the
        number of that language; ``buckets`` has a row for each word number."""
        pooled = np.zeros((len(texts), len(self.bias)), np.float32)   # relu: 0 at least
        votes = np.zeros((len(texts), max(1, len(self.languages))))
        pad = np.zeros(max(WIDTHS) - 1, np.int32)
        flat = np.concatenate([a for t in texts for a in (t, pad)]) if texts else pad
        ends = np.cumsum([len(t) + len(pad) for t in texts])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        for s in range(0, len(flat), CHUNK):
            e = min(len(flat), s + CHUNK)
            ids = flat[s:min(len(flat), e + len(pad))]
            own, at = np.unique(ids, return_inverse=True)
            r = self.responses(self.embed(buckets[own])[at])[:e - s]
            r += self.bias
            r[ids[:e - s] == 0] = 0                # windows start at words only
            first = int(np.searchsorted(starts, s, "right")) - 1
            last = int(np.searchsorted(starts, e, "left"))
            cuts = np.maximum(starts[first:last], s) - s
            for text, a, b in zip(range(first, last), cuts, [*cuts[1:], len(r)], strict=True):
                np.maximum(pooled[text], r[a:b].max(axis=0), out=pooled[text])
            if self.log_share is not None:
                share = self.log_share[buckets[own, 0]]
                votes[first:last] += np.add.reduceat(share[at[:e - s]], cuts)
        logit = pooled @ self.weight + self.offset
        language = votes.argmax(axis=1)
        if self.threshold is not None:
            logit = logit - self.threshold[language]
        return logit, language

    def scores(self, texts: list[np.ndarray], buckets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(texts, buckets)[0].astype(np.float64), -30, 30)))


def fresh(rare: np.ndarray, seed: int = 7) -> Model:
    """An untrained network.  ``rare`` buckets keep a zero embedding, which keeps
    the network from learning single rows by heart."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    model = Model(rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32),
                  [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(n_filters, np.float32),
                  rng.normal(0, 0.3, n_filters).astype(np.float32), 0.0)
    model.embedding[rare] = 0
    return model


def peaks(model: Model, ids: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter to a text (padded ``ids``) and where
    it stands."""
    pad = max(WIDTHS) - 1
    best = where = None
    for s in range(0, len(ids) - pad, CHUNK):
        out = model.responses(model.embed(buckets[ids[s:s + CHUNK + pad]]))[:min(CHUNK, len(ids) - pad - s)]
        at = out.argmax(axis=0)
        top = out[at, np.arange(out.shape[1])]
        if best is None:
            best, where = top, at
        else:
            where = np.where(top > best, at + s, where)
            best = np.maximum(best, top)
    return best + model.bias, where


def descend(model: Model, texts: list[np.ndarray], buckets: np.ndarray, toxic: np.ndarray, share: float,
            rare: np.ndarray, epochs: int, seed: int = 7, batch: int = 32, rate: float = 0.02,
            word_dropout: float = 0.3) -> None:
    """Train ``model`` in place on the logistic loss by Adam; ``share`` is that of
    toxic rows in all.  Each step hides a share of the words."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    class_weight = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
    params = {"bias": model.bias, "weight": model.weight, "offset": np.full(1, model.offset, np.float32)}
    params |= {f"kernel{i}": k for i, k in enumerate(model.kernels)}
    mean = {k: np.zeros_like(v) for k, v in params.items()}
    square = {k: np.zeros_like(v) for k, v in params.items()}
    e_mean, e_square = np.zeros_like(model.embedding), np.zeros_like(model.embedding)
    pad = np.zeros(max(WIDTHS) - 1, np.int32)
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            grads = {k: np.zeros_like(v) for k, v in params.items()}
            e_ids, e_grads = [], []
            for r in rows:
                if not len(texts[r]):
                    continue
                ids = np.concatenate([np.where(rng.random(len(texts[r])) < word_dropout, 0, texts[r]), pad])
                best, where = peaks(model, ids, buckets)
                pooled = np.maximum(best, 0)
                logit = float(pooled @ model.weight) + float(params["offset"][0])
                p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                g = np.float32((p - toxic[r]) * class_weight[r] / len(rows))
                grads["weight"] += g * pooled
                grads["offset"] += g
                d = g * model.weight * (pooled > 0)
                grads["bias"] += d
                for i, w in enumerate(WIDTHS):
                    cols = slice(i * FILTERS, (i + 1) * FILTERS)
                    spot = where[cols, None] + np.arange(w)                    # filters x words
                    own = buckets[ids[spot]]
                    x = model.embed(own.reshape(-1, own.shape[2])).reshape(*spot.shape, DIM)
                    grads[f"kernel{i}"] += x.transpose(1, 2, 0) * d[cols]
                    e_ids.append(own.ravel())
                    e_grads.append(np.repeat((model.kernels[i] * d[cols]).transpose(2, 0, 1).reshape(-1, DIM),
                                             buckets.shape[1], axis=0))
            if not e_ids:
                continue
            t += 1
            fix = np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
            for k, g in grads.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                params[k] -= (rate * fix * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
            ids, inverse = np.unique(np.concatenate(e_ids), return_inverse=True)
            g = np.zeros((len(ids), DIM), np.float32)
            np.add.at(g, inverse, np.concatenate(e_grads))
            e_mean[ids] = 0.9 * e_mean[ids] + 0.1 * g
            e_square[ids] = 0.999 * e_square[ids] + 0.001 * g * g
            step = rate * fix * e_mean[ids] / (np.sqrt(e_square[ids]) + 1e-8)
            step[rare[ids]] = 0
            model.embedding[ids] -= step
    model.offset = float(params["offset"][0])


def rows_with(texts: list[np.ndarray], buckets: np.ndarray) -> np.ndarray:
    """In how many texts each bucket occurs."""
    found = np.zeros(BUCKETS, np.int64)
    for ids in texts:
        found[np.unique(buckets[ids])] += 1
    return found


def rare_buckets(found: np.ndarray, least_rows: int = 5) -> np.ndarray:
    rare = found < least_rows
    rare[0] = True
    return rare


def toxic_share(toxic: float, rows: int) -> float:
    return float(np.clip(toxic / max(1, rows), 0.02, 0.98))


def train(texts: list[np.ndarray], buckets: np.ndarray, toxic: np.ndarray, langs: list[str], epochs: int = 8
          ) -> Model:
    """A model of rows at hand, as one block: a fifth of them is left out and
    calibrates the thresholds."""
    rare = rare_buckets(rows_with(texts, buckets))
    model = fresh(rare)
    if len(set(toxic.tolist())) < 2:
        model.constant = float(toxic.mean()) if len(toxic) else 0.0
        return model
    order = np.random.default_rng(7).permutation(len(texts))
    held, used = order[:len(order) // 5], order[len(order) // 5:]
    descend(model, [texts[i] for i in used], buckets, toxic[used],
            toxic_share(toxic[used].sum(), len(used)), rare, epochs)
    names = sorted({langs[i] for i in used})
    counts = np.zeros((BUCKETS, len(names)))
    for i in used:
        np.add.at(counts[:, names.index(langs[i])], buckets[texts[i], 0], 1)
    learn_languages(model, names, counts)
    if len(held):
        logit, language = model.logits([texts[i] for i in held], buckets)
        calibrate(model, np.round(logit * (1 << GRID)).astype(np.int64), language, toxic[held],
                  np.ones(len(held), np.int64))
    return model


def learn_languages(model: Model, names: list[str], counts: np.ndarray) -> None:
    """Log share of each bucket among the words of a language, from the number
    of its words in each bucket."""
    counts = counts + 0.1
    counts[0] = 1
    share = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    share[0] = 0
    model.languages, model.log_share = names, share


def calibrate(model: Model, grid: np.ndarray, language: np.ndarray, toxic: np.ndarray, n: np.ndarray,
              least: int = 8) -> None:
    """Per inferred language, the logit that errs least on held rows, in the
    middle of its gap; languages with few rows of a class share one.  The rows
    come as their number ``n`` for each logit (in steps of the grid), language
    and label."""
    def best(own: np.ndarray) -> float:
        at, inverse = np.unique(grid[own], return_inverse=True)
        bad = np.bincount(inverse, n[own] * toxic[own], len(at))
        good = np.bincount(inverse, n[own] * (1 - toxic[own]), len(at))
        # cutting before position i: positives below plus negatives from i on
        errors = np.concatenate([[0], np.cumsum(bad)]) + good.sum() - np.concatenate([[0], np.cumsum(good)])
        i = int(errors.argmin())
        if i == 0 or i == len(at):
            cut = at[0] - (1 << GRID) if i == 0 else at[-1] + (1 << GRID)
        else:
            cut = (at[i - 1] + at[i]) / 2
        return float(cut) / (1 << GRID)

    every = np.ones(len(grid), bool)
    bad = int((n * toxic).sum())
    shared = best(every) if 0 < bad < n.sum() else 0.0
    model.threshold = np.full(len(model.languages), shared)
    for k in range(len(model.languages)):
        own = language == k
        if least <= (n[own] * toxic[own]).sum() <= n[own].sum() - least:
            model.threshold[k] = best(own)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, lang, text of all documents with a label to learn."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic")
             .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        F.coalesce("lang", F.lit("")).alias("lang"))
            .join(small_side(known), "doc_id").select("doc_id", "toxic", "lang", "text"))


def training_rows(docs: DataFrame, labels: DataFrame, rows_per_class: int, max_words: int
                  ) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[str]]:
    """Up to ``rows_per_class`` labelled rows of each class, of at most about
    ``max_words`` words, for trials of ``train`` at hand; ``fit`` learns from
    all rows."""
    rows = labelled(docs, labels).filter(
        (F.size(F.split("text", " ")) <= max_words) & (F.length("text") <= 10 * max_words))
    # one row of each doc_id, however many repeat it
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("toxic", "lang", "text")).alias("row"))
    rows = rows.select("doc_id", "row.*")
    picks = [rows.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
             .limit(rows_per_class) for y in (0, 1)]
    got = picks[0].unionByName(picks[1]).toArrow()
    got = sorted(zip(*(got.column(k).to_pylist() for k in range(4)), strict=True))
    words = Words(keep=1 << 30)
    return ([words.ids(r[3]) for r in got], words.buckets,
            np.array([r[1] for r in got], np.int64), [r[2] for r in got])


_BLOCK = ("block int, words array<string>, ids binary, sizes binary, toxic binary, held binary, "
          "langs array<string>, turn int")


def blocks(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """All labelled rows, one per doc_id, as numbered words: a row per block,
    written by turn, and the number of blocks."""
    spark = docs.sparkSession
    rows = labelled(docs, labels)
    n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    many = max(1, -(-n // BLOCK_ROWS), -(-chars // BLOCK_CHARS))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(many)).cast("int"))
    tasks = min(many, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # one shuffle: what is dealt by block is also dealt by block and doc_id
    once = (dealt.repartition(tasks, "block").groupBy("block", "doc_id")
            .agg(F.min(F.struct("toxic", "lang", "text")).alias("row"))
            .select("block", F.xxhash64(F.lit(1), "doc_id").alias("place"), "doc_id", "row.*"))

    def number(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("place", "ascending"), ("doc_id", "ascending")])
        words = Words(keep=1 << 30)
        ids = [words.ids(t.as_py()) for t in rows["text"]]
        block = rows["block"][0].as_py()
        packed = [np.asarray(x, kind).tobytes() for x, kind in (
            (np.concatenate(ids), "<i4"), ([len(i) for i in ids], "<i8"),
            (rows["toxic"].to_numpy(), "i1"), (rows["place"].to_numpy() % 5 == 0, "i1"))]
        return pa.table([pa.array([block], pa.int32()), pa.array([list(words.known)], pa.list_(pa.string())),
                         *[pa.array([x], pa.binary()) for x in packed],
                         pa.array([rows["lang"].to_pylist()], pa.list_(pa.string())),
                         pa.array([block % TURNS], pa.int32())],
                        ["block", "words", "ids", "sizes", "toxic", "held", "langs", "turn"])
    path = scratch_path(spark, "training-blocks")
    once.groupBy("block").applyInArrow(number, _BLOCK).write.partitionBy("turn").parquet(path)
    return spark.read.schema(_BLOCK).parquet(path), many


@dataclass
class Block:
    number: int
    buckets: np.ndarray
    texts: list[np.ndarray]
    toxic: np.ndarray
    held: np.ndarray
    langs: list[str]


def _blocks_in(batch: pa.RecordBatch) -> Iterator[Block]:
    for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
        words = Words(keep=1 << 30)
        words.add(row["words"])
        cuts = np.cumsum(np.frombuffer(row["sizes"], "<i8"))[:-1]
        yield Block(row["block"], words.buckets, np.split(np.frombuffer(row["ids"], "<i4"), cuts),
                    np.frombuffer(row["toxic"], "i1").astype(np.int64),
                    np.frombuffer(row["held"], "i1").astype(bool), row["langs"])


def count(found: DataFrame) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Over all blocks: rows with each bucket, rows to train on by label, the
    languages of these, their words by bucket and language."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in _blocks_in(batch):
            used = np.flatnonzero(~b.held)
            every = rows_with(b.texts, b.buckets)
            at = np.flatnonzero(every)
            parts = [("row", None, at, every[at]),
                     ("label", None, np.arange(2), np.bincount(b.toxic[used], minlength=2)),
                     ("held", None, np.arange(2), np.bincount(b.toxic[b.held], minlength=2))]
            for lang in sorted({b.langs[i] for i in used}):
                own = [b.buckets[b.texts[i], 0] for i in used if b.langs[i] == lang]
                at, n = np.unique(np.concatenate([*own, [0]]), return_counts=True)
                parts.append(("word", lang, at, n))
            for what, lang, at, n in parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([what] * len(at), pa.string()), pa.array([lang] * len(at), pa.string()),
                     pa.array(at, pa.int32()), pa.array(n, pa.int64())], ["what", "lang", "at", "n"])
    summed = (arrow_map(found, run, "what string, lang string, at int, n bigint")
              .groupBy("what", "lang", "at").agg(F.sum("n").alias("n")).toArrow())   # buckets x languages at most
    what, lang = np.array(summed["what"].to_pylist(), object), np.array(summed["lang"].to_pylist(), object)
    at, n = summed["at"].to_numpy(), summed["n"].to_numpy()

    def counts(which: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(at[which], n[which], size).astype(np.int64)
    names = sorted(set(lang[what == "word"].tolist()))
    by_lang = [counts((what == "word") & (lang == x), BUCKETS) for x in names]
    labels = np.stack([counts(what == "label", 2), counts(what == "held", 2)])
    return (counts(what == "row", BUCKETS), labels, names,
            np.stack(by_lang, axis=1) if names else np.zeros((BUCKETS, 0), np.int64))


def _dense(model: Model) -> np.ndarray:
    """All weights but the embeddings."""
    return np.concatenate([*[k.ravel() for k in model.kernels], model.bias, model.weight, [model.offset]])


def _with_dense(model: Model, flat: np.ndarray) -> Model:
    kernels, at = [], 0
    for w in WIDTHS:
        size = w * DIM * FILTERS
        kernels.append(flat[at:at + size].reshape(w, DIM, FILTERS).astype(np.float32))
        at += size
    n = FILTERS * len(WIDTHS)
    return Model(model.embedding.copy(), kernels, flat[at:at + n].astype(np.float32),
                 flat[at + n:at + 2 * n].astype(np.float32), float(flat[-1]))


def train_turn(found: DataFrame, model: Model, rare: np.ndarray, share: float, epochs: int) -> Model:
    """``model`` with the averaged changes of the blocks ``found``.  Row k of the
    sums is the change of embedding k; rows beyond them hold the other weights."""
    spark = found.sparkSession
    shared = spark.sparkContext.broadcast((model, rare))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        start, rare = shared.value
        for b in _blocks_in(batch):
            own = _with_dense(start, _dense(start))
            used = np.flatnonzero(~b.held)
            descend(own, [b.texts[i] for i in used], b.buckets, b.toxic[used], share, rare, epochs,
                    seed=7 + b.number)
            change = own.embedding - start.embedding
            at = np.flatnonzero(change.any(axis=1))
            dense = _dense(own) - _dense(start)
            dense = np.concatenate([dense, np.zeros(-len(dense) % DIM)]).reshape(-1, DIM)
            at = np.concatenate([at, BUCKETS + np.arange(len(dense))])
            whole = np.round(np.concatenate([change[at[:len(at) - len(dense)]], dense]).astype(np.float64)
                             * (1 << STEP)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *map(pa.array, whole.T)],
                                             ["at", *[f"d{k}" for k in range(DIM)]])
    names = [f"d{k}" for k in range(DIM)]
    summed = (arrow_map(found, run, "at int, " + ", ".join(f"{c} bigint" for c in names))
              .groupBy("at").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names])
              .toArrow())                                            # one row per bucket at most
    at = summed["at"].to_numpy()
    mean = (np.stack([summed[c].to_numpy() for c in names], axis=1)
            / summed["n"].to_numpy()[:, None] / (1 << STEP))
    shared.destroy()
    dense = _dense(model)
    change = np.zeros((-(-len(dense) // DIM), DIM))
    change[at[at >= BUCKETS] - BUCKETS] = mean[at >= BUCKETS]
    out = _with_dense(model, dense + change.ravel()[:len(dense)])
    out.embedding[at[at < BUCKETS]] += mean[at < BUCKETS].astype(np.float32)
    return out


def held_logits(found: DataFrame, model: Model) -> list[np.ndarray]:
    """grid, language, toxic, n: the histogram of all held rows."""
    shared = found.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in _blocks_in(batch):
            held = np.flatnonzero(b.held)
            if not len(held):
                continue
            logit, language = shared.value.logits([b.texts[i] for i in held], b.buckets)
            grid = np.round(np.clip(logit, -30, 30) * (1 << GRID)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grid), pa.array(language.astype(np.int32)), pa.array(b.toxic[held])],
                ["grid", "language", "toxic"])
    summed = (arrow_map(found, run, "grid bigint, language int, toxic bigint")
              .groupBy("grid", "language", "toxic").agg(F.count(F.lit(1)).alias("n"))
              .toArrow())                       # points of the grid x languages x 2 at most
    return [summed[c].to_numpy() for c in ("grid", "language", "toxic", "n")]


def fit(docs: DataFrame, labels: DataFrame, epochs: int = 8) -> Model:
    """A model trained on all labelled rows; ``epochs`` is how often a single
    block is gone over."""
    found, many = blocks(docs, labels)
    rows, by_label, names, words_of = count(found)
    rare = rare_buckets(rows)
    model = fresh(rare)
    every = by_label.sum(axis=0)
    if not every.all():
        model.constant = float(every[1] / every.sum()) if every.sum() else 0.0
        return model
    share = toxic_share(by_label[0, 1], by_label[0].sum())
    for turn in range(min(many, TURNS)):
        model = train_turn(found.filter(F.col("turn") == turn), model, rare, share, max(1, epochs // many))
    learn_languages(model, names, words_of)
    calibrate(model, *held_logits(found, model))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of every document, over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    words = Words()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text", 4 << 20):
            if len(words.known) > words.keep:
                words.clear()
            texts = [words.ids(t) for t in part.column(1).to_pylist()]
            found = shared.value.scores(texts, words.buckets)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])
    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run,
                     "doc_id bigint, score double, predicted int")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; rows whose crc32(doc_id) mod 5 is 0
    are held out from training."""
    docs = table(spark, sf_dir, "documents")
    found = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")
