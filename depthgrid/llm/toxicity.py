"""Toxicity by a factorization machine over hashed terms, fitted in numpy.

A text's terms are its words (runs of ASCII letters and digits and of non-ASCII bytes, A-Z
lower-cased), and the words' first four and five bytes, which catch inflections; all are hashed
into 2**20 buckets and count once per text. The score is a sigmoid of a bias, one weight per
bucket and the inner products of all pairs of present buckets' factors, so a pair of terms can
count where neither does alone.

Fitting reads labelled rows outside the held-out fold, at most SAMPLE_ROWS of them (ids of the
smallest md5 first, then sets of terms of the smallest digest, each distinct set once; a documented
bound), keeps at most FEATURES buckets and runs AdaGrad on their presence. A first share of the
places goes to the buckets that tell most on their own (by chi-square); after them come the most
frequent ones of toxic texts and of all texts, whatever they tell alone, so that pairs of them can be
learned. How many of these (FILLS) is settled by the loss on a fifth of the sampled texts, left out
for that: terms that tell nothing even in pairs only add chance. The driver gets one list of feature
numbers per sampled text. Labels, language,
source and id are no inputs of a score. Scoring is one pass over every whole text without a shuffle.

Defined cases: a null or empty text has no terms and its score is the sigmoid of the bias;
without a positive and a negative labelled row every score is 0; several labels of one id count
as their largest, a null label as none; a null id is held out; a very long text is read in blocks of
words, all of it; repeated rows are scored each, and fitted once; an empty table gives an empty table;
other columns are carried on request under any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthgrid.llm import words
from depthgrid.llm.shared import stored

#: Bound of the labelled rows that are fitted, of the buckets kept and of the hash space.
SAMPLE_ROWS, FEATURES, BUCKETS = 20_000, 4_096, 1 << 20
#: A bucket of the first share needs this many labelled texts and this chi-square, which chance
#: rarely gives to one; the others of the places are dealt by frequency.
LEAST_TEXTS, LEAST_CHI, TELLING_SHARE = 8, 20.0, 0.5
#: Numbers of frequent buckets that are tried, and the share by which the loss has to fall for more.
FILLS, LEAST_FALL = (0, 256, 1024), 0.2
FACTORS, EPOCHS, BATCH, STEP, DECAY, SEED = 8, 12, 256, 0.1, 1e-4, 7
FOLDS = 5
PREFIXES = (4, 5)

_U64 = np.uint64
_BREAK = np.zeros(256, bool)
_BREAK[:128] = [not (chr(b).isalnum()) for b in range(128)]


def held_out(id_col: Column) -> Column:
    """The fold that labels are never learned from: crc32 of the id's text modulo 5 is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS, F.lit(0)) == 0


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every term of the texts, repeats included."""
    _, _, whole, bounds, *prefixes = words.word_hashes(column, _BREAK, PREFIXES)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    bucket = [(h >> _U64(44)).astype(np.int64) for h in (whole, *prefixes)]
    return np.tile(row, len(bucket)), np.concatenate(bucket)


def _distinct(row: np.ndarray, bucket: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(row * width + bucket)
    return key // width, key % width


@dataclass(frozen=True)
class Model:
    """``place`` maps buckets to feature numbers (-1: not a feature)."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, column: pa.Array) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(column))
        row, bucket = terms(column)
        feature = self.place[bucket]
        known = feature >= 0
        row, feature = _distinct(row[known], feature[known].astype(np.int64), len(self.weights))
        return _sigmoid(_margins(row, feature, len(column), self.bias, self.weights, self.factors)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _margins(row, feature, rows, bias, weights, factors):
    """Margins, and each row's sum of factors, in time linear in the present features."""
    linear = np.bincount(row, weights[feature], minlength=rows)
    sums = np.zeros((rows, factors.shape[1]))
    squares = np.zeros(rows)
    if len(row):
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        present = factors[feature]
        sums[row[starts]] = np.add.reduceat(present, starts)
        squares[row[starts]] = np.add.reduceat((present**2).sum(axis=1), starts)
    return bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums


def fit_machine(row, feature, label, features: int, seed: int = SEED):
    """AdaGrad on the logistic loss; ``row`` is sorted and indexes ``label``."""
    draw = np.random.default_rng(seed)
    weights, factors = np.zeros(features), draw.normal(0, 0.01, (features, FACTORS))
    share = float(np.clip(label.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    g_w, g_v, g_b = np.full(features, 1e-8), np.full(factors.shape, 1e-8), 1e-8
    first = np.searchsorted(row, np.arange(len(label) + 1))
    for _ in range(EPOCHS):
        order = draw.permutation(len(label))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            sizes = first[chosen + 1] - first[chosen]
            local = np.repeat(np.arange(len(chosen)), sizes)
            at = np.arange(sizes.sum()) + np.repeat(first[chosen] - (np.cumsum(sizes) - sizes), sizes)
            f = feature[at]
            margin, sums = _margins(local, f, len(chosen), bias, weights, factors)
            error = (_sigmoid(margin) - label[chosen]) / len(chosen)
            slope = error[local]
            seen, back = np.unique(f, return_inverse=True)
            d_w = np.bincount(back, slope, minlength=len(seen)) + DECAY * weights[seen]
            pull = slope[:, None] * (sums[local] - factors[f])
            d_v = np.column_stack([np.bincount(back, pull[:, k], minlength=len(seen)) for k in range(FACTORS)])
            d_v = d_v + DECAY * factors[seen]
            g_w[seen] += d_w**2
            g_v[seen] += d_v**2
            weights[seen] -= STEP * d_w / np.sqrt(g_w[seen])
            factors[seen] -= STEP * d_v / np.sqrt(g_v[seen])
            d_b = float(error.sum())
            g_b += d_b**2
            bias -= STEP * d_b / np.sqrt(g_b)
    return bias, weights, factors


def _bucket_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.slices(batch, "__text"):
            row, bucket = _distinct(*terms(part.column("__text")), BUCKETS)
            bucket = bucket.astype(np.int32)
            ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            keys = [
                hashlib.blake2b(bucket[a:b].tobytes(), digest_size=16).hexdigest() for a, b in zip(ends[:-1], ends[1:])
            ]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), part.column("__label"), lists], ["__key", "__label", "__buckets"]
            )


def _labelled_sets(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int):
    """At most ``most`` distinct sets of terms (__key, __label, __buckets), each with its largest label.

    Copies would make their chance words look telling, so a set counts once.
    """
    marked = (
        labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
        .filter(~held_out(F.col("__id")) & F.col("__label").isNotNull())
        .groupBy("__id").agg(F.max("__label").alias("__label"))
    )
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    known = marked.join(texts.select("__id").distinct(), "__id", "left_semi")
    order = F.md5(F.concat(F.lit("toxicity:"), F.col("__id").cast("string")))
    ids = stored(known.orderBy(order, "__id").limit(most), most)  # bounded, so it is broadcast
    rows = stored(
        texts.join(F.broadcast(ids), "__id").select("__label", "__text")
        .mapInArrow(_bucket_lists, "__key string, __label int, __buckets array<int>")
        .withColumn("__row", F.monotonically_increasing_id())
    )
    # An id may have many texts: the bound holds for sets, too. Lists stay where they are until
    # one row of each set is chosen.
    chosen = stored(
        rows.groupBy("__key").agg(F.max("__label").alias("__label"), F.min("__row").alias("__row"))
        .orderBy("__key").limit(most),
        most,
    )
    return stored(rows.select("__row", "__buckets").join(F.broadcast(chosen), "__row").drop("__row"))


def _chosen_buckets(rows: DataFrame, n: int, p: int) -> tuple[np.ndarray, int]:
    """At most FEATURES buckets, and how many of them, the first ones, tell on their own."""
    both, hits = F.col("both"), F.col("hits")
    gap = hits - both * F.lit(p / n)
    spread = both * (F.lit(float(n)) - both) * F.lit(p / n * (1 - p / n))
    chi = gap * gap * F.lit(float(n - 1)) / spread
    counts = stored(
        rows.select("__label", F.explode("__buckets").alias("bucket"))
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("both"), F.sum("__label").alias("hits"))
        .filter((both < n) & (both > 1))
    )

    def first(table: DataFrame, by: list, most: int) -> list[int]:
        return table.orderBy(*by, "bucket").limit(most).select("bucket").toArrow().column(0).to_pylist()

    telling = counts.filter((both >= LEAST_TEXTS) & (chi >= LEAST_CHI))
    found = first(telling, [chi.desc()], int(FEATURES * TELLING_SHARE))
    held = dict.fromkeys(found)
    ranked = [first(counts, [c.desc()], FEATURES) for c in (hits, both)]
    for pair in zip(*ranked):
        for bucket in pair:
            if len(held) < FEATURES:
                held.setdefault(bucket)
    return np.array(list(held), np.int64), len(found)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on at most ``sample_rows`` labelled sets of terms outside the held-out fold."""
    rows = _labelled_sets(docs, labels, id_col, text_col, label_col, sample_rows)
    n = rows.count()
    p = rows.filter("__label = 1").count()
    if not 0 < p < n:
        return Model(np.zeros(0, np.int16), 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    best, telling = _chosen_buckets(rows, n, p)
    place = np.full(BUCKETS, -1, np.int16)
    place[best] = np.arange(len(best))
    shared = rows.sparkSession.sparkContext.broadcast(place)  # 2 MB, fixed by BUCKETS

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("__buckets")
            found = shared.value[lists.flatten().to_numpy()]
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[found >= 0], minlength=batch.num_rows))])
            kept = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found[found >= 0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key"), batch.column("__label"), kept], ["__key", "__label", "__features"]
            )

    sample = (
        rows.mapInArrow(features, "__key string, __label int, __features array<smallint>").toArrow()
        .sort_by("__key").combine_chunks()
    )
    lists = sample.column("__features").combine_chunks()
    row = np.repeat(np.arange(len(lists), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    label = sample.column("__label").to_numpy().astype(float)
    cells = (row, lists.flatten().to_numpy())
    most = _features_wanted(*cells, label, telling, len(best))
    place[best[most:]] = -1
    used = cells[1] < most
    bias, weights, factors = fit_machine(cells[0][used], cells[1][used], label, most)
    return Model(place, bias, weights, factors)


def _all_margins(row: np.ndarray, feature: np.ndarray, rows: int, model: tuple) -> np.ndarray:
    """Margins of many rows, BATCH at a time; ``row`` is sorted."""
    out = np.zeros(rows)
    for begin in range(0, rows, BATCH):
        end = min(begin + BATCH, rows)
        a, b = np.searchsorted(row, (begin, end))
        out[begin:end] = _margins(row[a:b] - begin, feature[a:b], end - begin, *model)[0]
    return out


def _features_wanted(row: np.ndarray, feature: np.ndarray, label: np.ndarray, telling: int, most: int) -> int:
    """The number of features, the first ones, whose machine does best on every fifth text."""
    apart = np.arange(len(label)) % 5 == 4
    if len({*label[~apart]}) < 2 or not apart.any():
        return telling or most
    place, other = (np.cumsum(side, dtype=np.int32) - 1 for side in (~apart, apart))
    best = None
    for limit in sorted({min(telling + fill, most) for fill in FILLS} - {0}):
        known = feature < limit
        learned = known & ~apart[row]
        model = fit_machine(place[row[learned]], feature[learned], label[~apart], limit)
        judged = known & apart[row]
        margin = _all_margins(other[row[judged]], feature[judged], int(apart.sum()), model)
        chance = np.clip(_sigmoid(margin), 1e-6, 1 - 1e-6)
        truth = label[apart]
        loss = -float(np.mean(truth * np.log(chance) + (1 - truth) * np.log(1 - chance)))
        if best is None or loss < best[0] * (1 - LEAST_FALL):
            best = (loss, limit)
    return best[1] if best else most


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``__score``; one pass, every row and whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, fixed by FEATURES, BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text_col):
                found = shared.value.scores(part.column(text_col))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found)], [*part.schema.names, "__score"]
                )

    schema = docs.schema.fromJson(docs.schema.jsonValue()).add("__score", "double")
    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """``docs`` without the rows whose score is 0.5 or more."""
    model = fit(docs, labels, id_col, text_col)
    return score(docs, model, text_col).filter("__score < 0.5").drop("__score")
