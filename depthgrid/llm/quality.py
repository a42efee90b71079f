"""Document quality: random Fourier features of document statistics, ridge scores, isotonic calibration.

One pass over every whole text gives a narrow row of statistics (shares of byte classes, word and
line lengths, repetition, entropy). Standardised over all documents and cut at CLIP deviations, they
go through FEATURES random cosines, which approximate a Gaussian kernel of width WIDTH (in
deviations per root of the number of statistics). Ridge weights solve the normal equations, whose
sums are taken per partition and fold and added up over the cluster; the penalty is the one with
the least squared error on the folds left out, which follows from the same sums. Scores of left-out
folds on a grid of GRID steps are then made monotone against the labels by pooling neighbours.

All labelled rows outside the held-out fold are fitted; there is no sample. The driver holds FOLDS
matrices of (FEATURES + 2) squared numbers and one row per grid step. Labels, language, source and
id are no inputs of a score.

Defined cases: a null or empty text has statistics like any other (all 0); without a labelled row
every score is 0.5, and with one class only that class; several labels of one id count as their
largest, a null label as none; a null id is held out; repeated rows are scored each, and fitted each;
a very long text is read in blocks of words; an empty table gives an empty table; the id and the
columns named in ``carry`` are passed on under any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthgrid.llm import words
from depthgrid.llm.shared import counted, stored

HELD_OUT_OF, HELD_OUT_REST = 3, 1
FEATURES, WIDTH, CLIP, FOLDS, SEED = 256, 1.0, 4.0, 4, 11
PENALTIES = (1e-5, 1e-4, 1e-3, 1e-2)
#: Steps of the raw score's grid for calibration, over LOW..HIGH.
GRID, LOW, HIGH = 4096, -0.5, 1.5
#: Labelled rows whose sums one task takes.
TASK_ROWS = 100_000

_U64 = np.uint64


def held_out(id_col: Column) -> Column:
    """The fold that labels are never learned from: crc32 of the id's text modulo 3 is 1."""
    return F.coalesce(
        F.crc32(id_col.cast("string").cast("binary")) % HELD_OUT_OF, F.lit(HELD_OUT_REST)
    ) == HELD_OUT_REST


# ---------------------------------------------------------------- statistics of a text


def _classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, blank, line end, stop, other ASCII sign, control, high."""
    kind = np.full(256, 6, np.int64)
    kind[128:] = 8
    kind[:32] = 7
    kind[127] = 7
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1] = 0, 1
    kind[ord("0") : ord("9") + 1] = 2
    kind[[32, 9]] = 3
    kind[[10, 13]] = 4
    kind[[ord(c) for c in ".,;:!?'\"()-"]] = 5
    return kind


_CLASS = _classes()
_N_CLASS = 9
_LINE_END = np.zeros(256, bool)
_LINE_END[[10, 13]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True
NAMES = (
    *(f"share_{c}" for c in ("lower", "upper", "digit", "blank", "line", "stop", "sign", "control", "high")),
    "log_bytes", "log_words", "mean_word", "spread_word", "short_words", "long_words", "distinct_words",
    "top_word", "distinct_shingles", "log_lines", "mean_line", "distinct_lines", "ended_words", "entropy",
)


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches, 0 for empty ones."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeats(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's number of distinct values and count of its most frequent one."""
    rows = len(bounds) - 1
    distinct, most = np.zeros(rows), np.zeros(rows)
    if not len(hashes):
        return distinct, most
    row = np.repeat(np.arange(rows), np.diff(bounds))
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])])
    count, owner = np.diff(np.r_[first, len(h)]), r[first]
    begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    most[owner[begin]] = np.maximum.reduceat(count, begin)
    return np.bincount(owner, minlength=rows).astype(float), most


def statistics(column: pa.Array) -> np.ndarray:
    """One row of len(NAMES) numbers for each text, from all of its bytes."""
    data, offsets = words.text_bytes(column)
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    row = np.repeat(np.arange(n), np.diff(offsets))
    held = np.zeros((n, 256))
    for begin in range(0, len(data), words.BLOCK_BYTES):
        part = slice(begin, begin + words.BLOCK_BYTES)
        cell = row[part] * 256 + data[part]
        low = int(row[begin]) * 256
        counts = np.bincount(cell - low)
        held.reshape(-1)[low : low + len(counts)] += counts
    shares = held / np.maximum(size, 1)[:, None]
    by_class = np.zeros((n, _N_CLASS))
    for c in range(_N_CLASS):
        by_class[:, c] = shares[:, _CLASS == c].sum(axis=1)
    logs = np.zeros_like(shares)
    np.log2(shares, out=logs, where=shares > 0)
    entropy = -(shares * logs).sum(axis=1)

    starts, ends, hashes, bounds, = words.word_hashes(column)[:4]
    length = (ends - starts).astype(float)
    count = np.diff(bounds).astype(float)
    some = np.maximum(count, 1)
    mean = _per_row(length, bounds) / some
    spread = np.sqrt(np.maximum(_per_row(length**2, bounds) / some - mean**2, 0))
    distinct, top = _repeats(hashes, bounds)
    shingles, shingle_bounds = words.shingles(hashes, bounds)
    n_shingles = np.maximum(np.diff(shingle_bounds), 1)
    lines = words.word_hashes(column, _LINE_END)
    n_lines = np.diff(lines[3]).astype(float)
    ended = _STOP[data[ends - 1]] if len(ends) else np.zeros(0)
    return np.column_stack(
        [
            by_class,
            np.log1p(size),
            np.log1p(count),
            np.log1p(mean),
            np.log1p(spread),
            _per_row(length <= 2, bounds) / some,
            _per_row(length > 12, bounds) / some,
            distinct / some,
            top / some,
            _repeats(shingles, shingle_bounds)[0] / n_shingles,
            np.log1p(n_lines),
            np.log1p(_per_row((lines[1] - lines[0]).astype(float), lines[3]) / np.maximum(n_lines, 1)),
            _repeats(lines[2], lines[3])[0] / np.maximum(n_lines, 1),
            _per_row(ended, bounds) / some,
            entropy,
        ]
    )


def document_statistics(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """(__id, __stats, carried columns) of every row of ``docs``; one pass, no shuffle."""
    kept = docs.select(F.col(id_col).alias("__id"), *carry, F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "__text"):
                found = statistics(part.column("__text"))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(NAMES))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], lists.cast(pa.list_(pa.float64()))],
                    [*part.schema.names[:-1], "__stats"],
                )

    schema = kept.drop("__text").schema.add("__stats", T.ArrayType(T.DoubleType()))
    return kept.mapInArrow(run, schema)


# ---------------------------------------------------------------- the model


@dataclass(frozen=True)
class Cosines:
    """Standardised statistics to random Fourier features, and a last feature that is always 1."""

    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.centre) / self.scale, -CLIP, CLIP)
        waves = np.cos(x @ self.directions + self.phases) * np.sqrt(2.0 / len(self.phases))
        return np.column_stack([waves, np.ones(len(stats))])


@dataclass(frozen=True)
class Model:
    """Ridge weights and the calibration's points; without labelled rows both are empty."""

    cosines: Cosines
    weights: np.ndarray
    points: np.ndarray
    levels: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.cosines(stats) @ self.weights, self.points, self.levels), 0.0, 1.0)


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("__stats").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(NAMES))


def _fold_sums(rows: DataFrame, cosines: Cosines) -> np.ndarray:
    """For each fold the products of features and label with each other, added up over all rows.

    A task gives one line per fold and feature; lines of one place meet in one task and are added
    in the order of their parts.
    """
    width = len(cosines.phases) + 2

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, width, width))
        first = None
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                first = part.column("__part")[0].as_py() if first is None else first
                z = np.column_stack([cosines(_stats_of(part)), part.column("__label").to_numpy().astype(float)])
                fold = part.column("__fold").to_numpy()
                for k in range(FOLDS):
                    own = z[fold == k]
                    sums[k] += own.T @ own
        if first is None:
            return
        lines = sums.reshape(FOLDS * width, width)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(lines), dtype=np.int32)),
                pa.array(np.full(len(lines), first, np.int64)),
                pa.array(list(lines), pa.list_(pa.float64())),
            ],
            ["place", "part", "line"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            lines = batch.column("line").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for place, line in zip(batch.column("place").to_pylist(), lines):
                total[place] = total[place] + line if place in total else line
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))],
            ["place", "line"],
        )

    found = (
        rows.mapInArrow(partial, "place int, part long, line array<double>")
        .repartition(16, "place")
        .sortWithinPartitions("place", "part")
        .mapInArrow(add, "place int, line array<double>")
        .toArrow()  # FOLDS x (FEATURES + 2) lines
    )
    sums = np.zeros((FOLDS * width, width))
    if found.num_rows:
        sums[found.column("place").to_numpy()] = np.stack(found.column("line").to_pylist())
    return sums.reshape(FOLDS, width, width)


def _solve(sums: np.ndarray, penalty: float) -> np.ndarray:
    """Ridge weights from summed products; the constant is not penalised."""
    a, b = sums[:-1, :-1], sums[:-1, -1]
    ridge = np.full(len(b), penalty * sums[-2, -2])
    ridge[-1] = 0.0
    return np.linalg.solve(a + np.diag(ridge) + 1e-9 * np.eye(len(b)), b)


def _error(sums: np.ndarray, weights: np.ndarray) -> float:
    a, b, yy = sums[:-1, :-1], sums[:-1, -1], sums[-1, -1]
    return float(yy - 2 * weights @ b + weights @ a @ weights)


def isotonic(values: np.ndarray, counts: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points and never falling levels: neighbours whose shares fall are pooled. ``values`` ascend."""
    pools: list[list[float]] = []  # first, last, count, hits
    for value, count, hit in zip(values, counts, hits):
        pools.append([value, value, count, hit])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            _, last, count, hit = pools.pop()
            pools[-1][1] = last
            pools[-1][2] += count
            pools[-1][3] += hit
    points = [p for pool in pools for p in (pool[0], pool[1])]
    levels = [pool[3] / pool[2] for pool in pools for _ in range(2)]
    return np.array(points), np.array(levels)


def fit(
    stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
    features: int = FEATURES, seed: int = SEED,
) -> Model:
    """Fit on all labelled rows outside the held-out fold of a stored ``document_statistics``."""
    each = [F.col("__stats")[i] for i in range(len(NAMES))]
    facts = stats.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(each)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(each)],
    ).first()
    centre = np.array([facts[f"m{i}"] or 0.0 for i in range(len(NAMES))])
    scale = np.array([facts[f"s{i}"] or 0.0 for i in range(len(NAMES))])
    draw = np.random.default_rng(seed)
    cosines = Cosines(
        centre,
        np.where(scale > 1e-9, scale, 1.0),
        draw.normal(0, 1 / (WIDTH * np.sqrt(len(NAMES))), (len(NAMES), features)),
        draw.uniform(0, 2 * np.pi, features),
    )
    marked = (
        labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
        .filter(~held_out(F.col("__id")) & F.col("__label").isNotNull())
        .groupBy("__id").agg(F.greatest(F.lit(0), F.least(F.lit(1), F.max("__label"))).alias("__label"))
    )
    fold = F.floor(F.crc32(F.col("__id").cast("string").cast("binary")) / HELD_OUT_OF) % FOLDS
    rows, n = counted(
        stats.filter(~held_out(F.col("__id"))).select("__id", "__stats").join(marked, "__id")
        .select("__stats", "__label", fold.cast("int").alias("__fold"),
                F.spark_partition_id().cast("long").alias("__part"))
    )
    none = np.zeros(0)
    if not n:
        return Model(cosines, none, none, none)
    rows = rows.coalesce(max(1, -(-n // TASK_ROWS)) if n > TASK_ROWS else 8)
    sums = _fold_sums(rows, cosines)
    whole = sums.sum(axis=0)
    best, left_out = None, None
    for penalty in PENALTIES:
        others = [_solve(whole - s, penalty) if (whole - s)[-2, -2] > 0 else None for s in sums]
        error = sum(_error(s, w) for s, w in zip(sums, others) if w is not None)
        if best is None or error < best[0]:
            best, left_out = (error, penalty), others
    weights = _solve(whole, best[1])
    left_out = np.array([weights if w is None else w for w in left_out])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = cosines(_stats_of(batch))
            value = (z * left_out[batch.column("__fold").to_numpy()]).sum(axis=1)
            step = np.clip(np.rint((value - LOW) / (HIGH - LOW) * GRID), 0, GRID).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column("__label")], ["step", "label"])

    steps = (
        rows.mapInArrow(raw, "step int, label int").groupBy("step")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits")).orderBy("step")
        .toArrow()  # at most GRID + 1 rows
    )
    at, count, hits = (steps.column(c).to_numpy().astype(float) for c in ("step", "n", "hits"))
    points, levels = isotonic(LOW + at / GRID * (HIGH - LOW), count, hits)
    return Model(cosines, weights, points, levels)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` with ``__score`` in place of ``__stats``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)  # below 1 MB, fixed by FEATURES and GRID
    kept = [c for c in stats.columns if c != "__stats"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.scores(_stats_of(batch))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(found)], [*kept, "__score"]
            )

    return stats.mapInArrow(run, stats.select(*kept).schema.add("__score", "double"))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", carry: Sequence[str] = (),
) -> DataFrame:
    """(__id, carried columns, __score) of every row: texts are read once, the rest is narrow."""
    stats = stored(document_statistics(docs, id_col, text_col, carry))
    return score(stats, fit(stats, labels, id_col, label_col))
