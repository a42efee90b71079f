"""Mix sources to target weights: repetition rates per source, then whole copies per document.

Targets: sources in code-point order (null last) weigh ``weights``, repeating, and share the
size of the whole corpus; a target stops at ``ceiling`` times its source's size and the excess
goes to the others by weight until none is above. Each document is then emitted floor(rate)
times, plus once more with probability equal to the fraction, drawn from a hash of seed and id.

Defined cases: a null text has size 0; a null source is a source of its own; a source of size 0
has target 0; rows repeated with one id draw alike; a null id draws as the empty string; a very long
text counts with all its words; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthgrid.llm.shared import BROADCAST_ROWS, stored

WEIGHTS = (5, 2, 1)
CEILING = 3
SEED = "mix-1"


def words_in(text: Column) -> Column:
    """Number of runs of bytes other than space and 0x09-0x0D."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def uniform(seed: str, key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of md5("seed:key"), the same on every run."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _ranked(sources: DataFrame) -> DataFrame:
    """Add __rank, the place by code point, without sorting all sources in one task.

    The stored sort gives each row its partition and place in it; partitions then get offsets.
    """
    placed = stored(
        sources.orderBy(F.col("__source").asc_nulls_last()).withColumn(
            "__at", F.monotonically_increasing_id()
        )
    )
    part = F.shiftright("__at", 33)
    counts = {
        r["__part"]: r["n"]
        for r in placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")).collect()
    }  # one number per partition
    offsets, total = [], 0
    for p in sorted(counts):
        offsets.append((int(p), total))
        total += counts[p]
    if not offsets:
        return placed.withColumn("__rank", F.lit(0).cast("long"))
    table = placed.sparkSession.createDataFrame(offsets, "__part long, __offset long")
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(table), "__part")
        .withColumn("__rank", F.col("__offset") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: float = CEILING
) -> DataFrame:
    """(__source, __total, __target) from rows (__source, __size)."""
    totals = stored(sizes.groupBy("__source").agg(F.sum("__size").alias("__total")))
    choice = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("__rank") % len(weights) + 1).cast("int"),
    )
    table = stored(
        _ranked(totals).select(
            "__source", "__total", choice.alias("__weight"),
            (F.col("__total") * F.lit(float(ceiling))).alias("__cap"),
        )
    )
    # The share per unit of weight rises as sources reach their caps; it is settled when a pass
    # finds no further source above its cap. Each pass is one aggregate of a few numbers.
    level, capped = 0.0, -1
    whole = float(table.agg(F.sum("__total")).first()[0] or 0)
    while True:
        over = F.col("__weight") * F.lit(level) >= F.col("__cap")
        seen = table.agg(
            F.count_if(over).alias("n"),
            F.sum(F.when(over, F.col("__cap"))).alias("cap"),
            F.sum(F.when(~over, F.col("__weight"))).alias("weight"),
        ).first()
        if seen["n"] == capped or not seen["weight"]:
            break
        capped, level = seen["n"], (whole - (seen["cap"] or 0.0)) / seen["weight"]
    return table.select(
        "__source", "__total",
        F.least("__cap", F.col("__weight") * F.lit(level)).alias("__target"),
    )


def _with_copies(rows: DataFrame, targets: DataFrame, id_col: str, source_col: str, seed: str):
    """Rows with __total, __target and __copies; the targets are broadcast if they are few."""
    right = targets.withColumnRenamed("__source", "__of")
    if targets.count() <= BROADCAST_ROWS:
        right = F.broadcast(right)
    rate = F.when(F.col("__total") > 0, F.col("__target") / F.col("__total")).otherwise(0.0)
    extra = uniform(seed, F.col(id_col)) < rate - F.floor(rate)
    return (
        rows.join(right, F.col(source_col).eqNullSafe(F.col("__of")))
        .withColumn("__copies", (F.floor(rate) + extra.cast("long")).cast("long"))
        .drop("__of")
    )


def plan_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, ceiling: float = CEILING, seed: str = SEED,
) -> DataFrame:
    """One row per document: ``id_col``, size, source_size, target, copies."""
    rows = stored(
        docs.select(
            F.col(id_col).alias("__id"),
            F.col(source_col).alias("__source"),
            words_in(F.col(text_col)).alias("__size"),
        )
    )
    targets = stored(source_targets(rows, weights, ceiling))
    return _with_copies(rows, targets, "__id", "__source", seed).select(
        F.col("__id").alias(id_col),
        F.col("__size").alias("size"),
        F.col("__total").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__copies").alias("copies"),
    )


def emit_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, ceiling: float = CEILING, seed: str = SEED,
) -> DataFrame:
    """The mixed corpus: every row as often as planned, with its copy number from 1.

    The number's column is ``copy``, or ``copy_`` with more underscores if that name is taken.
    Texts are read twice and not shuffled while the sources are few enough to broadcast.
    """
    sizes = docs.select(
        F.col(source_col).alias("__source"), words_in(F.col(text_col)).alias("__size")
    )
    targets = stored(source_targets(sizes, weights, ceiling))
    number = "copy"
    while number in docs.columns:
        number += "_"
    planned = _with_copies(docs, targets, id_col, source_col, seed).filter("__copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), "__copies")).alias(number)
    return planned.select(*[F.col(f"`{c}`") for c in docs.columns], copies)
