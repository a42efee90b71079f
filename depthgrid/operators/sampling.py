"""Exact-count, repeatable sampling: class balance, splits, fraction samples, shuffles.

A row's place in its group is the md5 of seed, purpose and row key, so a draw depends neither on
the partitioning nor on the order of rows, and draws for different purposes are independent of
each other: what balancing kept says nothing about what a split then takes. Taking exactly ``n`` of a group means finding the
n-th smallest digest. That is done by narrowing a digest prefix from counts per prefix
(map-side combined, at most 4,096 per group and step) until the prefix that holds the n-th
row is small; only those few rows are ranked. No group is ever sorted whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthgrid.operators.settle import Settled, attach, settle
from depthgrid.schema import PAIR, SEED, TARGET

PREFIX_STEP = 3
RANK_LIMIT = 200_000
_EVERYTHING = "~"  # sorts after every hex digit


def digest(keys: Sequence[str], purpose: str, seed: int = SEED) -> Column:
    label = F.lit(f"{seed}:{purpose}")
    return F.md5(F.concat_ws(":", label, *[F.col(k).cast("string") for k in keys]))


def _cut_prefix(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Per group, the prefix that holds the ``need``-th row, and the rank left inside it."""
    order = Window.partitionBy(*groups).orderBy("prefix")
    upto = F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        counts.withColumn("upto", upto)
        .filter((F.col("need") > F.col("upto") - F.col("count")) & (F.col("need") <= F.col("upto")))
        .select(
            *groups,
            F.col("prefix").alias("_cut"),
            (F.col("need") - (F.col("upto") - F.col("count"))).alias("need"),
            F.col("count").alias("size"),
        )
    )


def exact_n(
    rows: DataFrame,
    groups: Sequence[str],
    quota: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    purpose: str,
    seed: int = SEED,
    rank_limit: int = RANK_LIMIT,
) -> DataFrame:
    """Flag exactly ``take`` rows of each group as ``picked``.

    ``quota`` maps a table ``(*groups, total)`` to ``(*groups, total, take)``; rows of groups
    it leaves out are dropped. ``keys`` must identify a row; where a draw's last place is held by
    two rows of one key, which cannot be told apart, the job fails. ``rows`` is scanned three times
    (more only for groups over ``4096 * rank_limit`` rows), so settle an expensive input.
    """
    group_cols = list(groups) or ["_all"]
    keyed = rows if groups else rows.withColumn("_all", F.lit(0))
    keyed = keyed.withColumn("_digest", digest(keys, purpose, seed))

    def prefix(length: int) -> Column:
        return F.substring("_digest", 1, length)

    # Settled, since both the totals and the cut read it: the rows are counted once.
    counts = settle(keyed.groupBy(*group_cols, prefix(PREFIX_STEP).alias("prefix")).count())
    totals = counts.table.groupBy(*group_cols).agg(F.sum("count").alias("total"))
    wanted = quota(totals).select(
        *group_cols, F.col("total").cast("long"), F.col("take").cast("long").alias("need")
    )
    partial = counts.table.join(wanted.filter("need > 0 and need < total").drop("total"), group_cols)
    # A group taken whole or not at all needs no cut.
    edges = (
        wanted.withColumnRenamed("need", "take")
        .join(_cut_prefix(partial, group_cols), group_cols, "left")
        .select(
            *group_cols,
            F.coalesce("_cut", F.when(F.col("take") <= 0, "").otherwise(_EVERYTHING)).alias("_cut"),
            F.coalesce("need", F.lit(0)).alias("need"),
            F.coalesce("size", F.lit(0)).alias("size"),
        )
    )
    bounds = settle(edges, peak=F.max("size"))
    length = PREFIX_STEP
    while (bounds.measures["peak"] or 0) > rank_limit and length + PREFIX_STEP <= 32:
        bounds = _narrow(keyed, bounds, group_cols, prefix, length)
        length += PREFIX_STEP

    # The n-th row itself, found among the rows that share the cut prefix.
    here = attach(
        keyed.select(*group_cols, "_digest", *_renamed(keys)), bounds, group_cols
    ).filter((F.col("need") > 0) & (F.col("_cut") == prefix(length)))
    in_order = Window.partitionBy(*group_cols, "_cut").orderBy("_digest", *_key_names(keys))
    nth = (
        here.withColumn("rank", F.row_number().over(in_order))
        .withColumn("_place", F.struct("_digest", *_key_names(keys)))
        .withColumn("_next", F.lead("_place").over(in_order))
        .filter("rank = need")
        .select(*group_cols, _single(F.col("_place"), F.col("_next")).alias("_last"))
    )
    ends = bounds.table.join(nth, group_cols, "left").select(*group_cols, "_cut", "_last")
    place = F.struct("_digest", *[F.col(k).alias(n) for k, n in zip(keys, _key_names(keys))])
    if not groups:
        return keyed.withColumn("picked", _picked(place, *_as_literals(ends))).select(
            *rows.columns, "picked"
        )
    # One row per group at most, so a bounded number of groups may stay part of the final plan.
    last = Settled(ends, bounds.rows, bounds.path, bounds.width) if bounds.broadcastable else settle(ends)
    flagged = attach(keyed, last, group_cols)
    return flagged.withColumn("picked", _picked(place, F.col("_cut"), F.col("_last"))).select(
        *rows.columns, "picked"
    )


def _single(place: Column, following: Column) -> Column:
    repeated = F.raise_error(F.lit("the keys of an exact draw do not identify its rows"))
    return F.when(place.eqNullSafe(following), repeated.cast("void")).otherwise(place)


def _picked(place: Column, cut: Column, last: Column) -> Column:
    return F.when(last.isNull(), F.col("_digest") < cut).otherwise(place <= last)


def _as_literals(ends: DataFrame) -> tuple[Column, Column]:
    """The single edge of an ungrouped draw as constants, so that the draw is a plain filter."""
    edge = ends.first()
    kind = ends.schema["_last"].dataType
    if edge is None:  # no rows at all
        return F.lit(""), F.lit(None).cast(kind)
    if edge["_last"] is None:
        return F.lit(edge["_cut"]), F.lit(None).cast(kind)
    parts = [F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(edge["_last"], kind)]
    return F.lit(edge["_cut"]), F.struct(*parts)


def _key_names(keys: Sequence[str]) -> list[str]:
    return [f"_key{i}" for i in range(len(keys))]


def _renamed(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(n) for k, n in zip(keys, _key_names(keys))]


def _narrow(keyed, bounds: Settled, groups: list[str], prefix, length: int) -> Settled:
    """One more step of ``PREFIX_STEP`` digits inside every cut prefix."""
    inside = attach(keyed.select(*groups, "_digest"), bounds, groups).filter(
        (F.col("need") > 0) & (F.col("_cut") == prefix(length))
    )
    counts = inside.groupBy(
        *groups, "need", prefix(length + PREFIX_STEP).alias("prefix")
    ).count()
    finer = _cut_prefix(counts, groups)
    whole = bounds.table.filter("need = 0")
    return settle(finer.unionByName(whole), peak=F.max("size"))


# ---------------------------------------------------------------- quotas


def depth_class(target: str = TARGET) -> Column:
    depth = F.col(target)
    return (
        F.when(depth == 0, F.lit("zero"))
        .when((depth > 0) & ~F.isnan(depth), F.lit("nonzero"))
        .otherwise(F.lit("negative"))
    )


def balance_quota(pair: Sequence[str] = PAIR) -> Callable[[DataFrame], DataFrame]:
    """Zeros and nonzeros to the smaller count; a pair with one class only stays whole."""

    def quota(totals: DataFrame) -> DataFrame:
        whole_pair = Window.partitionBy(*pair)

        def size(name: str) -> Column:
            return F.coalesce(
                F.max(F.when(F.col("depth_class") == name, F.col("total"))).over(whole_pair),
                F.lit(0),
            )

        smaller = F.least("_zeros", "_nonzeros")
        return (
            totals.withColumn("_zeros", size("zero"))
            .withColumn("_nonzeros", size("nonzero"))
            .withColumn(
                "take",
                F.when(smaller == 0, F.col("total"))
                .when(F.col("depth_class") == "negative", F.lit(0))
                .otherwise(smaller),
            )
            .drop("_zeros", "_nonzeros")
        )

    return quota


def balance_classes(
    rows: DataFrame,
    keys: Sequence[str],
    pair: Sequence[str] = PAIR,
    target: str = TARGET,
    seed: int = SEED,
) -> DataFrame:
    """One zero-depth row for each nonzero row in every pair that has both."""
    classed = rows.withColumn("depth_class", depth_class(target))
    chosen = exact_n(classed, [*pair, "depth_class"], balance_quota(pair), keys, "balance", seed)
    return chosen.filter("picked").drop("picked", "depth_class")


def random_split(
    rows: DataFrame, keys: Sequence[str], fraction: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Column ``split``: exactly ``ceil(fraction * n)`` rows are 'validation', the rest 'train'."""

    def quota(totals: DataFrame) -> DataFrame:
        return totals.withColumn("take", F.ceil(F.lit(fraction) * F.col("total")))

    flagged = exact_n(rows, [], quota, keys, "validation", seed)
    return flagged.withColumn("split", F.when(F.col("picked"), "validation").otherwise("train")).drop(
        "picked"
    )


def fraction_sample(
    rows: DataFrame,
    keys: Sequence[str],
    fraction: float = 0.1,
    groups: Sequence[str] = ("split",),
    seed: int = SEED,
) -> DataFrame:
    """Exactly ``rint(fraction * n)`` rows of every group."""

    def quota(totals: DataFrame) -> DataFrame:
        return totals.withColumn("take", F.rint(F.lit(fraction) * F.col("total")))

    return exact_n(rows, groups, quota, keys, "sample", seed).filter("picked").drop("picked")


def shuffle_rows(
    rows: DataFrame, keys: Sequence[str], partitions: int | None = None, seed: int = SEED
) -> DataFrame:
    """Rows in digest order inside partitions filled by digest: a shuffle without a global sort.

    The digest itself, longer than most rows' values, is made on both sides and not shuffled.
    """
    place = digest(keys, "shuffle", seed)
    mixed = rows.repartition(partitions, place) if partitions else rows.repartition(place)
    return mixed.sortWithinPartitions(place)
