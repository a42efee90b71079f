"""From layer cells to one feature row per pixel: shape check, imputation, alignment, masks.

Order matters and is kept: shared layers are imputed with the mean of the whole layer,
before the baseline mask removes pixels; then sine and cosine; then incomplete rows drop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthgrid.functions.values import (
    cosine_of_degrees,
    is_nodata,
    nodata_as_null,
    sine_of_degrees,
    zero_fill,
)
from depthgrid.operators.settle import Settled, attach, settle
from depthgrid.schema import (
    BASELINE,
    FEATURES,
    PAIR,
    PERIOD_LAYERS,
    PIXEL,
    SHARED_LAYERS,
    TARGET,
)


def shape_check(layers: DataFrame) -> DataFrame:
    """Pairs whose two own layers and six shared layers all exist with one common shape.

    Works on the layer table only, so mismatching pairs are gone before any cell is read.
    """
    shape = F.struct("n_rows", "n_cols")

    def extent(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.count_distinct("layer").alias("_layers"),
            F.min(shape).alias("_least"),
            F.max(shape).alias("_most"),
        )

    own = layers.filter(F.col("layer").isin(*PERIOD_LAYERS) & F.col("return_period").isNotNull())
    shared = layers.filter(F.col("layer").isin(*SHARED_LAYERS) & F.col("return_period").isNull())

    def uniform(rows: DataFrame, count: int) -> DataFrame:
        return rows.filter((F.col("_layers") == count) & (F.col("_least") == F.col("_most")))

    pairs = uniform(extent(own, PAIR), len(PERIOD_LAYERS)).select(*PAIR, "_least")
    common = uniform(extent(shared, ["huc8"]), len(SHARED_LAYERS)).select("huc8", "_least")
    return pairs.join(common, ["huc8", "_least"], "left_semi").select(*PAIR)


def layer_facts(
    cells: DataFrame, nodata: Settled, keys: Sequence[str] = ("huc8",)
) -> Settled:
    """Sentinel and mean of every shared layer, the mean over all of its valid cells."""
    valid = nodata_as_null(F.col("value"), F.col("nodata")).cast("double")
    with_sentinel = attach(cells, nodata, [*keys, "layer"])
    return settle(
        with_sentinel.groupBy(*keys, "layer").agg(
            F.max("nodata").alias("nodata"), F.avg(valid).alias("mean")
        )
    )


def impute_mean(
    cells: DataFrame, facts: Settled, keys: Sequence[str] = ("huc8",)
) -> DataFrame:
    """Sentinel and NaN cells take their layer's mean. A layer without any value stays missing."""
    valid = nodata_as_null(F.col("value"), F.col("nodata")).cast("double")
    return (
        attach(cells, facts, [*keys, "layer"])
        .withColumn("value", F.coalesce(valid, F.col("mean")))
        .drop("nodata", "mean")
    )


def _place_of(layers: Sequence[str]) -> Column:
    """A layer's place in a fixed list as one byte, which is shuffled instead of its name."""
    return F.coalesce(*[F.when(F.col("layer") == name, F.lit(n)) for n, name in enumerate(layers)]).cast("byte")


def _wide(cells: DataFrame, keys: Sequence[str], layers: Sequence[str]) -> DataFrame:
    """One row per key and one column per layer, from a fixed layer list; ``layer`` is a place in it.

    Two cells of one pixel and layer cannot both be right, so the job fails on them.
    """
    wide = cells.groupBy(*keys).agg(
        *[F.max(F.when(F.col("layer") == n, F.col("value"))).alias(name) for n, name in enumerate(layers)],
        F.greatest(*[F.count_if(F.col("layer") == n) for n in range(len(layers))]).alias("_most"),
    )
    repeated = F.raise_error(F.lit("a pixel has two cells in one layer")).cast("boolean")
    return wide.filter(F.when(F.col("_most") > 1, repeated).otherwise(F.lit(True))).drop("_most")


def align_pixels(
    own: DataFrame,
    shared: DataFrame,
    pixel: Sequence[str] = PIXEL,
    bucketed: bool = False,
) -> DataFrame:
    """Join the period layers with the shared layers of the same watershed by pixel.

    Both sides are partitioned once by (huc8, pixel); the two aggregations and the join all
    reuse that partitioning, so every cell crosses the network once and the shared layers
    are shuffled once for all periods. The keys are single pixels, so no key is hot. Cells of a
    ``bucketed`` table are partitioned that way where they lie and are not moved at all.
    """
    place = ["huc8", *pixel]
    own_cells = own.select(*place, "return_period", _place_of(PERIOD_LAYERS).alias("layer"), "value")
    shared_cells = shared.select(*place, _place_of(SHARED_LAYERS).alias("layer"), "value")
    if not bucketed:
        own_cells, shared_cells = own_cells.repartition(*place), shared_cells.repartition(*place)
    return _wide(own_cells, [*place, "return_period"], PERIOD_LAYERS).join(
        _wide(shared_cells, place, SHARED_LAYERS), place
    )


def mask_baseline(rows: DataFrame, nodata: Column, column: str = BASELINE) -> DataFrame:
    """Drop pixels whose baseline estimate is the sentinel."""
    return rows.filter(~is_nodata(F.col(column), nodata))


def derive_aspect(rows: DataFrame, column: str = "aspect") -> DataFrame:
    """Replace the aspect angle by its sine and cosine."""
    angle = F.col(column).cast("double")
    return rows.withColumns(
        {"aspect_sin": sine_of_degrees(angle), "aspect_cos": cosine_of_degrees(angle)}
    ).drop(column)


def pixel_table(
    cells: DataFrame, layers: DataFrame, pixel: Sequence[str] = PIXEL, bucketed: bool = False
) -> DataFrame:
    """Feature rows of every valid pair, from the long cell table and its layer table.

    ``bucketed`` says that ``cells`` is a table bucketed by (huc8, pixel) and nothing else.
    """
    pairs = settle(shape_check(layers))
    sentinels = settle(layers.select(*PAIR, "layer", F.col("nodata").cast("double").alias("nodata")))
    own_nodata = Settled(
        sentinels.table.filter(F.col("return_period").isNotNull()), sentinels.rows, sentinels.path
    )
    shared_nodata = Settled(
        sentinels.table.filter(F.col("return_period").isNull()).drop("return_period"),
        sentinels.rows,
        sentinels.path,
    )
    watersheds = Settled(pairs.table.select("huc8"), pairs.rows, pairs.path)

    own = attach(
        cells.filter(F.col("layer").isin(*PERIOD_LAYERS) & F.col("return_period").isNotNull()),
        pairs,
        PAIR,
        "left_semi",
    )
    own = attach(own, own_nodata, [*PAIR, "layer"])
    # Sentinels differ per layer: flag masked pixels and fill depths while cells are still long.
    is_baseline = F.col("layer") == BASELINE
    masked = is_nodata(F.col("value"), F.col("nodata"))
    own = own.withColumn(
        "value",
        F.when(is_baseline, F.when(~masked, F.col("value"))).otherwise(
            zero_fill(F.col("value"), F.col("nodata"))
        ),
    ).drop("nodata")

    shared = attach(
        cells.filter(F.col("layer").isin(*SHARED_LAYERS) & F.col("return_period").isNull()).drop(
            "return_period"
        ),
        watersheds,
        ["huc8"],
        "left_semi",
    )
    shared = impute_mean(shared, layer_facts(shared, shared_nodata))
    aligned = align_pixels(own, shared, pixel, bucketed)
    # A masked baseline became NULL above, so dropping incomplete rows also applies the mask.
    return select_pixel_columns(derive_aspect(aligned).na.drop(), pixel)


def select_pixel_columns(rows: DataFrame, pixel: Sequence[str] = PIXEL) -> DataFrame:
    """Keys, target and features in table order, values stored as float32."""
    others = [name for name in FEATURES if name != BASELINE]
    return rows.select(
        *PAIR, *pixel, *[F.col(c).cast("float").alias(c) for c in (BASELINE, TARGET, *others)]
    )


def union_pairs(*tables: DataFrame) -> DataFrame:
    """All rows of all tables by column name; a column that a table lacks is NULL there."""
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table, allowMissingColumns=True)
    return whole
