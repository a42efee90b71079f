"""Inputs derived from the test tables: raw pixels, cells, layers, paths and benchmarks.

The values are formulas over table columns, chosen so that every rule has rows to act on
(sentinels, zero and positive depths, depths over the cap, mismatched shapes, missing files).
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthgrid.functions.values import zero_fill
from depthgrid.operators.align import derive_aspect, mask_baseline
from depthgrid.operators.settle import attach, settle
from depthgrid.schema import PAIR, PERIOD_LAYERS, SHARED_LAYERS
from depthgrid.sources.folders import write_raster

SENTINEL = -9999.0
KEYS = ("pixel_id",)
RAW_VALUES = (*PERIOD_LAYERS, *SHARED_LAYERS)

_PIXEL_ID = """concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string),
  cast(l_partkey as string), cast(l_suppkey as string))"""
_OWP = "case when l_tax >= 0.075D then -9999.0D else l_quantity / 10.0D end"
_FLOOD = """case when l_discount <= 0.025D then -9999.0D when l_discount <= 0.055D then 0.0D
  else l_quantity * (1.0D + l_discount) / 2.0D end"""
_SHARED = {
    "aspect": "case when l_orderkey % 37 = 0 then -9999.0D else cast(l_orderkey % 360 as double) end",
    "curvature": "cast(l_partkey % 21 as double) - 10.0D",
    "dem": "l_extendedprice / 100.0D",
    "lulc": "cast(l_linenumber as double)",
    "rem": "case when l_suppkey % 11 = 0 then -9999.0D else cast(l_suppkey % 50 as double) end",
    "slope": "cast(cast(l_quantity as int) % 45 as double)",
}
_PREDICTED = """greatest(0.0D, (l_discount - 0.04D) * l_quantity * 8.0D
  + cast(l_partkey % 11 - 5 as double) / 10.0D + l_extendedprice / 1000000.0D)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_pixels(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Wide pixels with sentinels still in place, and a formula prediction."""
    values = {"owp_hand_fim": _OWP, "flood_depth": _FLOOD, **_SHARED, "predicted": _PREDICTED}
    lines = lines if lines is not None else table(spark, sf_dir, "lineitem")
    return lines.selectExpr(
        "concat('HUC_', l_returnflag) as huc8",
        "l_linestatus as return_period",
        f"{_PIXEL_ID} as pixel_id",
        *[f"{expression} as {name}" for name, expression in values.items()],
    )


def clean_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked, zero-filled, imputed and derived: the wide counterpart of the pixel table."""
    raw = raw_pixels(spark, sf_dir, table(spark, sf_dir, "lineitem"))
    sentinel = F.lit(SENTINEL)
    valid = {c: F.when(F.col(c) != SENTINEL, F.col(c)) for c in SHARED_LAYERS}
    means = settle(raw.groupBy(*PAIR).agg(*[F.avg(v).alias(f"mean_{c}") for c, v in valid.items()]))
    imputed = attach(raw, means, PAIR).withColumns(
        {c: F.coalesce(v, F.col(f"mean_{c}")) for c, v in valid.items()}
    )
    masked = mask_baseline(imputed, sentinel).withColumn(
        "flood_depth", zero_fill(F.col("flood_depth"), sentinel)
    )
    return derive_aspect(masked.drop(*[f"mean_{c}" for c in SHARED_LAYERS])).na.drop()


def depth_pixels(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Masked and zero-filled rows of the few columns most reports need."""
    sentinel = F.lit(SENTINEL)
    narrow = raw_pixels(spark, sf_dir, lines).select(
        *PAIR, "pixel_id", "owp_hand_fim", "flood_depth", "predicted"
    )
    return mask_baseline(narrow, sentinel).withColumn(
        "flood_depth", zero_fill(F.col("flood_depth"), sentinel)
    )


_SECOND_PERIOD = {
    "owp_hand_fim": "case when l_tax >= 0.065D then -9999.0D else l_quantity / 8.0D end",
    "flood_depth": "case when l_discount <= 0.035D then -9999.0D else l_quantity * (1.0D + l_discount) end",
}


def raster_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long cells: every line item is a pixel with six shared layers and two periods of own layers.

    Shared layers and periods are separate branches, as they are separate folders of a stored
    cell table, so a filter on the period skips the others.
    """
    lines = table(spark, sf_dir, "lineitem")

    def branch(period: str | None, layers: dict[str, str]) -> DataFrame:
        cells = ", ".join(f"named_struct('layer', '{n}', 'value', cast({e} as float))" for n, e in layers.items())
        return lines.select(
            F.expr("concat('HUC_', l_returnflag)").alias("huc8"),
            F.expr(_PIXEL_ID).alias("pixel_id"),
            F.lit(period).cast("string").alias("return_period"),
            F.expr(f"inline(array({cells}))"),
        )

    first = {"owp_hand_fim": _OWP, "flood_depth": _FLOOD}
    return (
        branch(None, _SHARED)
        .unionByName(branch("10yr", first))
        .unionByName(branch("50yr", _SECOND_PERIOD))
    )


def raster_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer table of ``raster_cells``: one shape, the sentinel everywhere."""
    watersheds = table(spark, sf_dir, "lineitem").selectExpr("concat('HUC_', l_returnflag) as huc8").distinct()
    own = [(period, layer) for period in ("10yr", "50yr") for layer in PERIOD_LAYERS]
    entries = own + [(None, layer) for layer in SHARED_LAYERS]
    return watersheds.select(
        "huc8",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(period).cast("string").alias("return_period"), F.lit(layer).alias("layer"))
                    for period, layer in entries
                ]
            )
        ),
        F.lit(100).alias("n_rows"),
        F.lit(100).alias("n_cols"),
        F.lit(SENTINEL).alias("nodata"),
    )


def order_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer table with one watershed per customer and one period per order.

    Some depth rasters have another shape, some watersheds one odd or one absent shared layer.
    """
    orders = table(spark, sf_dir, "orders")
    keyed = orders.selectExpr(
        "concat('H', cast(o_custkey as string)) as huc8",
        "concat(cast(o_orderkey as string), 'yr') as return_period",
        "o_orderkey", "o_custkey", "cast(100 + o_custkey % 7 as int) as n",
    )
    own = keyed.selectExpr(
        "huc8", "return_period",
        """inline(array(named_struct('l', 'owp_hand_fim', 'r', n, 'c', n + 1),
          named_struct('l', 'flood_depth', 'r', cast(case when o_orderkey % 11 = 0 then n + 5 else n end as int), 'c', n + 1)))""",
    ).toDF("huc8", "return_period", "layer", "n_rows", "n_cols")
    shared = (
        keyed.select("huc8", "o_custkey", "n").distinct()
        .selectExpr(
            "huc8", "cast(null as string) as return_period", "o_custkey", "n",
            f"explode(array({', '.join(repr(n) for n in SHARED_LAYERS)})) as layer",
        )
        .filter("not (o_custkey % 17 = 0 and layer = 'rem')")
        .selectExpr(
            "huc8", "return_period", "layer",
            "cast(case when o_custkey % 13 = 0 and layer = 'dem' then n + 2 else n end as int) as n_rows",
            "n + 1 as n_cols",
        )
    )
    return own.unionByName(shared).withColumn("nodata", F.lit(SENTINEL))


def order_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raster file paths, one watershed per customer and one baseline raster per order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('H', cast(o_custkey as string)) as h",
        "concat(cast(o_orderkey as string), 'yr') as p",
        "o_orderkey as k", "o_custkey as c",
    ).selectExpr(
        """explode(filter(array(
          concat('data/', h, '/owp_hand_fim/', p,
            case k % 3 when 0 then concat('_', h, '_depth.tif') when 1 then '.tif' else '.txt' end),
          case when c % 7 <> 0 and k % 5 in (0, 3) then concat('data/', h, '/flood_depth/fim_', p, '_m_final.tif') end,
          case when c % 7 <> 0 and k % 5 in (1, 3) then concat('data/', h, '/flood_depth/', p, '_', h, '_depth.tif') end,
          case when c % 7 <> 0 and k % 5 = 2 then concat('data/', h, '/flood_depth/fim_', p, '.tif') end
        ), x -> x is not null)) as path"""
    )


def test_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        """concat('out/H', cast(o_custkey as string), '/', cast(o_orderkey as string), 'yr',
          case when o_orderkey % 6 = 0 then '.log' else '_test.pkl' end) as path"""
    )


def benchmark_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One benchmark folder per order; some have the undated slope file, some lack one layer."""
    dated = ", ".join(
        f"concat('{layer}_', d, '.tif')" for layer in ("flood_depth", "aspect", "curvature", "dem", "lulc")
    )
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k", "concat('d', cast(o_orderkey as string)) as d"
    ).selectExpr(
        f"""explode(filter(transform(array(concat('owp_hand_fim', d, '.tif'), {dated},
          case when k % 9 <> 0 then concat('rem_', d, '.tif') end,
          case when k % 4 <> 1 then concat('slope_', d, '.tif') end,
          case when k % 4 in (1, 2) then 'slope.tif' end),
          x -> concat('bench/', d, '/', x)), x -> x is not null)) as path"""
    )


def noisy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values with planted NaN, infinities and unreadable text."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type",
        """case when event_id % 19 = 0 then double('NaN') when event_id % 23 = 0 then double('Infinity')
          when event_id % 29 = 0 then double('-Infinity') else value / 10.0D end as depth""",
        "case when event_id % 17 = 0 then 'n/a' when event_id % 13 = 0 then null else cast(value as string) end as text_depth",
    )


def benchmark_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark rows keyed by event type: truth, baseline and prediction, some not finite."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_type as benchmark", "event_id",
        "case when event_id % 41 = 0 then double('NaN') else value / 10.0D end as flood_depth",
        "value / 12.0D + cast(event_id % 7 as double) / 10.0D as owp_hand_fim",
        """case when event_id % 43 = 0 then double('Infinity')
          else value / 10.0D + cast(event_id % 5 - 2 as double) / 8.0D end as predicted""",
    )


def event_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark rows in the columns of a pixel table without prediction."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('EVT_', event_type) as huc8", "'live' as return_period",
        "cast(event_id as string) as pixel_id", "value / 12.0D as owp_hand_fim", "value / 10.0D as flood_depth",
    )


#: Names of the stored rasters' files by period: baseline and depth. The depths of "5yr" are absent.
RASTER_NAMES = {
    "10yr": ("10yr_{huc8}_depth.tif", "fim_10yr_m_final.tif"),
    "50yr": ("50yr.tif", "50yr_{huc8}_depth.tif"),
}


def write_rasters(spark: SparkSession, sf_dir: str, root: str) -> None:
    """``raster_cells`` as a folder of rasters, with rasters that discovery has to pass over."""
    lines = table(spark, sf_dir, "lineitem")
    own_layers = {"10yr": {"owp_hand_fim": _OWP, "flood_depth": _FLOOD}, "50yr": _SECOND_PERIOD}
    jobs = []
    # Each raster reads its own columns of its own watershed's lines.
    for flag in [row["l_returnflag"] for row in lines.select("l_returnflag").distinct().collect()]:
        huc8 = None if flag is None else f"HUC_{flag}"
        own = lines.filter(F.col("l_returnflag") == F.lit(flag))
        for layer, value in _SHARED.items():
            jobs.append((own, value, f"{huc8}/{layer}.tif"))
        for period, names in RASTER_NAMES.items():
            for layer, name in zip(PERIOD_LAYERS, names):
                jobs.append((own, own_layers[period][layer], f"{huc8}/{layer}/{name.format(huc8=huc8)}"))
        # A depth raster of lesser name than the one above, and a baseline without any.
        jobs.append((own, "1e6D", f"{huc8}/flood_depth/fim_10yr.tif"))
        jobs.append((own, _OWP, f"{huc8}/owp_hand_fim/5yr.tif"))

    def write(job: tuple) -> None:
        rows, value, place = job
        cells = rows.selectExpr(
            f"{_PIXEL_ID} as pixel_id", f"cast({value} as float) as value",
            "100 as n_rows", "100 as n_cols", f"{SENTINEL}D as nodata",
        )
        write_raster(cells, f"{root}/{place}")

    with ThreadPool(8) as pool:
        pool.map(inheritable_thread_target(spark)(write), jobs, 1)
