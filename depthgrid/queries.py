"""One runnable query per operator, on inputs derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthgrid import fixtures as fx
from depthgrid.functions import values as v
from depthgrid.functions.names import file_name, parent_folder, period_of
from depthgrid.models.boosting import BoostedModel, fit_boosted
from depthgrid.models.params import SQUARED_CONFIG, TWEEDIE_CONFIG, BoostParams
from depthgrid.models.search import hyper_search
from depthgrid.operators import align, classify, density, describe, regression, sampling, strata
from depthgrid.operators.settle import settle
from depthgrid.plans import evaluate, prepare, train
from depthgrid.schema import FEATURES, PAIR, TARGET, feature_columns
from depthgrid.sources import catalog
from depthgrid.session import fresh_path
from depthgrid.sources import tables
from depthgrid.sources.tables import as_cells

Query = Callable[[SparkSession, str], DataFrame]
KEYS = fx.KEYS


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns rounded, so that engines with other summation orders compare equal."""
    return df.select(
        *[
            F.round(F.col(f.name).cast("double"), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema
        ]
    )


# ---------------------------------------------------------------- discovery and loading


def pair_discovery(spark, sf):
    return catalog.pair_discovery(fx.order_paths(spark, sf))


def period_from_name(spark, sf):
    path = F.col("path")
    return fx.order_paths(spark, sf).select(
        "path", period_of(file_name(path), parent_folder(path, 2)).alias("return_period")
    )


def flood_file_match(spark, sf):
    return catalog.flood_file_match(fx.order_paths(spark, sf))


def load_layers(spark, sf):
    cells = as_cells(fx.raster_cells(spark, sf))
    return (
        cells.groupBy(*PAIR, "layer")
        .agg(
            F.count("value").alias("cells"),
            F.count_if(v.is_nodata(F.col("value"), F.lit(fx.SENTINEL))).alias("nodata_cells"),
            F.round(F.sum(F.col("value").cast("double")), 3).alias("total"),
        )
    )


def benchmark_match(spark, sf):
    return catalog.benchmark_match(fx.benchmark_paths(spark, sf))


def path_columns(spark, sf):
    return catalog.path_columns(fx.test_paths(spark, sf))


# ---------------------------------------------------------------- row rules


def shape_check(spark, sf):
    return align.shape_check(fx.order_layers(spark, sf))


def owp_mask(spark, sf):
    rows = fx.raw_pixels(spark, sf).select(*PAIR, *KEYS, "owp_hand_fim")
    return align.mask_baseline(rows, F.lit(fx.SENTINEL))


def flood_fill_zero(spark, sf):
    return fx.raw_pixels(spark, sf).select(
        *PAIR, *KEYS, v.zero_fill(F.col(TARGET), F.lit(fx.SENTINEL)).alias(TARGET)
    )


def _shared_cells(spark, sf) -> DataFrame:
    return fx.raster_cells(spark, sf).filter("return_period is null").drop("return_period")


def layer_mean_impute(spark, sf):
    cells = _shared_cells(spark, sf)
    sentinels = settle(
        fx.raster_layers(spark, sf)
        .filter("return_period is null")
        .select("huc8", "layer", "nodata")
    )
    imputed = align.impute_mean(cells, align.layer_facts(cells, sentinels))
    return _rounded(imputed.select("huc8", "layer", *KEYS, "value"), 4)


def aspect_sincos(spark, sf):
    rows = fx.raw_pixels(spark, sf).select(*PAIR, *KEYS, "aspect")
    return _rounded(align.derive_aspect(rows))


def drop_missing(spark, sf):
    rows = fx.noisy_events(spark, sf).select(
        "event_id", "depth", v.to_number(F.col("text_depth")).alias("text_depth")
    )
    return rows.na.drop().select("event_id")


def pixel_table(spark, sf):
    rows = align.pixel_table(fx.raster_cells(spark, sf), fx.raster_layers(spark, sf), KEYS)
    return _rounded(rows, 4)


def pixel_table_bucketed(spark, sf):
    """The pixel table from cells that were stored in buckets of pixels."""
    folder = fresh_path(spark)
    name = f"cells_{folder.rsplit('/', 1)[1]}"
    cells = tables.store_bucketed(fx.raster_cells(spark, sf), name, folder, pixel=KEYS)
    return _rounded(align.pixel_table(cells, fx.raster_layers(spark, sf), KEYS, bucketed=True), 4)


def pixel_align(spark, sf):
    cells = fx.raster_cells(spark, sf)
    return _rounded(
        align.align_pixels(
            cells.filter("return_period is not null"), cells.filter("return_period is null"), KEYS
        ),
        4,
    )


def feature_projection(spark, sf):
    rows = fx.clean_pixels(spark, sf)
    return _rounded(rows.select(*feature_columns(rows)))


def coerce_target(spark, sf):
    return fx.noisy_events(spark, sf).select(
        "event_id", v.to_number(F.col("text_depth")).alias("target")
    )


def cap_target(spark, sf):
    capped = v.cap(F.col("depth"))
    return fx.noisy_events(spark, sf).select(
        "event_id", F.isnan(capped).alias("stays_nan"), v.nan_as_null(capped).alias("capped")
    )


def log_target(spark, sf):
    events = fx.table(spark, sf, "events")
    return _rounded(events.select("event_id", v.log_depth(F.col("value")).alias("log_depth")))


def unlog(spark, sf):
    events = fx.table(spark, sf, "events")
    return _rounded(events.select("event_id", v.unlog_depth(F.col("value") / 100).alias("depth")))


def nan_to_zero(spark, sf):
    return fx.noisy_events(spark, sf).select(
        "event_id", v.non_finite_to_zero(F.col("depth")).alias("depth")
    )


def nan_to_finite(spark, sf):
    return fx.noisy_events(spark, sf).select(
        "event_id", v.non_finite_to_limits(F.col("depth")).alias("depth")
    )


def depth_filter(spark, sf):
    events = fx.noisy_events(spark, sf)
    modes = {"test": 0.01, "baseline": 0.0, "minimum": 5.0}
    parts = [
        events.filter(v.deeper_than(F.col("depth"), depth)).select(F.lit(mode).alias("mode"), "event_id")
        for mode, depth in modes.items()
    ]
    return align.union_pairs(*parts)


def nan_audit(spark, sf):
    rows = fx.noisy_events(spark, sf).withColumn("text_depth", v.to_number(F.col("text_depth")))
    return describe.missing_counts(rows, ["depth", "text_depth"])


# ---------------------------------------------------------------- sampling


def _depths(spark, sf) -> DataFrame:
    rows = fx.depth_pixels(spark, sf, fx.table(spark, sf, "lineitem"))
    return rows.select(*PAIR, *KEYS, TARGET)


def balance_classes(spark, sf):
    return sampling.balance_classes(_depths(spark, sf), KEYS)


def depth_strata(spark, sf):
    # Stored, as in the pipeline: strata and splits read the balanced rows several times.
    return strata.depth_strata(settle(balance_classes(spark, sf)).table)


def drop_rare_strata(spark, sf):
    return strata.drop_rare_strata(depth_strata(spark, sf))


def stratified_split(spark, sf):
    return strata.stratified_split(depth_strata(spark, sf), KEYS)


def random_split(spark, sf):
    return sampling.random_split(_depths(spark, sf), KEYS)


def fraction_sample(spark, sf):
    return sampling.fraction_sample(random_split(spark, sf), KEYS)


def shuffle_rows(spark, sf):
    return sampling.shuffle_rows(_depths(spark, sf), KEYS)


# ---------------------------------------------------------------- reports


def regression_report(spark, sf):
    rows = fx.depth_pixels(spark, sf).withColumn(TARGET, v.cap(F.col(TARGET)))
    return _rounded(regression.regression_report(sampling.random_split(rows, KEYS)))


def metrics_by_group(spark, sf):
    rows = fx.depth_pixels(spark, sf).filter(v.deeper_than(F.col(TARGET), 0.01))
    return _rounded(regression.metrics_by_group(rows))


def metrics_by_period(spark, sf):
    rows = fx.benchmark_pixels(spark, sf).withColumnRenamed("benchmark", "return_period")
    cleaned = rows.withColumns(
        {c: v.non_finite_to_zero(F.col(c)) for c in (TARGET, "owp_hand_fim", "predicted")}
    )
    return _rounded(regression.metrics_by_group(cleaned, ["return_period"]))


def benchmark_metrics(spark, sf):
    return _rounded(regression.benchmark_metrics(fx.benchmark_pixels(spark, sf)))


def benchmark_macro_avg(spark, sf):
    return _rounded(
        regression.macro_average(regression.benchmark_metrics(fx.benchmark_pixels(spark, sf)))
    )


def describe_numeric(spark, sf):
    stored = settle(fx.clean_pixels(spark, sf)).table  # several passes follow
    return _rounded(describe.describe_numeric(stored, TARGET))


def table_shape(spark, sf):
    return describe.table_shape(fx.raw_pixels(spark, sf))


def _scores(spark, sf) -> DataFrame:
    return classify.labelled_scores(fx.depth_pixels(spark, sf))


def confusion_matrix(spark, sf):
    return _rounded(classify.confusion_matrix(_scores(spark, sf), {"fixed": 0.01}))


def confusion_at_best_f1(spark, sf):
    return _rounded(classify.classification_report(_scores(spark, sf)))


def pr_curve(spark, sf):
    return _rounded(classify.PrecisionRecall(_scores(spark, sf)).curve(), 8)


def best_f1_threshold(spark, sf):
    return _rounded(classify.PrecisionRecall(_scores(spark, sf)).best_f1(), 8)


def pr_auc(spark, sf):
    return _rounded(classify.PrecisionRecall(_scores(spark, sf)).area())


def pr_vs_threshold(spark, sf):
    return _rounded(classify.PrecisionRecall(_scores(spark, sf)).within_unit(), 8)


def hexbin_density(spark, sf):
    rows = fx.depth_pixels(spark, sf, fx.table(spark, sf, "lineitem")).filter(v.deeper_than(F.col(TARGET), 0.01))
    return _rounded(density.hexbin_density(rows, "predicted", TARGET, PAIR))


def ols_line(spark, sf):
    rows = fx.depth_pixels(spark, sf).filter(v.deeper_than(F.col(TARGET), 0.01))
    return _rounded(density.ols_line(rows, "predicted", TARGET, PAIR))


def union_pairs(spark, sf):
    pixels = fx.raw_pixels(spark, sf).select(*PAIR, *KEYS, "owp_hand_fim", TARGET, "predicted")
    return align.union_pairs(pixels, fx.event_pixels(spark, sf))


# ---------------------------------------------------------------- models


def training_rows(spark, sf) -> DataFrame:
    """Stored clean pixels with capped label and split, as the fits take them."""
    rows = settle(fx.clean_pixels(spark, sf).drop("predicted")).table
    labelled = rows.withColumn("label", v.cap(F.col(TARGET)))
    return settle(sampling.random_split(labelled, KEYS)).table


def _report(scored: DataFrame) -> DataFrame:
    cleaned = scored.withColumn("predicted", v.non_finite_to_zero(F.col("predicted")))
    return regression.regression_report(cleaned, "label")


def _configured(spark, sf, config) -> tuple[DataFrame, BoostedModel]:
    """A fit with the whole configuration: 500 rounds of depth 8 at most, early stopping after 30."""
    rows = training_rows(spark, sf)
    return rows, fit_boosted(rows, FEATURES, BoostParams.from_config(config), KEYS)


def boost_squared(spark, sf):
    rows, model = _configured(spark, sf, SQUARED_CONFIG)
    return _report(model.score(rows))


def boost_tweedie(spark, sf):
    rows, model = _configured(spark, sf, TWEEDIE_CONFIG)
    return _report(model.score(rows))


def boost_history(spark, sf):
    return _configured(spark, sf, TWEEDIE_CONFIG)[1].history_table(spark)


def score_testset(spark, sf):
    """The stored test sets of the prepared pairs, scored by a model of their training rows."""
    folder = fresh_path(spark)
    pixels = settle(fx.clean_pixels(spark, sf).drop("predicted")).table
    split = settle(prepare.split_pixels(pixels, KEYS)).table
    tables.write_test_sets(split.filter("split = 'test'").drop("split"), f"{folder}/test")
    trained = train.train(split.filter("split = 'train'").drop("split"), TWEEDIE_CONFIG, KEYS)
    evaluate.predict(spark, trained.model, f"{folder}/test", f"{folder}/scored")
    return tables.load_pixels(spark, f"{folder}/scored").select(*PAIR, *KEYS, TARGET, "predicted")


def hyper_search_query(spark, sf):
    """The whole search: 56 fits of 100 to 500 rounds."""
    rows = training_rows(spark, sf)
    sample = sampling.fraction_sample(rows, KEYS)
    _, log = hyper_search(sample, FEATURES, SQUARED_CONFIG, KEYS)
    return log


#: One regularised Newton step: small enough for SQL to compute in closed form.
STUMP = {
    "n_estimators": 1, "max_depth": 1, "subsample": 1.0, "colsample_bytree": 1.0, "early_stopping_rounds": None,
}


def _stump(spark, sf, config) -> tuple[DataFrame, BoostedModel]:
    rows = training_rows(spark, sf)
    params = BoostParams.from_config(config, **STUMP)
    return rows, fit_boosted(rows, ["lulc"], params, KEYS)


def _stump_scores(spark, sf, config) -> DataFrame:
    """Model saved and loaded, test sets written by pair, scored, written and read back."""
    rows, model = _stump(spark, sf, config)
    folder = fresh_path(spark)
    model.save(spark, f"{folder}/model")
    tables.write_test_sets(rows.drop("label", "split"), f"{folder}/test")
    loaded = BoostedModel.load(spark, f"{folder}/model")
    evaluate.predict(spark, loaded, f"{folder}/test", f"{folder}/scored")
    return _score_groups(tables.load_pixels(spark, f"{folder}/scored"))


def _stump_folder(spark, sf) -> tuple[DataFrame, BoostedModel, str]:
    rows, model = _stump(spark, sf, SQUARED_CONFIG)
    return rows.drop("label", "split"), model, fresh_path(spark)


def _score_groups(scored: DataFrame) -> DataFrame:
    return _rounded(
        scored.groupBy(*PAIR, "lulc").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("predicted").alias("lowest"),
            F.max("predicted").alias("highest"),
        )
    )


def predict_folder(spark, sf):
    """Test tables at their places in a folder, one watershed's without a feature, found and scored."""
    rows, model, folder = _stump_folder(spark, sf)
    for row in rows.select(*PAIR).distinct().collect():
        own = rows.filter((F.col("huc8") == row["huc8"]) & (F.col("return_period") == row["return_period"]))
        own = own.drop(*PAIR, *(["lulc"] if row["huc8"] == "HUC_A" else []))
        own.write.parquet(f"{folder}/sets/{row['huc8']}/{row['return_period']}_test.parquet")
    skipped = evaluate.predict_folder(spark, model, f"{folder}/sets", f"{folder}/scored")
    scored = _score_groups(tables.load_pixels(spark, f"{folder}/scored"))
    lacking = skipped.select(*PAIR, F.array_join("lacking", ",").alias("lacking"))
    return scored.unionByName(lacking.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)


def predict_in_place(spark, sf):
    """Test sets scored, staged and put in their own place; read from there."""
    rows, model, folder = _stump_folder(spark, sf)
    tables.write_test_sets(rows, f"{folder}/test")
    evaluate.predict_in_place(spark, model, f"{folder}/test", f"{folder}/staged")
    return _score_groups(tables.load_pixels(spark, f"{folder}/test"))


def boost_stump_squared(spark, sf):
    return _stump_scores(spark, sf, SQUARED_CONFIG)


def boost_stump_tweedie(spark, sf):
    return _stump_scores(spark, sf, TWEEDIE_CONFIG)


def boost_stump_history(spark, sf):
    parts = [
        _stump(spark, sf, config)[1].history_table(spark).withColumn("objective", F.lit(name))
        for name, config in (("squared", SQUARED_CONFIG), ("tweedie", TWEEDIE_CONFIG))
    ]
    return _rounded(parts[0].unionByName(parts[1]))


# ---------------------------------------------------------------- whole jobs, stored and read back


def prepare_tables(spark, sf):
    folder = fresh_path(spark)
    prepare.prepare(fx.raster_cells(spark, sf), fx.raster_layers(spark, sf), folder, KEYS)
    return _prepared_totals(spark, folder)


def prepare_folder(spark, sf):
    """Rasters stored at their places in a folder: found, matched, read, prepared; the rest with reasons."""
    folder = fresh_path(spark)
    fx.write_rasters(spark, sf, f"{folder}/rasters")
    done = prepare.prepare_folder(spark, f"{folder}/rasters", f"{folder}/out", KEYS)
    none = F.lit(0).cast("long")
    skipped = done.skipped.withColumns({"train_rows": none, "test_rows": none})
    return _prepared_totals(spark, f"{folder}/out").unionByName(skipped, allowMissingColumns=True)


def _prepared_totals(spark, folder) -> DataFrame:
    test, train = tables.load_pixels(spark, f"{folder}/test"), spark.read.parquet(f"{folder}/train")
    both = test.withColumn("side", F.lit("test")).unionByName(train.withColumn("side", F.lit("train")))
    depth = F.col(TARGET).cast("double")
    return both.groupBy(*PAIR).agg(
        F.count_if(F.col("side") == "train").alias("train_rows"),
        F.count_if(F.col("side") == "test").alias("test_rows"),
        F.round(F.sum(F.when(F.col("side") == "train", depth)), 2).alias("train_depth"),
        F.round(F.sum(F.when(F.col("side") == "test", depth)), 2).alias("test_depth"),
    )


def skipped_pairs(spark, sf):
    matches = settle(catalog.flood_file_match(fx.order_paths(spark, sf))).table
    return prepare.skipped_before_cells(fx.order_layers(spark, sf), matches)


def benchmark_report(spark, sf):
    """Benchmark folders written and read, metrics written as CSV and read."""
    folder = fresh_path(spark)
    tables.write_benchmark_sets(settle(fx.benchmark_pixels(spark, sf)).table, f"{folder}/sets")
    metrics = regression.benchmark_metrics(tables.load_benchmarks(spark, f"{folder}/sets"))
    tables.write_metrics_csv(metrics, f"{folder}/csv")
    return _rounded(spark.read.schema(metrics.schema).option("header", True).csv(f"{folder}/csv"))


def scored_report(spark, sf):
    """Scored pixels written by pair, read back and reported on."""
    folder = fresh_path(spark)
    tables.write_scored(settle(fx.depth_pixels(spark, sf)).table, folder)
    return _rounded(evaluate.metrics_report(tables.load_pixels(spark, folder)))


def mixed_folder(spark, sf):
    """Pairs of one watershed stored without the prediction: reported, and left out of the metrics."""
    folder = fresh_path(spark)
    rows = settle(fx.depth_pixels(spark, sf)).table
    bare = F.col("huc8") == "HUC_A"
    for part in (rows.filter(~bare), rows.filter(bare).drop("predicted")):
        part.write.mode("append").partitionBy(*PAIR).parquet(folder)
    complete, skipped = tables.load_complete(spark, folder, [TARGET, "predicted"])
    metrics = _rounded(evaluate.metrics_report(complete)).filter("Type = 'Predicted'")
    named = skipped.select(*PAIR, F.array_join("lacking", ",").alias("lacking"))
    both = metrics.select(*PAIR, "n", "RMSE").join(named, list(PAIR), "full")
    return both.withColumn("n", F.coalesce("n", F.lit(0)))


def density_baseline(spark, sf):
    return _rounded(evaluate.density_report(fx.depth_pixels(spark, sf), baseline=True).hexagons)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        pair_discovery, period_from_name, flood_file_match, load_layers, benchmark_match, path_columns,
        shape_check, owp_mask, flood_fill_zero, layer_mean_impute, aspect_sincos, drop_missing,
        pixel_table, pixel_table_bucketed, pixel_align, feature_projection, coerce_target, cap_target, log_target, unlog,
        nan_to_zero, nan_to_finite, depth_filter, nan_audit,
        balance_classes, depth_strata, drop_rare_strata, stratified_split, random_split,
        fraction_sample, shuffle_rows,
        regression_report, metrics_by_group, metrics_by_period, benchmark_metrics, benchmark_macro_avg,
        describe_numeric, table_shape, confusion_matrix, confusion_at_best_f1, pr_curve,
        best_f1_threshold, pr_auc, pr_vs_threshold, hexbin_density, ols_line, union_pairs,
        boost_squared, boost_tweedie, boost_history, score_testset,
        boost_stump_squared, boost_stump_tweedie, boost_stump_history,
        prepare_tables, prepare_folder, predict_folder, predict_in_place, skipped_pairs, benchmark_report, scored_report, mixed_folder, density_baseline,
    )
}
QUERIES["hyper_search"] = hyper_search_query
