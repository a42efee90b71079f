import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from depthgrid.operators import align
from depthgrid.operators import settle as settle_module
from depthgrid.operators.settle import settle
from depthgrid.plans import evaluate, prepare, train
from depthgrid.schema import CELLS, FEATURES, LAYERS, SHARED_LAYERS
from depthgrid.sources import catalog, tables

NAN = float("nan")
ROWS, COLS = 24, 20


def make_world(seed=1, nan_sentinel_pair=True):
    """Arrays per (huc8, period, layer) with their sentinels, as dense rasters."""
    rng = np.random.default_rng(seed)
    world = {}
    for huc8 in ("01020304", "05060708"):
        for layer in SHARED_LAYERS:
            values = rng.uniform(0, 360 if layer == "aspect" else 50, (ROWS, COLS)).astype("float32")
            values[rng.uniform(size=values.shape) < 0.1] = -9999
            values[rng.uniform(size=values.shape) < 0.02] = np.nan
            world[huc8, None, layer] = (values, -9999.0 if layer != "slope" else None)
        for period in ("10yr", "100yr"):
            owp = rng.gamma(2, 1, (ROWS, COLS)).astype("float32")
            depth = (owp * rng.uniform(0.5, 1.5, owp.shape)).astype("float32")
            depth[rng.uniform(size=owp.shape) < 0.5] = -1
            owp[rng.uniform(size=owp.shape) < 0.15] = 99
            sentinel = NAN if nan_sentinel_pair and huc8 == "05060708" and period == "10yr" else -1.0
            depth[(depth == -1) & math.isnan(sentinel)] = np.nan
            world[huc8, period, "owp_hand_fim"] = (owp, 99.0)
            world[huc8, period, "flood_depth"] = (depth, sentinel)
    return world


def as_tables(spark, world):
    cells = pd.concat(
        pd.DataFrame(
            {"huc8": h, "return_period": p, "layer": l, "row": np.repeat(np.arange(a.shape[0]), a.shape[1]),
             "col": np.tile(np.arange(a.shape[1]), a.shape[0]), "value": a.ravel()}
        )
        for (h, p, l), (a, _) in world.items()
    )
    cell_rows = [
        (h, p, l, int(r), int(c), float(v)) for h, p, l, r, c, v in cells.itertuples(index=False)
    ]
    layer_rows = [(h, p, l, *a.shape, n) for (h, p, l), (a, n) in world.items()]
    return spark.createDataFrame(cell_rows, CELLS), spark.createDataFrame(layer_rows, LAYERS)


def pixels_by_hand(world, huc8, period):
    """The documented rules on dense arrays."""
    owp, owp_nodata = world[huc8, period, "owp_hand_fim"]
    depth, depth_nodata = (world[huc8, period, "flood_depth"][0].copy(), world[huc8, period, "flood_depth"][1])
    depth[depth == depth_nodata] = 0
    data = {"owp_hand_fim": owp, "flood_depth": depth}
    for layer in SHARED_LAYERS:
        values, nodata = world[huc8, None, layer]
        values = values.astype(float)
        if nodata is not None:
            values[values == nodata] = np.nan
        values = np.where(np.isnan(values), np.nanmean(values), values)
        if layer == "aspect":
            data["aspect_sin"], data["aspect_cos"] = np.sin(np.radians(values)), np.cos(np.radians(values))
        else:
            data[layer] = values
    frame = pd.DataFrame({k: v.ravel() for k, v in data.items()})
    frame["row"], frame["col"] = np.repeat(np.arange(ROWS), COLS), np.tile(np.arange(COLS), ROWS)
    return frame[owp.ravel() != owp_nodata].dropna().sort_values(["row", "col"]).reset_index(drop=True)


@pytest.mark.parametrize("broadcast_bytes", [0, 10**9])
def test_pixel_table_matches_dense_rules(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(settle_module, "BROADCAST_BYTES", broadcast_bytes)
    world = make_world()
    got = align.pixel_table(*as_tables(spark, world)).toPandas()
    assert set(got.huc8) == {"01020304", "05060708"}
    for (huc8, period), rows in got.groupby(["huc8", "return_period"]):
        want = pixels_by_hand(world, huc8, period)
        mine = rows.sort_values(["row", "col"]).reset_index(drop=True)
        assert len(mine) == len(want)
        for c in ("row", "col", "flood_depth", *FEATURES):
            assert mine[c].to_numpy() == pytest.approx(want[c].to_numpy(), rel=1e-5, abs=1e-5), c


def test_pairs_with_bad_layers_are_left_out(spark):
    world = make_world()
    values, nodata = world["01020304", "10yr", "flood_depth"]
    world["01020304", "10yr", "flood_depth"] = (values[:-1], nodata)  # another shape
    del world["05060708", None, "rem"]  # absent shared layer: all pairs of the watershed go
    got = align.pixel_table(*as_tables(spark, world)).select("huc8", "return_period").distinct().collect()
    assert [tuple(r) for r in got] == [("01020304", "100yr")]


def test_layer_without_any_value_leaves_no_rows(spark):
    world = make_world()
    values, nodata = world["01020304", None, "dem"]
    world["01020304", None, "dem"] = (np.full_like(values, -9999), nodata)
    got = align.pixel_table(*as_tables(spark, world)).select("huc8").distinct().collect()
    assert [r[0] for r in got] == ["05060708"]


def test_cells_cross_the_network_once(spark):
    cells, _ = as_tables(spark, make_world())
    aligned = align.align_pixels(cells.filter("return_period is not null"), cells.filter("return_period is null"))
    plan = aligned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(huc8") == 2


def test_cells_carry_a_byte_for_their_layer(spark):
    """Before, the names of the layers were shuffled; names outside the lists still give a row of nulls."""
    own = spark.createDataFrame(
        [("H", 1, 2, "5yr", "flood_depth", 3.5), ("H", 1, 2, "9yr", "odd", 1.0), ("H", 7, 7, "5yr", "flood_depth", 0.0)],
        "huc8 string, row int, col int, return_period string, layer string, value double",
    )
    shared = spark.createDataFrame(
        [("H", 1, 2, "slope", 8.0), ("H", 1, 2, "aspect", 9.0), ("H", 1, 2, "odd", 4.0)],
        "huc8 string, row int, col int, layer string, value double",
    )
    out = align.align_pixels(own, shared)
    assert "as tinyint) AS layer" in out._jdf.queryExecution().executedPlan().toString()
    found = {r["return_period"]: r for r in out.collect()}
    assert set(found) == {"5yr", "9yr"} and found["9yr"]["flood_depth"] is None
    assert (found["5yr"]["flood_depth"], found["5yr"]["slope"], found["5yr"]["aspect"], found["5yr"]["dem"]) == (3.5, 8.0, 9.0, None)


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "id int, predicted double")
    b = spark.createDataFrame([(2,)], "id int")
    assert {(r["id"], r["predicted"]) for r in align.union_pairs(a, b).collect()} == {(1, 2.0), (2, None)}


def test_prepare_train_predict_and_evaluate(spark, tmp_path):
    world = make_world(nan_sentinel_pair=False)
    cells, layers = as_tables(spark, world)
    out = str(tmp_path / "prepared")
    prepared = prepare.prepare(cells, layers, out)
    counts = prepared.counts.collect()
    assert len(counts) == 4 and prepared.skipped.count() == 0
    tests = tables.load_pixels(spark, f"{out}/test")
    assert {r[0] for r in tests.select("huc8").distinct().collect()} == {"01020304", "05060708"}
    assert sum(r["test_rows"] for r in counts) == tests.count()
    training = spark.read.parquet(f"{out}/train")
    assert sum(r["train_rows"] for r in counts) == training.count()

    keys = ["huc8", "return_period", "row", "col"]
    config = {"objective": "reg:squarederror", "n_estimators": 4, "max_depth": 3, "early_stopping_rounds": 3}
    trained = train.train(training, config, keys, log_target=True)
    assert {r["split"] for r in trained.report.collect()} == {"train", "validation"}
    assert set(trained.model.features) == set(FEATURES)

    scored_path = str(tmp_path / "scored")
    evaluate.predict(spark, trained.model, f"{out}/test", scored_path, log_target=True)
    scored = tables.load_pixels(spark, scored_path)
    assert scored.count() == tests.count() and "predicted" in scored.columns
    metrics = evaluate.metrics_report(scored).collect()
    assert len(metrics) == 8
    report = evaluate.classification_report(scored)
    assert sum(report["confusion"].filter("name = 'fixed'").first()[c] for c in ("tn", "fp", "fn", "tp")) == scored.count()
    panels = evaluate.density_report(scored)
    assert panels.hexagons.agg(F.sum("n")).first()[0] == scored.filter("flood_depth > 0.01").count()
    assert panels.line.count() == 400 and panels.metrics.count() == 4

    # Benchmarks: the watershed stands for the date.
    bench = {("d" + h, p and "d" + h, l): v for (h, p, l), v in world.items() if p in (None, "10yr")}
    folder, csv = str(tmp_path / "bench"), str(tmp_path / "csv")
    prepare.prepare_benchmarks(*as_tables(spark, bench), folder)
    table, average = evaluate.evaluate_benchmarks(spark, trained.model, folder, csv, log_target=True)
    assert [r["benchmark"] for r in table.collect()] == ["d01020304", "d05060708"]
    written = spark.read.option("header", True).csv(csv)
    assert written.count() == 2 and written.columns == table.columns
    assert average.first()["owp_mse"] == pytest.approx(np.mean([r["owp_mse"] for r in table.collect()]))
    loaded = tables.load_benchmarks(spark, folder)
    assert "huc8" not in loaded.columns
    dense = evaluate.benchmark_density_report(loaded, trained.model, min_depth=0.5)
    assert dense.hexagons.agg(F.sum("n")).first()[0] == loaded.filter("flood_depth > 0.5").count()


def test_discovery_on_real_folders(spark, tmp_path):
    def touch(*parts):
        path = tmp_path.joinpath(*parts)
        os.makedirs(path.parent, exist_ok=True)
        path.write_bytes(b"x")

    touch("01", "owp_hand_fim", "10yr_01_depth.tif")
    touch("01", "owp_hand_fim", "50yr.tif")
    touch("01", "owp_hand_fim", "100yr.tif")
    touch("01", "owp_hand_fim", "notes.txt")
    touch("01", "flood_depth", "fim_10yr.tif")
    touch("01", "flood_depth", "10yr_01_depth.tif")
    touch("01", "flood_depth", "fim_50yr_m_final.tif")
    touch("01", "flood_depth", "fim_50yr.tif")
    touch("02", "owp_hand_fim", "10yr.tif")
    touch("01", "dem.tif")
    paths = catalog.list_files(spark, str(tmp_path))
    matches = settle(catalog.flood_file_match(paths)).table
    found = {r["return_period"]: os.path.basename(r["flood_path"]) for r in catalog.matched_pairs(matches).collect()}
    assert found == {"10yr": "10yr_01_depth.tif", "50yr": "fim_50yr_m_final.tif"}
    assert [r["return_period"] for r in catalog.skipped_pairs(matches).collect()] == ["100yr"]


def test_benchmark_match_prefers_dated_slope(spark):
    names = ["owp_hand_fim{d}.tif", "slope.tif", *(f"{n}_{{d}}.tif" for n in ("flood_depth", "aspect", "curvature", "dem", "lulc", "rem"))]
    paths = [f"b/{d}/" + n.format(d=d) for d in ("2001", "2002", "2003") for n in names]
    paths += ["b/2002/slope_2002.tif"]
    paths.remove("b/2003/rem_2003.tif")
    got = catalog.benchmark_match(spark.createDataFrame([(p,) for p in paths], "path string")).toPandas()
    slopes = got[got.layer == "slope"].set_index("benchmark").path.to_dict()
    assert slopes == {"2001": "b/2001/slope.tif", "2002": "b/2002/slope_2002.tif"}
    assert (got.groupby("benchmark").size() == 8).all()


def test_skipped_pairs_have_a_reason(spark, tmp_path):
    world = make_world(nan_sentinel_pair=False)
    values, nodata = world["01020304", "10yr", "flood_depth"]
    world["01020304", "10yr", "flood_depth"] = (values[:-1], nodata)
    values, nodata = world["05060708", "10yr", "flood_depth"]
    world["05060708", "10yr", "flood_depth"] = (np.full_like(values, np.inf), nodata)
    values, nodata = world["05060708", "100yr", "owp_hand_fim"]
    world["05060708", "100yr", "owp_hand_fim"] = (np.full_like(values, nodata), nodata)
    matches = spark.createDataFrame(
        [("01020304", "10yr", "a", None), ("01020304", "5yr", "b", None), ("01020304", "100yr", "c", "x")],
        "huc8 string, return_period string, owp_file string, flood_path string",
    )
    done = prepare.prepare(*as_tables(spark, world), str(tmp_path / "out"), matches=matches)
    got = {(r.huc8, r.return_period, r.reason) for r in done.skipped.collect()}
    assert got == {
        ("01020304", "5yr", prepare.NO_FILE), ("01020304", "10yr", prepare.NO_FILE),
        ("01020304", "10yr", prepare.SHAPES), ("05060708", "10yr", prepare.INFINITE),
        ("05060708", "100yr", prepare.NO_PIXEL),
    }
    assert [(r.huc8, r.return_period) for r in done.counts.collect()] == [("01020304", "100yr")]


def test_sink_files_follow_the_rows_of_a_pair(spark, tmp_path):
    """Many tasks that all hold rows of all pairs: files per pair stay near rows over file rows."""
    rows = spark.range(40_000).selectExpr(
        "cast(id % 10 = 0 as string) as huc8", "cast(id % 3 as string) as return_period", "id"
    ).repartition(50)
    tables.write_test_sets(rows, str(tmp_path / "sets"), file_rows=2_000)
    files = {}
    for folder, _, names in os.walk(tmp_path / "sets"):
        parts = [n for n in names if n.endswith(".parquet")]
        if parts:
            files[os.path.relpath(folder, tmp_path / "sets")] = len(parts)
    assert len(files) == 6
    for pair, n in files.items():
        assert n <= (2 * 6 if "huc8=false" in pair else 2 * 1), (pair, n)
    assert tables.load_pixels(spark, str(tmp_path / "sets")).count() == 40_000


def test_a_task_of_a_sink_has_few_rows(spark, tmp_path):
    """Keys of any size, a NULL one too: no task gets two files' rows, each row is written once."""
    rows = spark.range(40_000).selectExpr(
        "case id % 7 when 0 then null when 1 then 'b' else 'a' end as huc8", "'p' as return_period", "id"
    )
    tables.write_test_sets(rows, str(tmp_path / "sets"), file_rows=1_000)
    tasks = {}
    for folder, _, names in os.walk(tmp_path / "sets"):
        for name in (n for n in names if n.endswith(".parquet")):
            task = name.split("-")[1]
            tasks[task] = tasks.get(task, 0) + spark.read.parquet(os.path.join(folder, name)).count()
    assert sum(tasks.values()) == 40_000 and max(tasks.values()) < 2_400 and len(tasks) > 20
    back = tables.load_pixels(spark, str(tmp_path / "sets"))
    assert back.select(*rows.columns).exceptAll(rows).count() == 0


def test_buckets_follow_the_cells(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_CELLS", 500)
    cells = spark.range(10_000).selectExpr("'h' as huc8", "cast(id % 1000 as string) as pixel_id", "id as value")
    stored = tables.store_bucketed(cells, "cells_that_grow", str(tmp_path / "cells"), pixel=["pixel_id"])
    sizes = [r["count"] for r in stored.groupBy(F.spark_partition_id()).count().collect()]
    spark.sql("drop table cells_that_grow")
    assert sum(sizes) == 10_000 and len(os.listdir(tmp_path / "cells")) >= 20


def test_two_cells_of_one_pixel_are_refused(spark):
    cells, layers = as_tables(spark, make_world(nan_sentinel_pair=False))
    twice = cells.unionByName(cells.filter("layer = 'dem'").limit(1))
    with pytest.raises(Exception, match="two cells"):
        align.pixel_table(twice, layers).count()


def test_groups_without_a_needed_column_are_reported(spark, tmp_path):
    rows = spark.range(40).selectExpr(
        "cast(id % 4 as string) as huc8", "'p' as return_period", "cast(id as double) as flood_depth",
        "cast(id as double) as predicted", "if(id % 4 = 1, null, 1.0D) as owp_hand_fim",
    )
    path = str(tmp_path / "mixed")
    rows.filter("huc8 <> '2'").write.partitionBy("huc8", "return_period").parquet(path)
    rows.filter("huc8 = '2'").drop("predicted").write.mode("append").partitionBy("huc8", "return_period").parquet(path)
    kept, skipped = tables.load_complete(spark, path, ["flood_depth", "predicted", "owp_hand_fim"])
    # A column that is there and holds nothing is not an absent one.
    assert {r.huc8 for r in kept.collect()} == {"0", "1", "3"} and kept.count() == 30
    assert {(r.huc8, tuple(r.lacking)) for r in skipped.collect()} == {("2", ("predicted",))}
    none, all_of_them = tables.load_complete(spark, path, ["slope"])
    assert none.count() == 0 and all_of_them.count() == 4
