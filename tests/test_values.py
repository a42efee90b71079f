import math

import pytest
from pyspark.sql import functions as F

from depthgrid.functions import values as v
from depthgrid.schema import MissingColumns, feature_columns, require_columns, target_first

NAN, INF = float("nan"), float("inf")


def column(spark, data, expression):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(data)], "i int, x double")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]


def same(got, want):
    return all(
        (g is None and w is None) or g == w or (g != g and w != w) for g, w in zip(got, want, strict=True)
    )


def test_cap_keeps_nan_and_null(spark):
    got = column(spark, [1.0, 30.0, NAN, None, INF], v.cap)
    assert same(got, [1.0, 25.01, NAN, None, 25.01])


def test_non_finite_to_zero_and_to_limits(spark):
    data = [1.5, NAN, INF, -INF, None]
    assert same(column(spark, data, v.non_finite_to_zero), [1.5, 0.0, 0.0, 0.0, None])
    assert same(
        column(spark, data, v.non_finite_to_limits), [1.5, 0.0, v.FLOAT64_MAX, -v.FLOAT64_MAX, None]
    )
    narrow = column(spark, data, lambda c: v.non_finite_to_limits(c.cast("float")))
    assert same(narrow, [1.5, 0.0, v.FLOAT32_MAX, -v.FLOAT32_MAX, None])


@pytest.mark.parametrize("nodata, expected", [(-9999.0, [True, False, False]), (NAN, [False] * 3), (None, [False] * 3)])
def test_nodata_never_matches_nan_or_null(spark, nodata, expected):
    got = column(spark, [-9999.0, NAN, 1.0], lambda c: v.is_nodata(c, F.lit(nodata).cast("double")))
    assert got == expected


def test_nodata_is_compared_in_float32(spark):
    assert column(spark, [0.1], lambda c: v.is_nodata(c.cast("float"), F.lit(0.1))) == [True]


def test_zero_fill_leaves_nan(spark):
    assert same(column(spark, [-1.0, NAN, 2.0], lambda c: v.zero_fill(c, F.lit(-1.0))), [0.0, NAN, 2.0])


def test_depth_filter_is_strict_and_drops_nan(spark):
    rows = spark.createDataFrame([(0.01,), (0.011,), (NAN,), (None,)], "x double")
    assert [r[0] for r in rows.filter(v.deeper_than(F.col("x"), 0.01)).collect()] == [0.011]


def test_wet_label(spark):
    assert column(spark, [0.01, 0.02, NAN, None], v.wet_label) == [0, 1, 0, 0]


def test_text_becomes_number_or_null(spark):
    rows = spark.createDataFrame([("1.5",), ("bad",), (None,)], "t string")
    assert [r[0] for r in rows.select(v.to_number(F.col("t"))).collect()] == [1.5, None, None]


def test_log_round_trip(spark):
    got = column(spark, [0.0, 3.7], lambda c: v.unlog_depth(v.log_depth(c)))
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(got, [0.0, 3.7]))


def test_column_gates(spark):
    rows = spark.createDataFrame([("h", "p", 1.0, 2.0, 3.0)], "huc8 string, return_period string, dem double, flood_depth double, predicted double")
    assert feature_columns(rows) == ["dem"]
    assert target_first(rows).columns[0] == "flood_depth"
    with pytest.raises(MissingColumns, match="slope"):
        require_columns(rows, ["dem", "slope"])
