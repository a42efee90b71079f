"""Column expressions for missing values, sentinels and target transforms.

NaN follows IEEE here (never equal to anything), unlike Spark SQL's own ``=`` where
NaN equals NaN; every comparison below guards for that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from depthgrid.schema import TARGET_CAP, WET_THRESHOLD

# Largest finite float32 and float64.
FLOAT32_MAX = 3.4028234663852886e38
FLOAT64_MAX = 1.7976931348623157e308


def nan_as_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def is_missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value)


def is_nodata(value: Column, nodata: Column) -> Column:
    """True where ``value`` is the sentinel, compared in float32; a NULL or NaN sentinel matches nothing."""
    sentinel = nodata.cast("float")
    same = (value.cast("float") == sentinel) & ~F.isnan(sentinel)
    return F.coalesce(same, F.lit(False))


def zero_fill(value: Column, nodata: Column) -> Column:
    return F.when(is_nodata(value, nodata), F.lit(0.0)).otherwise(value)


def nodata_as_null(value: Column, nodata: Column) -> Column:
    """Sentinel and NaN become NULL, so that built-in averages skip them."""
    return F.when(~is_nodata(value, nodata) & ~F.isnan(value), value)


def sine_of_degrees(value: Column) -> Column:
    return F.sin(F.radians(value))


def cosine_of_degrees(value: Column) -> Column:
    return F.cos(F.radians(value))


def to_number(value: Column) -> Column:
    """Numeric reading of any column; text that is no number becomes NULL."""
    return value.try_cast("double")


def cap(value: Column, limit: float = TARGET_CAP) -> Column:
    """Upper cap that lets NaN and NULL through (``least`` would replace both by the limit)."""
    return F.when(F.isnan(value), value).when(value > limit, F.lit(limit)).otherwise(value)


def log_depth(value: Column) -> Column:
    return F.log1p(value)


def unlog_depth(value: Column) -> Column:
    return F.expm1(value)


def _replace_non_finite(value: Column, high: float, low: float) -> Column:
    return (
        F.when(F.isnan(value), F.lit(0.0))
        .when(value == float("inf"), F.lit(high))
        .when(value == float("-inf"), F.lit(low))
        .otherwise(value)
    )


def non_finite_to_zero(value: Column) -> Column:
    return _replace_non_finite(value, 0.0, 0.0)


def non_finite_to_limits(value: Column) -> Column:
    """NaN to 0 and infinities to the largest finite value of the input's width.

    The width is the column's own type, which decides while the plan is made.
    """
    narrow = F.typeof(value) == "float"
    high = F.when(narrow, F.lit(FLOAT32_MAX)).otherwise(F.lit(FLOAT64_MAX))
    return _replace_non_finite(value, high, -high)


def deeper_than(value: Column, depth: float) -> Column:
    """Strict depth filter; a missing depth never passes."""
    return (value > depth) & ~F.isnan(value)


def wet_label(value: Column, threshold: float | Column = WET_THRESHOLD) -> Column:
    """1 above the threshold, else 0; a missing value counts as not above."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.coalesce(deeper_than(value, limit).cast("int"), F.lit(0))
