"""Column names, fixed values and explicit schemas of the tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TARGET = "flood_depth"
BASELINE = "owp_hand_fim"
PREDICTED = "predicted"
PAIR = ("huc8", "return_period")
PIXEL = ("row", "col")

# Layer names, the target cap, the wet/dry threshold and the seed.
PERIOD_LAYERS = ("owp_hand_fim", "flood_depth")
SHARED_LAYERS = ("aspect", "curvature", "dem", "lulc", "rem", "slope")
FEATURES = ("owp_hand_fim", "aspect_sin", "aspect_cos", "curvature", "dem", "lulc", "rem", "slope")
TARGET_CAP = 25.01
WET_THRESHOLD = 0.01
SEED = 42

CELLS = T.StructType(
    [
        T.StructField("huc8", T.StringType()),
        T.StructField("return_period", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("col", T.IntegerType()),
        T.StructField("value", T.FloatType()),
    ]
)

LAYERS = T.StructType(
    [
        T.StructField("huc8", T.StringType()),
        T.StructField("return_period", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("n_rows", T.IntegerType()),
        T.StructField("n_cols", T.IntegerType()),
        T.StructField("nodata", T.DoubleType()),
    ]
)


class MissingColumns(ValueError):
    """A table lacks columns that the requested operation needs."""


def require_columns(df: DataFrame, needed: Iterable[str]) -> DataFrame:
    """Stop before any plan is built when ``df`` lacks one of ``needed``."""
    lacking = [name for name in needed if name not in df.columns]
    if lacking:
        raise MissingColumns(f"missing columns {lacking}; table has {df.columns}")
    return df


def numeric_columns(df: DataFrame, without: Iterable[str] = ()) -> list[str]:
    """Numeric columns in table order, minus ``without`` (names that are absent are ignored)."""
    dropped = set(without)
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in dropped
    ]


def feature_columns(df: DataFrame, target: str = TARGET) -> list[str]:
    """Model inputs: every numeric column but the target, the keys and an earlier score."""
    return numeric_columns(df, without=(target, *PAIR, PREDICTED))


def target_first(df: DataFrame, target: str = TARGET) -> DataFrame:
    require_columns(df, [target])
    return df.select(target, *[c for c in df.columns if c != target])
