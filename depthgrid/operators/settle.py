"""Settled tables and size-checked joins of per-group facts onto rows.

``settle`` writes a result once to the shared folder and reads it back: lineage ends there,
a lost executor cannot change an already used aggregate, and rows and their greatest width
are known from the write itself. ``attach`` broadcasts within a bound of bytes and otherwise
leaves both sides to a shuffle join whose skewed partitions Spark splits by their real sizes
(``build_session`` turns that on), so no join relies on a guess.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthgrid.session import fresh_path

BROADCAST_BYTES = 32 << 20
#: Bytes of a row besides its values, as a hashed relation holds it.
ROW_OVERHEAD = 32


@dataclass(frozen=True)
class Settled:
    """A table and upper bounds of its rows and of a row's bytes."""

    table: DataFrame
    rows: int
    path: str
    width: int = 1 << 10
    measures: dict = field(default_factory=dict)

    @property
    def broadcastable(self) -> bool:
        return self.rows * (self.width + ROW_OVERHEAD) <= BROADCAST_BYTES


#: Taken for values whose size is not measured (maps, lists of texts): never broadcast.
UNMEASURED = 1 << 40


def _width(value: Column, kind: T.DataType) -> int | Column:
    """Bytes of a value: a number for fixed-size types, else an expression over the row."""
    if isinstance(kind, T.StructType):
        parts = [_width(value[f.name], f.dataType) for f in kind]
        return sum(parts, 8)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 8 + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType):
        each = _width(F.lit(None), kind.elementType)
        return 8 + F.coalesce(F.size(value), F.lit(0)) * each if isinstance(each, int) else UNMEASURED
    if isinstance(kind, T.MapType):
        return UNMEASURED
    return 16 if isinstance(kind, T.DecimalType) else 8


def settle(df: DataFrame, partition_by: Sequence[str] = (), **measures: Column) -> Settled:
    """Write ``df`` to the shared folder; ``measures`` are aggregates observed during the write."""
    spark = df.sparkSession
    path = fresh_path(spark)
    seen = Observation()
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), 0)
    wide = [] if isinstance(width, int) else [F.max(width.cast("long")).alias("_width")]
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("_rows"),
        *wide,
        *[measure.alias(name) for name, measure in measures.items()],
    )
    observed.write.partitionBy(*partition_by).parquet(path)
    facts = dict(seen.get)
    table = spark.read.schema(df.schema).parquet(path)
    if wide:
        width = int(facts.pop("_width") or 0)
    return Settled(table, int(facts.pop("_rows") or 0), path, width, facts)


def attach(
    rows: DataFrame,
    facts: Settled,
    keys: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join per-group facts onto rows by ``keys`` (``how``: inner, left or left_semi).

    Facts of at most ``BROADCAST_BYTES`` are broadcast. Beyond that both sides shuffle, and the
    rows of a large group are split over tasks by adaptive execution.
    """
    keys = list(keys)
    small = F.broadcast(facts.table) if facts.broadcastable else facts.table
    return rows.join(small, keys, how)
