"""Helpers shared by the operators: bounded bitmaps, stored tables, joins that keep every row.

Internal columns begin with two underscores, so a caller's columns may have any other name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthgrid.operators.settle import settle

#: Bits of a bitmap. Its table has at most BITMAP_BITS / 64 rows (2**18, about 12 MB broadcast).
BITMAP_BITS = 1 << 24
#: Largest number of rows that is broadcast after they were counted.
BROADCAST_ROWS = 200_000


#: Rows of narrow tables that go into one file at least.
ROWS_PER_FILE = 100_000


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """At most one partition for each ROWS_PER_FILE of a known number of narrow rows."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))


def stored(df: DataFrame, at_most: int | None = None) -> DataFrame:
    """Write to the cluster's shared folder and read back: lineage ends, nothing is recomputed.

    ``at_most`` is a known bound of the rows; a small table then isn't scattered over one tiny
    file for each shuffle partition.
    """
    return counted(df, at_most)[0]


def counted(df: DataFrame, at_most: int | None = None) -> tuple[DataFrame, int]:
    """``stored`` with the number of rows."""
    done = settle(df if at_most is None else gathered(df, at_most))
    return done.table, done.rows


def _slot(keys: Sequence[Column | str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITMAP_BITS))


def bitmap(keys_table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table (__word, __bits) with one bit set for the hash of each key.

    At most BITMAP_BITS / 64 rows whatever the input holds, which is what makes it safe to
    broadcast. It says "surely absent" or "maybe present", so it only narrows a shuffle; an
    exact join or recount has to follow.
    """
    slot = _slot(keys)
    return (
        keys_table.select(
            F.shiftright(slot, 6).cast("int").alias("__word"),
            F.expr(f"shiftleft(1L, cast(pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), 64) as int))").alias("__bits")
        )
        .groupBy("__word")
        .agg(F.bit_or("__bits").alias("__bits"))
    )


def mark(rows: DataFrame, bits: DataFrame, keys: Sequence[Column | str], name: str) -> DataFrame:
    """Add the boolean ``name``: false where the row's key is surely not in the bitmap."""
    found = rows.withColumn("__word", F.shiftright(_slot(keys), 6).cast("int")).withColumn(
        "__bit", F.pmod(F.xxhash64(*keys), F.lit(64)).cast("int")
    )
    return (
        found.join(F.broadcast(bits), "__word", "left")
        .withColumn(
            name,
            F.coalesce(F.getbit(F.col("__bits"), F.col("__bit")) == 1, F.lit(False)),
        )
        .drop("__word", "__bits", "__bit")
    )


def semi_by_id(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in the distinct ids; only rows that pass the bitmap are shuffled."""
    bits = stored(bitmap(ids, [key]), BITMAP_BITS // 64)
    maybe = mark(rows, bits, [key], "__maybe").filter("__maybe").drop("__maybe")
    return maybe.join(ids, key, "left_semi")


def anti_by_id(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not in the ids (a null key stays), few of them shuffled."""
    marked = mark(rows, stored(bitmap(ids, [key]), BITMAP_BITS // 64), [key], "__maybe")
    sure = marked.filter("not __maybe").drop("__maybe")
    rest = marked.filter("__maybe").drop("__maybe").join(ids, key, "left_anti")
    return sure.unionByName(rest.select(*sure.columns))


def join_small(rows: DataFrame, small: DataFrame, keys: list[str], count: int, how: str = "inner"):
    """Broadcast ``small`` if its counted rows are few, else shuffle both (AQE splits skew)."""
    return rows.join(F.broadcast(small) if count <= BROADCAST_ROWS else small, keys, how)
