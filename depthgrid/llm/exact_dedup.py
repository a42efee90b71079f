"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each step is one grouping of narrow rows (map-side combined) and only its colliding groups go
on. The full text is hashed just for rows whose (length, prefix) occurs twice; which rows those
are reaches the scan as a bounded bitmap, whose false hits cost a hash and change nothing.

Defined cases: a null text is an empty text; texts are equal when they are identical after
lower-casing A-Z; of equal texts the largest id stays, and of rows repeated with that same id
one row stays; null ids sort below all others; very long texts are compared by their whole digest;
an empty table gives an empty table; further
columns are carried or ignored and may have any name without a leading "__".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthgrid.llm.shared import BITMAP_BITS, bitmap, counted, gathered, mark, stored

PREFIX_CHARS = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def full_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def _repeated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*keys)


def _refined(docs: DataFrame, id_col: str, text_col: str, carry: Column) -> DataFrame:
    """Rows (__id, __carry, __len, __head, __full); __full is null where it was never needed."""
    text = F.col(text_col)
    length = F.octet_length(F.coalesce(text, F.lit("")))
    head = F.xxhash64(normalised(F.substring(text, 1, PREFIX_CHARS)))
    narrow, n_rows = counted(docs.select(length.alias("__len"), head.alias("__head")))
    # Stored, so that the join shuffles both sides and AQE can split the rows of a frequent length.
    by_length = stored(_repeated(narrow, ["__len"]), n_rows // 2)
    by_head = _repeated(narrow.join(by_length, "__len", "left_semi"), ["__len", "__head"])
    bits = stored(bitmap(by_head, ["__len", "__head"]), BITMAP_BITS // 64)
    rows = docs.select(
        F.col(id_col).alias("__id"), carry.alias("__carry"), text.alias("__text"),
        length.alias("__len"), head.alias("__head"),
    )
    return mark(rows, bits, ["__len", "__head"], "__again").select(
        "__id", "__carry", "__len", "__head",
        F.when(F.col("__again"), full_digest(F.col("__text"))).alias("__full"),
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Column | None = None
) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, carried.

    ``carry`` is an expression over ``docs`` returned with each row (null by default).
    """
    rows, n_rows = counted(
        _refined(docs, id_col, text_col, F.lit(None) if carry is None else carry)
        .withColumn("__row", F.monotonically_increasing_id())
    )
    keys = ["__len", "__head", "__full"]
    groups = stored(
        rows.filter("__full is not null")
        .groupBy(*keys)
        .agg(F.max(F.struct("__id", "__row")).alias("__best"), F.count(F.lit(1)).alias("__size"))
        .filter("__size > 1"),
        n_rows // 2,
    )
    # A row without a full hash matches no group. It gets a key of its own, so that unique rows
    # do not meet in one task; AQE splits the rows of a large group.
    own = F.coalesce("__full", F.col("__row").cast("string"))
    joined = gathered(rows.withColumn("__full", own).join(groups, keys, "left"), n_rows)
    return joined.select(
        F.col("__id").alias(id_col),
        F.coalesce("__best.__id", "__id").alias("keep_id"),
        F.coalesce("__size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("__best").isNull() | (F.col("__best.__row") == F.col("__row"))).alias("kept"),
        F.col("__carry").alias("carried"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Only rows in colliding groups are shuffled; copies combine before the shuffle.
    """
    rows = _refined(docs, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    rows = stored(rows)
    single = rows.filter("__full is null").select("__carry")
    best = (
        rows.filter("__full is not null")
        .groupBy("__len", "__head", "__full")
        .agg(F.max_by("__carry", F.struct("__id", F.xxhash64("__carry"))).alias("__carry"))
        .select("__carry")
    )
    return single.union(best).select("__carry.*")
