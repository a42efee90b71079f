"""Benchmark items inside documents: size-partitioned MinHash containment, then exact containment.

Items are partitioned by the size q of their shingle set, 2**c <= q < 2**(c+1). For each
partition a document is read in blocks of 2**(c+1) shingles, so a block is never much larger than
the item and the Jaccard value that containment 0.75 implies stays high (0.25 or more over the
blocks that hold the passage) however long the document is. Item and block are compared by one
minimum in each of 128 bins of a one-permutation MinHash; any equal minimum makes a candidate. Items
of fewer than SMALL shingles fill too few bins for that: every shingle of theirs is a key, and any
shared one makes a candidate, so none of them is overlooked. A larger one is with probability below
(1 - 0.25)**m for the m bins it fills, about 50 for 64 shingles (1e-6) and all 128 for many (1e-16).
Candidates are confirmed by counting the item's shingles in the whole document.

One pass reads the texts. It carries on only what can matter: shingles whose bit is set in a
bitmap of the items' shingles (2 MB whatever the input), which hold every shared one.

Defined cases: an item or document without words contains nothing and is never contained; one of
one to four words has one shingle, the whole sequence; rows with a null id take part and are
reported with a null id; of rows that share an id the largest overlap is reported; empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthgrid.llm import words
from depthgrid.llm.shared import BITMAP_BITS, anti_by_id, join_small, stored

BINS = 128
PERCENT = 75
#: Items of fewer shingles (a power of 2) are found by any shared shingle.
SMALL = 64

_U64 = np.uint64
_SHIFT = _U64(64 - BINS.bit_length() + 1)


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__item, __class, __set, __mins): the shingle set and its smallest value in each bin."""
    for batch in batches:
        for part in words.slices(batch, "__text"):
            sets = words.shingle_sets(part.column("__text"))
            # a set is sorted and a bin is its top bits, so a bin's first value is its smallest
            mins = [s if len(s) < SMALL else s[np.unique(s >> _SHIFT, return_index=True)[1]] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("__item"),
                    pa.array([max(len(s).bit_length() - 1, 0) for s in sets], pa.int32()),
                    words.list_column(sets),
                    words.list_column(mins),
                ],
                ["__item", "__class", "__set", "__mins"],
            )


def _block_minima(values, bounds, hits, rows, width):
    """Which of the hits are the smallest of their bin in their block of ``width`` shingles."""
    block = (hits - bounds[rows]) // width
    begin = bounds[rows] + block * width
    starts, which = np.unique(begin, return_inverse=True)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    sizes = np.minimum(starts + width, bounds[owner + 1]) - starts
    upto = np.cumsum(sizes)
    at = np.arange(upto[-1]) + np.repeat(starts - (upto - sizes), sizes)
    slot = np.repeat(np.arange(len(starts)), sizes) * BINS + (values[at] >> _SHIFT).astype(np.int64)
    least = np.full(len(starts) * BINS, np.iinfo(np.uint64).max, _U64)
    np.minimum.at(least, slot, values[at])
    own = which * BINS + (values[hits] >> _SHIFT).astype(np.int64)
    return least[own] == values[hits]


def _document_rows(bits, classes):
    """Map documents to (__row, __id, __probes, __keys): possible shared shingles, block minima."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            for part in words.slices(batch, "__text"):
                _, _, hashes, word_bounds = words.word_hashes(part.column("__text"))
                values, bounds = words.shingles(hashes, word_bounds)
                slot = values & _U64(BITMAP_BITS - 1)
                hits = np.flatnonzero((table[(slot >> _U64(6)).astype(np.int64)] >> (slot & _U64(63))) & _U64(1))
                if not len(hits):
                    continue
                rows = np.searchsorted(bounds, hits, side="right") - 1
                passed = [
                    hits if 1 << c < SMALL else hits[_block_minima(values, bounds, hits, rows, 2 << c)]
                    for c in classes
                ]
                kinds = np.repeat(np.array(classes, np.int32), [len(p) for p in passed])
                passed = np.concatenate(passed)
                keep = np.unique(rows)
                cuts = np.searchsorted(rows, keep[1:])
                probes = [np.unique(x) for x in np.split(values[hits], cuts)]
                owner = np.searchsorted(bounds, passed, side="right") - 1
                order = np.lexsort((values[passed], kinds, owner))
                passed, kinds, owner = passed[order], kinds[order], owner[order]
                fresh = np.ones(len(passed), bool)
                fresh[1:] = (
                    (owner[1:] != owner[:-1]) | (kinds[1:] != kinds[:-1])
                    | (values[passed][1:] != values[passed][:-1])
                )
                passed, kinds, owner = passed[fresh], kinds[fresh], owner[fresh]
                ends = np.searchsorted(owner, keep, side="right").astype(np.int32)
                key = pa.StructArray.from_arrays(
                    [pa.array(kinds), pa.array(values[passed].view(np.int64))], ["c", "v"]
                )
                chosen = pa.array(keep)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("__row").take(chosen),
                        part.column("__id").take(chosen),
                        words.list_column(probes),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), key),
                    ],
                    ["__row", "__id", "__probes", "__keys"],
                )

    return search


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", percent: int = PERCENT,
) -> DataFrame:
    """(``id_col``, ``item_col``, n_item, n_shared, containment) for each item held by a document.

    The result's items are named item_id if both id columns have the same name.
    """
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType.simpleString()
    id_type = docs.schema[id_col].dataType.simpleString()
    known = stored(
        items.select(F.col(item_col).alias("__item"), F.col(item_text_col).alias("__text"))
        .mapInArrow(
            _item_rows,
            f"__item {item_type}, __class int, __set array<bigint>, __mins array<bigint>",
        )
        .filter(F.size("__set") > 0)
        .withColumn("__no", F.monotonically_increasing_id())
    )
    # At most BITMAP_BITS / 64 numbers come to the driver, from the items alone.
    slot = F.col("v").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words_set = (
        known.select(F.explode("__set").alias("v"))
        .select(
            F.shiftright(slot, 6).cast("int").alias("w"),
            F.expr("shiftleft(1L, cast(v & 63 as int))").alias("b"),
        )
        .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    )
    table = np.zeros(BITMAP_BITS // 64, np.int64)
    table[words_set.column("w").to_numpy()] = words_set.column("b").to_numpy()
    classes = sorted(r[0] for r in known.select("__class").distinct().collect())  # at most 32
    bits = spark.sparkContext.broadcast(table.view(np.uint64))
    found = stored(
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
        .withColumn("__row", F.monotonically_increasing_id())
        .mapInArrow(
            _document_rows(bits, classes),
            f"__row bigint, __id {id_type}, __probes array<bigint>, "
            "__keys array<struct<c:int,v:bigint>>",
        )
    )
    index = known.select("__no", F.col("__class").alias("c"), F.explode("__mins").alias("v"))
    size, total = known.agg(F.sum(F.size("__mins")), F.sum(F.size("__set"))).first()
    keys = found.select("__row", F.explode("__keys").alias("k")).select("__row", "k.c", "k.v")
    pairs = join_small(keys, index, ["c", "v"], size or 0).select("__row", "__no").distinct()
    # Counted in shingles, so that what is broadcast is bounded in bytes too.
    held = join_small(pairs.join(found, "__row"), known, ["__no"], total or 0)
    shared = F.size(F.array_intersect("__probes", "__set"))
    name = item_col if item_col != id_col else "item_id"
    return (
        held.select("__id", "__item", F.size("__set").alias("__n"), shared.alias("__k"))
        .filter(F.col("__k") * 100 >= F.col("__n") * percent)
        .groupBy(F.col("__id").alias(id_col), F.col("__item").alias(name))
        .agg(F.max(F.struct((F.col("__k") / F.col("__n")).alias("c"), "__k", "__n")).alias("__m"))
        .select(
            id_col, name, F.col("__m.__n").cast("long").alias("n_item"),
            F.col("__m.__k").cast("long").alias("n_shared"), F.col("__m.c").alias("containment"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that hold an item; rows with a null id stay."""
    held = contained_items(docs, items, id_col)
    return anti_by_id(docs, stored(held.select(id_col).distinct(), docs.count()), id_col)
