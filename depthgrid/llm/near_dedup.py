"""Near copies by one-permutation hashing with optimal densification and star-shaped candidates.

Steps, all on narrow rows:

1. Each text becomes its set of five-word shingles and one sketch: a single hash per shingle, the
   top bits choose one of 128 bins, a bin keeps its smallest value, an empty bin borrows from the
   bin that its own fixed random sequence meets first (optimal densification).
2. Documents with the same set share a class; only one sketch per class goes on.
3. Sketches are cut into 32 bands of 4 bins; each band is a bucket. A pair at similarity 0.75
   misses every common bucket with probability about 5e-6, at 0.85 with about 6e-11.
4. Each bucket gives a star, (smallest id, member), so a bucket of n members gives n - 1 edges.
   Edges are confirmed on the full sets.
5. Confirmed edges give components. What no star compared are pairs in one bucket but in different
   components. The buckets that still hold several components are joined into groups, a group's
   sets are dealt into blocks of bounded size by set size, and every two blocks whose sizes allow
   a link are compared in one task, by exact intersections. A block pair returns a spanning
   forest of its links, so rows never grow with the square of a group, and no link found in a
   bucket is lost. Pairs inside a component are not expanded.

Defined cases: a null or empty text has no shingles and no links; a text of one to four words
has one shingle, the whole sequence; a row with a null id gets its set size, a null component and
is kept; an id is one document, so where rows with one id differ in text their links join, those
of the smallest text being confirmed; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthgrid.llm import words
from depthgrid.llm.components import components
from depthgrid.llm.shared import anti_by_id, counted, gathered, semi_by_id, stored

BINS, ROWS = 128, 4
BANDS = BINS // ROWS
PROBES = 512
#: Members and shingles of a block, and columns of its incidence matrix that are held at once.
BLOCK_SETS, BLOCK_SHINGLES, COLUMNS = 256, 1 << 18, 1 << 13

_U64 = np.uint64
_EDGES = np.arange(BINS, dtype=_U64) << _U64(64 - BINS.bit_length() + 1)
_DRAWS = (
    words.mix(np.arange(BINS * PROBES, dtype=_U64) + _U64(1 << 40)) % _U64(BINS)
).astype(np.int64).reshape(BINS, PROBES)
_BAND = words.mix(np.arange(BINS, dtype=_U64) + _U64(1 << 41)) | _U64(1)


def sketch(values: np.ndarray) -> np.ndarray:
    """Densified one-permutation sketch of a sorted, non-empty set of 64-bit hashes."""
    first = np.searchsorted(values, _EDGES)
    upto = np.append(first[1:], len(values))
    filled = upto > first
    out = values[np.minimum(first, len(values) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        hits = filled[_DRAWS[empty]]
        draw = hits.argmax(axis=1)
        source = _DRAWS[empty, draw]
        lost = ~hits[np.arange(len(empty)), draw]
        if lost.any():  # no draw met a filled bin: the next filled one, cyclically
            where = np.flatnonzero(filled)
            source[lost] = where[np.searchsorted(where, empty[lost]) % len(where)]
        out = out.copy()
        out[empty] = out[source]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = (signature * _BAND).reshape(BANDS, ROWS).sum(axis=1, dtype=_U64)
    return words.mix(parts + np.arange(BANDS, dtype=_U64))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.slices(batch, "__text"):
            sets = words.shingle_sets(part.column("__text"))
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            buckets = [band_keys(sketch(s)) if len(s) else s for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("__id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary()),
                    words.list_column(buckets),
                ],
                ["__id", "__n", "__key", "__buckets"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.slices(batch, "__text"):
            sets = words.shingle_sets(part.column("__text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("__id"), words.list_column(sets)], ["__id", "__set"]
            )


def shingle_table(docs: DataFrame) -> DataFrame:
    """(__id, __set) from (__id, __text): each text's distinct shingle hashes."""
    kind = docs.schema["__id"].dataType.simpleString()
    return docs.select("__id", "__text").mapInArrow(_sets, f"__id {kind}, __set array<bigint>")


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("__id").alias("a"), F.col("__set").alias("__sa"))
    right = sets.select(F.col("__id").alias("b"), F.col("__set").alias("__sb"))
    shared = F.size(F.array_intersect("__sa", "__sb"))
    union = F.size("__sa") + F.size("__sb") - shared
    # b varies within a star, so its sets are spread; the set of a hot centre a comes last,
    # where AQE can split the many rows that wait for it.
    return (
        edges.join(right, "b").join(left, "a")
        .filter(shared * 100 >= union * percent).select("a", "b")
    )


def _fits(n: str, m: str, percent: int):
    """Sizes alone allow the similarity."""
    return (F.least(n, m) * 100) >= (F.greatest(n, m) * percent)


def link_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id, kept.

    ``percent`` is the least similarity, 75 or more, for which the bands are laid out.
    """
    if percent < 75:
        raise ValueError("the bands are laid out for 75 per cent or more")
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    kind = source.schema["__id"].dataType.simpleString()
    rows, n_rows = counted(
        source.mapInArrow(
            _sketches, f"__id {kind}, __n bigint, __key binary, __buckets array<bigint>"
        )
    )
    # 2. one representative per distinct set
    classes, n_classes = counted(
        rows.filter("__key is not null and __id is not null")
        .groupBy("__key")
        .agg(F.min("__id").alias("rep"), F.first("__n").alias("n"), F.first("__buckets").alias("__buckets")),
        n_rows,
    )
    # 3. buckets with at least two classes
    members = classes.select("rep", "n", F.explode("__buckets").alias("bucket"))
    # Stored, so that the join shuffles both sides and AQE can split the rows of a large bucket.
    heads = stored(
        members.groupBy("bucket")
        .agg(F.min(F.struct("rep", "n")).alias("head"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1"),
        n_classes * BANDS // 2,
    )
    crowded, n_crowded = counted(
        members.join(heads, "bucket").select(
            "bucket", "rep", "n", "size", F.col("head.rep").alias("a"), F.col("head.n").alias("an")
        ),
        n_classes * BANDS,
    )
    # 4. stars around the smallest id, confirmed on full sets
    stars = crowded.filter((F.col("rep") != F.col("a")) & _fits("n", "an", percent))
    edges, n_edges = counted(stars.select("a", F.col("rep").alias("b")).distinct(), n_crowded)
    ids = edges.select(F.col("a").alias("__id")).union(edges.select("b"))
    open_buckets = crowded.filter("size > 2")
    ids = stored(ids.union(open_buckets.select("rep")).distinct(), n_classes)
    texts = semi_by_id(source, ids, "__id").groupBy("__id").agg(F.min("__text").alias("__text"))
    sets = stored(shingle_table(texts))
    links, n_links = counted(_confirmed(edges, sets, percent), n_edges)
    labels = stored(components(links, at_most=n_links), 2 * n_links)
    # 5. what the stars left over
    found, n_found = counted(_rest(open_buckets, labels, sets, n_crowded, percent), n_crowded)
    if n_found:
        links, n_links = links.union(found), n_links + n_found
        labels = stored(components(links, at_most=n_links), 2 * n_links)
    groups = (
        classes.select("__key", "rep")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("__key", F.coalesce("label", "rep").alias("label"))
    )
    # A row without a key joins nothing; it gets a key of its own to stay out of one task.
    own = F.coalesce("__key", F.concat(F.lit("-"), F.col("__id").cast("string")).cast("binary"))
    joined = rows.select("__id", "__n", own.alias("__key")).join(groups, "__key", "left")
    joined = gathered(joined, n_rows)
    component = F.when(F.col("__id").isNotNull(), F.coalesce("label", "__id"))
    return joined.select(
        F.col("__id").alias(id_col),
        F.col("__n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("__id"), F.lit(True)).alias("kept"),
    )


def _rest(
    buckets: DataFrame, labels: DataFrame, sets: DataFrame, at_most: int, percent: int
) -> DataFrame:
    """Links (a, b) between different components that share a bucket."""
    named = buckets.select("bucket", "rep", "n", "a").join(
        labels.withColumnRenamed("node", "rep"), "rep", "left"
    ).withColumn("label", F.coalesce("label", "rep"))
    several = named.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    several = stored(several.filter("x <> y").select("bucket"), at_most)
    mixed = stored(named.join(several, "bucket", "left_semi"), at_most)
    edges, n_edges = counted(mixed.select("a", F.col("rep").alias("b")).distinct(), at_most)
    groups = components(edges, at_most=n_edges).select(
        F.col("node").alias("rep"), F.col("label").alias("group")
    )
    # Classes of sizes half as wide as a link allows: linked sets are at most two classes apart.
    step = math.log(100 / percent) / 2
    member = (
        mixed.select("rep", "n", "label").distinct().join(groups, "rep")
        .withColumn("class", F.floor(F.log("n") / step))
    )
    fit = F.greatest(F.lit(1), F.least(F.lit(BLOCK_SETS), F.floor(BLOCK_SHINGLES / F.max("n"))))
    counts = member.groupBy("group", "class").agg(
        F.ceil(F.count(F.lit(1)) / fit).cast("long").alias("blocks")
    )
    counts = stored(counts, at_most)
    member = stored(
        member.join(counts, ["group", "class"])
        .withColumn("block", F.struct("class", F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("no")))
        .select("rep", "n", "label", "group", "block"),
        at_most,
    )
    blocks = stored(
        member.groupBy("group", F.col("block").alias("other")).agg(F.count(F.lit(1)).alias("k")), at_most
    )
    near = F.abs(F.col("block.class") - F.col("other.class")) <= 2
    # A set goes to each pair of its block and another: group size / block size copies of it.
    dealt = member.join(blocks.drop("k"), "group").filter(near).select(
        "group", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        (F.col("block") > F.col("other")).alias("second"), F.col("rep").alias("__id"), "label",
    )
    whole = dealt.join(sets, "__id")
    kind = sets.schema["__id"].dataType.simpleString()
    return whole.groupBy("group", "x", "y").applyInArrow(_block_links(percent), f"a {kind}, b {kind}")


def _shared(values: np.ndarray, owner: np.ndarray, size: int, first: np.ndarray, second: np.ndarray):
    """Sizes of the intersections of the ``first`` with the ``second`` of ``size`` sets."""
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    often = count > 1
    number = np.cumsum(often) - 1
    use = often[column]
    column, owner = number[column[use]], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(first), len(second)), np.float32)
    for begin in range(0, int(often.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [begin, begin + COLUMNS])
        dense = np.zeros((size, COLUMNS), np.float32)
        dense[owner[lo:hi], column[lo:hi] - begin] = 1
        out += dense[first] @ dense[second].T
    return out.astype(np.int64)


def _block_links(percent: int):
    """Compare two blocks (or one with itself) and return a spanning forest of new links."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, sets = table.column("__id"), table.column("__set").combine_chunks()
        label, second = table.column("label").to_pylist(), table.column("second").to_numpy()
        values, sizes = sets.flatten().to_numpy(), pa.compute.list_value_length(sets).to_numpy()
        owner = np.repeat(np.arange(len(sizes)), sizes)
        first, other = np.flatnonzero(~second), np.flatnonzero(second)
        if not len(other) or not len(first):
            first = other = np.arange(len(sizes))
            alone = table.column("x")[0].as_py() == table.column("y")[0].as_py()
            if not alone:
                return table.select(["__id", "__id"]).rename_columns(["a", "b"]).slice(0, 0)
        shared = _shared(values, owner, len(sizes), first, other)
        union = sizes[first][:, None] + sizes[other][None, :] - shared
        tree: dict = {}

        def root(x):
            while x in tree:
                x = tree[x]
            return x

        kept = []
        for i, j in zip(*np.nonzero((shared * 100 >= union * percent) & (shared > 0))):
            i, j = first[i], other[j]
            x, y = root(label[i]), root(label[j])
            if x != y:
                tree[x] = y
                kept.append((i, j))
        chosen = np.array(kept, np.int64).reshape(-1, 2)
        return pa.table({"a": ids.take(pa.array(chosen[:, 0])), "b": ids.take(pa.array(chosen[:, 1]))})

    return run


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id."""
    found = link_components(docs, id_col, text_col)
    dropped = stored(found.filter("not kept").select(id_col).distinct(), docs.count())
    return anti_by_id(docs, dropped, id_col)
