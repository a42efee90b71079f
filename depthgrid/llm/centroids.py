"""Centroid clustering of integer vectors by scalar lookup tables.

Components become integers floor(SCALE * x). Vectors are stored once in blocks of at most
BLOCK_ROWS rows; a block holds, for each dimension, the integer values that occur in it and each
row's place among them. A round then tabulates the squared difference for every dimension,
occurring value and centroid, and the distances are gathers from these tables and sums; no
component is read again. Memory follows the block, whatever values occur.

The driver holds the centroids and, once a round, their componentwise sums: at most
centroids x dimensions numbers, added up by a grouped aggregate of one partial sum per task.

Defined cases: a vector that is null, has another length, or a null or non-finite component is
left out; equal distances go to the smaller centroid; an empty centroid stays where it is; with
fewer vectors than centroids there are as many centroids as vectors; repeated rows and ids count
each on their own, and equal hashes of the start are ordered by the vector; vectors with a null id
are clustered, and start a centroid only after all others; an empty table gives an empty table;
other columns are not read, so any name may occur. Integers beyond 2**62 are held at it, and sums
of distances that exceed a long at the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthgrid.llm.shared import stored

DIMS, CENTROIDS, ROUNDS, SCALE, START = 64, 40, 5, 256, "2:"
#: Rows of a block; their places fit 16 bits.
BLOCK_ROWS = 2048
#: Components up to this size keep every distance within 64 bits; larger ones use Python integers.
SAFE = 1 << 27
LIMIT = 1 << 62
LARGEST = (1 << 63) - 1
_LAST = "~"  # after every hexadecimal digit


def _integers(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the kept rows, their integer components)."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    fits = (np.diff(offsets) == dims) & column.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(fits)
    flat = column.values.to_numpy(zero_copy_only=False)  # a null component becomes NaN
    values = flat[offsets[rows][:, None] + np.arange(dims)].astype(float).reshape(len(rows), dims)
    finite = np.isfinite(values).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(SCALE * values[finite]), -float(LIMIT), float(LIMIT))
    return rows[finite], scaled.astype(np.int64)


@dataclass(frozen=True)
class Block:
    """Occurring values of each dimension, and each row's place among them (one row per dimension)."""

    values: list[np.ndarray]
    places: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray) -> Block:
        found = [np.unique(vectors[:, d], return_inverse=True) for d in range(vectors.shape[1])]
        places = np.array([p for _, p in found]).reshape(vectors.shape[1], len(vectors))
        return cls([v for v, _ in found], places.astype(np.uint16))

    @classmethod
    def read(cls, sizes, values, places: bytes) -> Block:
        ends = np.cumsum(sizes)
        return cls(
            np.split(np.asarray(values), ends[:-1]), np.frombuffer(places, np.uint16).reshape(len(sizes), -1)
        )

    @property
    def rows(self) -> int:
        return self.places.shape[1]

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance to it, for each row."""
        exact = centroids.dtype == object or any(len(v) and max(-v[0], v[-1]) > SAFE for v in self.values)
        tables = []
        for d, occurring in enumerate(self.values):
            if exact:
                occurring = occurring.astype(object)
            tables.append((occurring[:, None] - centroids[None, :, d]) ** 2)
        kind = object if exact else np.int64
        if not exact and sum(int(t.max()) for t in tables) < 1 << 31:
            kind = np.int32
        total = np.zeros((self.rows, centroids.shape[0]), kind)
        for table, place in zip(tables, self.places):
            total += table.astype(kind)[place]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(self.rows), cluster]

    def sums(self, cluster: np.ndarray, centroids: int) -> np.ndarray:
        """Exact componentwise sums per cluster, from how often each value occurs in it."""
        out = np.zeros((centroids, len(self.values)), object)
        for d, occurring in enumerate(self.values):
            width = len(occurring)
            held = np.bincount(cluster * width + self.places[d], minlength=centroids * width)
            held = held.reshape(centroids, width)
            if max(-occurring[0], occurring[-1]) > SAFE:
                held, occurring = held.astype(object), occurring.astype(object)
            out[:, d] = (held @ occurring).astype(object)
        return out


def _blocks(vectors: DataFrame, id_type: T.DataType, dims: int, centroids: int) -> DataFrame:
    """One row per block: ids, the block, and its rows of smallest hash as starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, integers = _integers(batch.column("__vector"), dims)
            ids = batch.column("__id").take(pa.array(rows))
            for begin in range(0, len(rows), BLOCK_ROWS):
                part = integers[begin : begin + BLOCK_ROWS]
                own = ids.slice(begin, len(part))
                marks = [
                    _LAST if i is None else hashlib.sha256(f"{START}{i}".encode()).hexdigest()
                    for i in own.to_pylist()
                ]
                order = sorted(range(len(part)), key=lambda r: (marks[r], part[r].tolist()))[:centroids]
                block = Block.of(part)
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "ids": own.to_pylist(),
                            "sizes": [len(v) for v in block.values],
                            "values": np.concatenate(block.values).tolist(),
                            "places": block.places.tobytes(),
                            "starts": [{"mark": marks[r], "vector": part[r].tolist()} for r in order],
                        }
                    ],
                    schema=pa.schema(
                        [
                            ("ids", pa.list_(own.type)),
                            ("sizes", pa.list_(pa.int32())),
                            ("values", pa.list_(pa.int64())),
                            ("places", pa.binary()),
                            ("starts", pa.list_(pa.struct([("mark", pa.string()), ("vector", pa.list_(pa.int64()))]))),
                        ]
                    ),
                )

    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("values", T.ArrayType(T.LongType())),
            T.StructField("places", T.BinaryType()),
            T.StructField(
                "starts",
                T.ArrayType(
                    T.StructType(
                        [T.StructField("mark", T.StringType()), T.StructField("vector", T.ArrayType(T.LongType()))]
                    )
                ),
            ),
        ]
    )
    return vectors.mapInArrow(run, schema)


def _each_block(batch: pa.RecordBatch) -> Iterator[tuple[int, Block]]:
    sizes, values = batch.column("sizes"), batch.column("values")
    for i in range(batch.num_rows):
        yield i, Block.read(
            sizes[i].values.to_numpy(), values[i].values.to_numpy(), batch.column("places")[i].as_py()
        )


def _as_array(centroids: list[list[int]]) -> np.ndarray:
    large = any(abs(x) > SAFE for c in centroids for x in c)
    return np.array(centroids, object if large else np.int64)


def _moved(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every vector to its nearest centroid, then the floor of each cluster's means."""
    places = _as_array(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(places), np.int64), np.zeros(places.shape, object)
        for batch in batches:
            for _, block in _each_block(batch):
                cluster, _ = block.nearest(places)
                count += np.bincount(cluster, minlength=len(places))
                total += block.sums(cluster, len(places))
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(np.repeat(held, places.shape[1]).astype(np.int32)),
                "dim": pa.array(np.tile(np.arange(places.shape[1], dtype=np.int32), len(held))),
                "n": pa.array(np.repeat(count[held], places.shape[1])),
                "total": pa.array([str(int(x)) for x in total[held].ravel()], pa.string()),
            }
        )

    summed = (
        blocks.mapInArrow(run, "cluster int, dim int, n long, total string")
        .groupBy("cluster", "dim")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()  # centroids x dimensions rows
    )
    following = [list(c) for c in centroids]
    for row in summed:
        following[row["cluster"]][row["dim"]] = int(row["total"]) // row["n"]
    return following


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_vectors(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = DIMS,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id, cluster, distance, cluster_size, cluster_inertia, inertia, centroid, centroid_sha256)
    of every kept vector; the last columns repeat the facts of its cluster.
    """
    spark = table.sparkSession
    id_type = table.schema[id_col].dataType
    narrow = table.select(
        F.col(id_col).alias("__id"), F.col(vector_col).cast("array<double>").alias("__vector")
    )
    blocks = stored(_blocks(narrow, id_type, dims, centroids))
    starts = (
        blocks.select(F.inline("starts")).orderBy("mark", "vector").limit(centroids).collect()
    )
    found = [list(row["vector"]) for row in starts]
    for _ in range(rounds if found else 0):
        found = _moved(blocks, found)
    places = _as_array(found or [[0] * dims])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in _each_block(batch):
                cluster, distance = block.nearest(places)
                if distance.dtype == object:
                    distance = np.array([min(int(d), LARGEST) for d in distance], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values,
                        pa.array(cluster.astype(np.int32)),
                        pa.array(distance.astype(np.int64)),
                    ],
                    [id_col, "cluster", "distance"],
                )

    schema = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ]
    )
    assigned = stored(blocks.select("ids", "sizes", "values", "places").mapInArrow(run, schema))
    held = (
        assigned.groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
        .collect()  # a row per centroid
    )
    whole = min(sum(int(row["inertia"]) for row in held), LARGEST)
    facts = spark.createDataFrame(
        [
            (row["cluster"], row["n"], min(int(row["inertia"]), LARGEST), whole, found[row["cluster"]],
             centroid_digest(found[row["cluster"]]))
            for row in held
        ],
        "cluster int, cluster_size long, cluster_inertia long, inertia long, centroid array<long>, "
        "centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        id_col, "cluster", "distance", *[c for c in facts.columns if c != "cluster"]
    )
