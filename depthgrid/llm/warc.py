"""WARC archives: a deterministic sharded writer and a reader that checks what it reads.

Writing
1. One narrow pass takes size and SHA-1 of every payload. Of equal payloads of ``least_bytes``
   bytes or more the record with the largest key is the response, the others become revisits.
2. A running sum of sizes in key order, over a stored range sort, cuts the keys into shards of
   about ``shard_bytes``. The cuts depend on the rows alone, not on Spark's sampling, so equal
   input gives equal files on any cluster.
3. Each shard's records go to one task in key order. Headers and digests are made anew, each
   record is its own gzip member, and a file is closed once it holds ``roll_bytes`` compressed.
4. Files are written under a temporary name of the task attempt. The rows of the attempts that
   succeeded form the manifest; its files are then renamed, which can be repeated, and the
   manifest is written last. Files outside the manifest are never read.

Reading streams each file of the manifest, checks lengths, block and payload digests, and returns
one row per record.

Files are opened through Arrow's file systems from the folder's address, so the folder may be any
that all executors reach and Arrow supports.

Defined cases: a null payload is empty; a null address gives an empty header; rows with a null key
come first and are never referred to, and if all equal payloads have null keys all are responses;
rows that repeat a response's key and payload are responses too; an empty table gives a manifest
without files and no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depthgrid.llm.shared import stored
from depthgrid.session import fresh_path

SHARD_BYTES, ROLL_BYTES, LEVEL = 32 << 20, 16 << 20, 5
DATE = "2026-01-01T00:00:00Z"
CHUNK = 1 << 20

_MANIFEST = (
    "name string, temporary string, shard bigint, roll int, records bigint, bytes bigint, "
    "sha256 string"
)
_RECORD = (
    "record_key bigint, record_type string, target_uri string, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, file string, payload binary"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}:{digest}')}>"


def _line(value: str | None) -> str:
    """A header value: line breaks would end the header early."""
    return " ".join((value or "").split())


def build_record(key, url, payload, size, digest, refers_to, refers_uri) -> bytes:
    """One record, uncompressed; ``payload`` is None for a revisit of ``refers_to``."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    block = http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: {record_id(key, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if key is not None:
        head.append(f"X-Record-Key: {key}")
    if payload is None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"WARC-Refers-To-Target-URI: {_line(refers_uri)}",
            f"WARC-Refers-To-Date: {DATE}",
            f"X-Refers-To-Key: {refers_to}",
        ]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Roller:
    """The open file of one task attempt."""

    def __init__(self, folder: str, roll_bytes: int):
        self.system, self.base = fs.FileSystem.from_uri(folder)
        self.attempt = f"_temporary/{uuid.uuid4().hex}"
        self.system.create_dir(f"{self.base}/{self.attempt}", recursive=True)
        self.roll_bytes, self.stream, self.shard, self.roll = roll_bytes, None, None, 0

    def add(self, shard: int, member: bytes) -> list[tuple]:
        done = []
        if self.stream is not None and (shard != self.shard or self.bytes >= self.roll_bytes):
            done.append(self.close())
            self.roll = self.roll + 1 if shard == self.shard else 0
        if self.stream is None:
            self.roll = 0 if shard != self.shard else self.roll
            self.shard, self.bytes, self.records = shard, 0, 0
            self.name = f"shard-{shard:08d}-{self.roll:04d}.warc.gz"
            self.digest = hashlib.sha256()
            self.stream = self.system.open_output_stream(
                f"{self.base}/{self.attempt}/{self.name}", compression=None  # not by the name
            )
        self.stream.write(member)
        self.digest.update(member)
        self.bytes += len(member)
        self.records += 1
        return done

    def close(self) -> tuple:
        self.stream.close()
        self.stream = None
        return (
            self.name, f"{self.attempt}/{self.name}", self.shard, self.roll, self.records, self.bytes,
            self.digest.hexdigest(),
        )


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    names = [part.split()[0] for part in _MANIFEST.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _write(folder: str, roll_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, decision = None, ()
        names = ("__shard", "__key", "__sha", "__kind", "__url", "__body", "__size", "__to", "__to_url")
        for batch in batches:
            columns = [batch.column(c) for c in names]
            for n in range(batch.num_rows):
                shard, key, sha, kind, url, body, size, to, to_url = (c[n].as_py() for c in columns)
                if kind == 0:
                    decision = (key, sha, to, to_url)
                    continue
                roller = roller or _Roller(folder, roll_bytes)
                revisit = decision[:2] == (key, sha)
                payload = None if revisit else (body or "").encode("utf-8")
                to, to_url = decision[2:] if revisit else (None, None)
                record = build_record(key, url, payload, size, base32(bytes.fromhex(sha)), to, to_url)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                done = roller.add(shard, packer.compress(record) + packer.flush())
                if done:
                    yield _manifest_batch(done)
        if roller is not None:
            yield _manifest_batch([roller.close()])

    return run


def _commit(folder: str):
    """Give the manifest's files their names; a repeated attempt finds them in place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                final, temporary = f"{base}/{row['name']}", f"{base}/{row['temporary']}"
                if system.get_file_info(temporary).type != fs.FileType.NotFound:
                    system.move(temporary, final)
                if system.get_file_info(final).size != row["bytes"]:
                    raise OSError(f"{final} is not the file of the manifest")
            yield batch

    return run


def _key_cuts(facts: DataFrame, shard_bytes: int) -> list[int]:
    """First keys of all shards but the first, by a running sum of sizes in key order."""
    placed = stored(
        facts.filter("__key is not null").select("__key", "__size")
        .orderBy("__key", "__size").withColumn("__at", F.monotonically_increasing_id())
    )
    part = F.shiftright("__at", 33)
    sums = {
        r[0]: r[1] for r in placed.groupBy(part).agg(F.sum("__size")).collect()
    }  # a number per partition
    offsets, total = [], 0
    for p in sorted(sums):
        offsets.append((int(p), total))
        total += sums[p]
    if total <= shard_bytes:
        return []
    table = placed.sparkSession.createDataFrame(offsets, "__part long, __offset long")

    # a stored partition's rows, as many as one sort task holds
    upto = Window.partitionBy("__part").orderBy("__at")
    start = F.col("__offset") + F.sum("__size").over(upto) - F.col("__size")
    ordered = (
        placed.withColumn("__part", part).join(F.broadcast(table), "__part")
        .select("__key", F.floor(start / shard_bytes).alias("__shard"))
    )
    # a number per shard
    cuts = ordered.groupBy("__shard").agg(F.min("__key").alias("k")).orderBy("__shard").collect()
    return [r["k"] for r in cuts if r["__shard"] > 0]


def write_archives(
    pages: DataFrame, folder: str, key_col: str = "page_id", url_col: str = "url",
    body_col: str = "html", least_bytes: int = 0, shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES, level: int = LEVEL,
) -> DataFrame:
    """Write the archives under ``folder`` and return the committed manifest."""
    body = F.coalesce(F.col(body_col), F.lit(""))
    rows = pages.select(
        F.col(key_col).cast("long").alias("__key"), F.col(url_col).alias("__url"), body.alias("__body"),
        F.octet_length(body).cast("long").alias("__size"), F.sha1(F.encode(body, "UTF-8")).alias("__sha"),
    )
    facts = stored(rows.select("__key", "__url", "__size", "__sha"))
    groups = stored(
        facts.filter(F.col("__size") >= least_bytes).groupBy("__sha")
        .agg(F.max(F.struct("__key", "__url")).alias("best"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and best.__key is not null")
        .select("__sha", F.col("best.__key").alias("__best"), F.col("best.__url").alias("__best_url"))
    )
    # A revisit's decision is a narrow row that sorts right before its page, in the same task,
    # so pages are shuffled once and never joined.
    decided = facts.join(groups, "__sha").filter(~F.col("__key").eqNullSafe(F.col("__best")))
    decisions = decided.select(
        "__key", "__sha", F.lit(0).alias("__kind"), F.lit(None).cast("string").alias("__url"),
        F.lit(None).cast("string").alias("__body"), "__size", F.col("__best").alias("__to"),
        F.col("__best_url").alias("__to_url"),
    ).distinct()
    bodies = rows.select(
        "__key", "__sha", F.lit(1).alias("__kind"), "__url", "__body", "__size",
        F.lit(None).cast("long").alias("__to"), F.lit(None).cast("string").alias("__to_url"),
    )
    cuts = np.array(_key_cuts(facts, shard_bytes), np.int64)

    @F.pandas_udf("long")
    def shard_of(key: pd.Series) -> pd.Series:
        known = key.notna().to_numpy()
        out = np.zeros(len(key), np.int64)
        out[known] = np.searchsorted(cuts, key[known].astype("int64"), side="right")
        return pd.Series(out)

    manifest = stored(
        decisions.union(bodies).withColumn("__shard", shard_of("__key"))
        .repartition(len(cuts) + 1, "__shard")
        .sortWithinPartitions("__shard", "__key", "__sha", "__kind", "__url")
        .mapInArrow(_write(folder, roll_bytes, level), _MANIFEST)
    )
    manifest.mapInArrow(_commit(folder), _MANIFEST).write.parquet(f"{folder}/_manifest")
    return pages.sparkSession.read.schema(_MANIFEST).parquet(f"{folder}/_manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, each decompressed whole."""
    unpacker, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(CHUNK)
        if not data:
            break
        parts.append(unpacker.decompress(data))
        rest = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends inside a record")


def parse_record(record: bytes) -> dict:
    """A record's fields; raises where a length or digest does not hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    block = rest[:size]
    if lines[0] != "WARC/1.1" or len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    if fields["WARC-Block-Digest"] != "sha1:" + base32(hashlib.sha1(block).digest()):
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(http.decode("latin-1").rpartition("Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = fields["WARC-Type"] == "response"
    if whole and (stated != len(payload) or digest != base32(hashlib.sha1(payload).digest())):
        raise ValueError("payload digest differs")
    key, to = fields.get("X-Record-Key"), fields.get("X-Refers-To-Key")
    return {
        "record_key": None if key is None else int(key), "record_type": fields["WARC-Type"],
        "target_uri": fields.get("WARC-Target-URI", ""), "payload_bytes": stated,
        "payload_digest": digest, "refers_to": None if to is None else int(to),
        "payload": payload if whole else None,
    }


def _read(folder: str, with_payload: bool):
    schema = pa.schema([
        ("record_key", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
        ("file", pa.string()), ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for record in members(stream):
                        row = parse_record(record)
                        row["file"] = name
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(record) if with_payload else 300
                        if held >= CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the manifest's files; ``payload`` is null for revisits."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/_manifest")
    # a task per file: the file names are few and short, the files are not
    names = manifest.select("name", "shard", "roll").repartition(max(manifest.count(), 1), "shard", "roll")
    return names.mapInArrow(_read(folder, with_payload), _RECORD)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives below the cluster's shared one."""
    return fresh_path(spark)
