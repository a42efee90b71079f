import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from depthgrid.llm import warc

SCHEMA = "page_id long, url string, html string"


def rows():
    out = [(i, f"http://h/{i}", f"<p>page {i} é {'z' * (i * 37 % 900)}</p>") for i in range(200)]
    out += [(1000 + i, f"http://c/{i}", "<p>copy</p>") for i in range(30)]
    out += [(2000, None, None), (2001, "http://e/\r\nX: y", ""), (2002, "u", "a\r\n\r\nWARC/1.1\r\n")]
    return out


def written(spark, table, **options):
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(spark.createDataFrame(table, SCHEMA), folder, **options)
    return folder, manifest


def expected(table, least=0):
    out, groups = {}, {}
    for key, _, body in table:
        groups.setdefault((body or "").encode(), []).append(key)
    for payload, keys in groups.items():
        for key in keys:
            again = key != max(keys) and len(payload) >= least
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            out[key] = (len(payload), digest, "revisit" if again else "response", max(keys) if again else None)
    return out


def facts(records):
    return {
        r.record_key: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in records.collect()
    }


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip(spark, least):
    table = rows()
    folder, manifest = written(spark, table, least_bytes=least, shard_bytes=9_000, roll_bytes=2_000)
    records = warc.read_archives(spark, folder)
    assert facts(records) == expected(table, least)
    bodies = {r.record_key: r.payload for r in records.filter("record_type = 'response'").collect()}
    for key, _, body in table:
        if key in bodies:
            assert bodies[key] == (body or "").encode()
    files = manifest.collect()
    assert len({f.shard for f in files}) > 3 and any(f.roll > 0 for f in files)
    assert sum(f.records for f in files) == len(table)


def test_files_are_whole_sorted_and_the_same_again(spark):
    table = rows()
    digests = []
    for order in (table, table[::-1]):
        folder, manifest = written(spark, order, shard_bytes=9_000, roll_bytes=2_000)
        digests.append({f.name: f.sha256 for f in manifest.collect()})
        keys = []
        for name in sorted(digests[-1]):
            with open(f"{folder}/{name}", "rb") as file:
                raw = file.read()
            assert hashlib.sha256(raw).hexdigest() == digests[-1][name]
            plain = gzip.decompress(raw)
            assert plain.startswith(b"WARC/1.1\r\n")
            keys += [int(x.split(b"\r\n")[0]) for x in plain.split(b"\r\nX-Record-Key: ")[1:]]
        assert keys == sorted(keys)
    assert digests[0] == digests[1]


def test_files_outside_the_manifest_are_not_read(spark):
    folder, _ = written(spark, rows()[:5])
    for stray in ("shard-99999999-0000.warc.gz", "_temporary/lost.warc.gz"):
        with open(f"{folder}/{stray}", "wb") as file:
            file.write(b"broken")
    assert warc.read_archives(spark, folder).count() == 5


def test_damage_is_noticed(spark):
    record = warc.build_record(1, "u", b"hello", 5, warc.base32(hashlib.sha1(b"hello").digest()), None, None)
    assert warc.parse_record(record)["payload"] == b"hello"
    for broken in (record.replace(b"hello", b"hellO"), record[:-3], record.replace(b"1.1\r\nWARC-T", b"1.0\r\nWARC-T")):
        with pytest.raises(ValueError):
            warc.parse_record(broken)


def test_repeated_commit_is_harmless(spark):
    folder, manifest = written(spark, rows()[:9])
    again = manifest.mapInArrow(warc._commit(folder), warc._MANIFEST)
    assert again.count() == manifest.count()
    os.remove(f"{folder}/{manifest.first().name}")
    with pytest.raises(Exception, match="manifest"):
        manifest.mapInArrow(warc._commit(folder), warc._MANIFEST).count()


def test_nulls_repeats_other_columns_and_empty_tables(spark):
    table = [(None, "n", "same"), (3, "a", "same"), (3, "a", "same"), (2, "b", "same"), (None, "m", "alone"), (None, "m", "alone")]
    docs = spark.createDataFrame(table, SCHEMA).withColumn("name", F.lit("x")).withColumn("__shard2", F.lit(1))
    folder = warc.archive_folder(spark)
    warc.write_archives(docs, folder)
    got = sorted(
        (r.record_key or -1, r.record_type, r.refers_to or -1) for r in warc.read_archives(spark, folder).collect()
    )
    assert got == [
        (-1, "response", -1), (-1, "response", -1), (-1, "revisit", 3), (2, "revisit", 3),
        (3, "response", -1), (3, "response", -1),
    ]
    folder, manifest = written(spark, [])
    assert manifest.count() == 0 and warc.read_archives(spark, folder).count() == 0


def test_long_payload(spark):
    table = [(1, "u", "é" * 3_000_000), (2, "u", "é" * 3_000_000), (3, "u", "b")]
    folder, _ = written(spark, table, shard_bytes=1 << 20, roll_bytes=1 << 10)
    assert facts(warc.read_archives(spark, folder, with_payload=False)) == expected(table)
