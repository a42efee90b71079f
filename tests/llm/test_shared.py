import pytest
from pyspark.sql import functions as F

from depthgrid.llm import shared


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text")).union(
        spark.createDataFrame([(None, "null")], "doc_id long, text string")
    )


def test_bitmap_is_bounded_and_has_no_false_misses(spark, rows, monkeypatch):
    monkeypatch.setattr(shared, "BITMAP_BITS", 1 << 9)
    ids = spark.range(0, 5000, 7).select(F.col("id").alias("doc_id"))
    bits = shared.bitmap(ids, ["doc_id"])
    assert bits.count() <= (1 << 9) // 64
    marked = shared.mark(rows, bits, ["doc_id"], "hit")
    assert marked.filter("doc_id % 7 = 0 and not hit").count() == 0


@pytest.mark.parametrize("bits", [1 << 8, 1 << 24])
def test_semi_and_anti_are_exact_at_any_size(spark, rows, monkeypatch, bits):
    monkeypatch.setattr(shared, "BITMAP_BITS", bits)
    ids = spark.range(0, 9000, 7).select(F.col("id").alias("doc_id"))
    kept = shared.semi_by_id(rows, ids, "doc_id")
    rest = shared.anti_by_id(rows, ids, "doc_id")
    assert kept.columns == rest.columns == rows.columns
    assert {r.doc_id for r in kept.collect()} == set(range(0, 5000, 7))
    assert {r.doc_id for r in rest.collect()} == {i for i in range(5000) if i % 7} | {None}
    none = ids.filter("false")
    assert shared.semi_by_id(rows, none, "doc_id").count() == 0
    assert shared.anti_by_id(rows, none, "doc_id").count() == 5001


def test_marks_read_one_bounded_broadcast_and_shuffle_nothing(spark, rows):
    bits = shared.stored(shared.bitmap(rows.select("doc_id"), ["doc_id"]))
    plan = shared.mark(rows, bits, ["doc_id"], "hit")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_known_sizes_decide_the_files(spark):
    table, n = shared.counted(spark.range(10).repartition(7), 10)
    assert n == 10 and len(table.inputFiles()) == 1
    assert len(shared.stored(spark.range(1000).repartition(7)).inputFiles()) == 7
