"""Quality scores: parts against plain versions, the whole against held-out labels."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from depthgrid.llm import quality

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels).withColumn("held", quality.held_out(F.col("__id")))
    rows = got.join(labels, got["__id"] == labels["doc_id"]).filter("held").select("__score", "quality").collect()
    assert len(rows) > 1000
    for side in (0, 1):
        own = [r for r in rows if r.quality == side]
        assert sum((r["__score"] >= 0.5) == (side == 1) for r in own) / len(own) > 0.97
    assert all(0 <= r["__score"] <= 1 for r in rows)


def test_fold_of_an_id(spark):
    rows = spark.range(50).select("id", quality.held_out(F.col("id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_statistics_by_hand():
    text = "Aa bb. aa\nbb cc aa\nAa bb. aa\n"
    row = dict(zip(quality.NAMES, quality.statistics(pa.array([None, text, ""]))[1]))
    n = len(text)
    assert row["share_upper"] == pytest.approx(2 / n) and row["share_line"] == pytest.approx(3 / n)
    assert row["log_words"] == pytest.approx(np.log1p(9))
    assert row["distinct_words"] == pytest.approx(4 / 9)  # aa bb. bb cc, case folded
    assert row["top_word"] == pytest.approx(5 / 9)
    assert row["distinct_lines"] == pytest.approx(2 / 3)
    assert row["ended_words"] == pytest.approx(2 / 9)
    assert not quality.statistics(pa.array([None, ""])).any()


def test_statistics_do_not_depend_on_neighbours():
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab C.!\n 1é") for _ in range(draw.randint(0, 300))) for _ in range(40)]
    texts[7] = "word " * 400_000  # over a block of bytes
    whole = quality.statistics(pa.array(texts))
    for i in (0, 6, 7, 8, 39):
        assert whole[i] == pytest.approx(quality.statistics(pa.array([texts[i]]))[0])


def test_isotonic_is_the_best_rising_fit():
    draw = random.Random(2)
    for _ in range(30):
        n = draw.randint(1, 12)
        counts = np.array([draw.randint(1, 5) for _ in range(n)], float)
        hits = np.array([draw.randint(0, int(c)) for c in counts], float)
        points, levels = quality.isotonic(np.arange(n, dtype=float), counts, hits)
        got = np.interp(np.arange(n), points, levels)
        assert (np.diff(got) >= -1e-12).all()
        # min-max formula of the isotonic fit
        for i in range(n):
            best = max(min(hits[a : b + 1].sum() / counts[a : b + 1].sum() for b in range(i, n)) for a in range(i + 1))
            assert got[i] == pytest.approx(best)


def test_sums_over_partitions_give_the_plain_ridge(spark):
    draw = np.random.default_rng(3)
    stats = draw.normal(size=(300, len(quality.NAMES)))
    label, fold = draw.integers(0, 2, 300), draw.integers(0, quality.FOLDS, 300)
    cosines = quality.Cosines(
        np.zeros(len(quality.NAMES)), np.ones(len(quality.NAMES)), draw.normal(size=(len(quality.NAMES), 20)), draw.uniform(size=20)
    )
    rows = spark.createDataFrame(
        [(s.tolist(), int(y), int(f), i % 5) for i, (s, y, f) in enumerate(zip(stats, label, fold))],
        "__stats array<double>, __label int, __fold int, __part long",
    ).repartition(5)
    sums = quality._fold_sums(rows, cosines)
    z = np.column_stack([cosines(stats), label])
    for k in range(quality.FOLDS):
        assert sums[k] == pytest.approx(z[fold == k].T @ z[fold == k])
    whole = sums.sum(axis=0)
    ridge = np.diag([0.01 * 300] * 20 + [0.0]) + 1e-9 * np.eye(21)
    want = np.linalg.solve(z[:, :-1].T @ z[:, :-1] + ridge, z[:, :-1].T @ label)
    weights = quality._solve(whole, 0.01)
    assert weights == pytest.approx(want)
    assert quality._error(whole, weights) == pytest.approx(((z[:, :-1] @ weights - label) ** 2).sum())


def test_cosines_approach_the_gaussian_kernel():
    draw = np.random.default_rng(4)
    d = len(quality.NAMES)
    cosines = quality.Cosines(
        np.zeros(d), np.ones(d), draw.normal(0, 1 / np.sqrt(d), (d, 20_000)), draw.uniform(0, 2 * np.pi, 20_000)
    )
    x = draw.normal(size=(5, d))
    z = cosines(x)[:, :-1]
    gap = ((x[:, None] - x[None]) ** 2).sum(axis=2) / d
    assert z @ z.T == pytest.approx(np.exp(-gap / 2), abs=0.03)


DOCS = "doc_id long, text string, quality int, score double"
LABELS = "doc_id long, quality int, text string"


def scores(spark, docs, labels, **options):
    found = quality.quality_scores(
        spark.createDataFrame([(i, t, 0, 0.5) for i, t in docs], DOCS),
        spark.createDataFrame([(i, q, "x") for i, q in labels], LABELS),
        **options,
    )
    return [(r["__id"], r["__score"]) for r in found.collect()]


def test_defined_cases(spark):
    docs = [(None, "a"), (1, None), (2, ""), (3, "x " * 50_000), (4, "a b"), (4, "a b"), (5, "\x00\x1f")]
    assert all(s == 0.5 for _, s in scores(spark, docs, []))
    assert all(s == 0.5 for _, s in scores(spark, docs, [(1, None), (None, 1)]))
    got = scores(spark, docs, [(i, 1) for i in range(6)])
    assert len(got) == 7 and all(s == pytest.approx(1) for _, s in got)
    mixed = scores(spark, docs, [(1, 0), (1, 1), (2, 0), (3, 1), (4, 0), (5, 1), (9, 1)])
    assert len(mixed) == 7 and all(0 <= s <= 1 for _, s in mixed)
    assert scores(spark, [], [(1, 1)]) == []


def test_carried_columns(spark):
    docs = spark.createDataFrame([(1, "a", 3, 0.25)], DOCS)
    labels = spark.createDataFrame([(1, 1, "x")], LABELS)
    row = quality.quality_scores(docs, labels, carry=["quality", "score"]).first()
    assert (row["quality"], row["score"]) == (3, 0.25)
