"""Very long texts: read whole by every operator, with the result of the plain rule."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from depthgrid.llm import decontaminate, exact_dedup, mixing, near_dedup, pii, quality, suffix_dedup, toxicity

WORDS = 250_000
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    long = [f"w{draw.randrange(10**6)}" for _ in range(WORDS)]
    near = list(long)
    for _ in range(WORDS // 60):
        near[draw.randrange(WORDS)] = "changed"
    half = long[: WORDS // 2] + [f"v{draw.randrange(10**6)}" for _ in range(WORDS // 2)]
    short = long[-30:]
    texts = [" ".join(long), " ".join(long).upper(), " ".join(near), " ".join(half), " ".join(short), "x" * 2_000_000, ""]
    return [(n, t, "s") for n, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(2)


def test_exact_copies(docs):
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_groups(docs).collect()}
    assert got[0] == got[1] == (1, 2) and got[2] == (2, 1) and got[5] == (5, 1)


def test_near_copies(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.link_components(docs).collect()}
    want = brute.components([(i, t) for i, t, _ in rows])
    assert {i: c for i, (_, c) in got.items()} == want and want[2] == 0 and want[3] == 3
    assert got[0][0] == len(brute.shingles(rows[0][1]))


def test_repeated_passages(docs):
    got = {(r.doc_id, r.start_word, r.end_word) for r in suffix_dedup.repeated_spans(docs).collect()}
    assert {(0, 0, WORDS), (1, 0, WORDS), (3, 0, WORDS // 2)} <= got  # 30 words at the end are too few


def test_benchmark_items_deep_inside(spark, docs, rows):
    words = rows[0][1].split()
    items = spark.createDataFrame(
        [(1, " ".join(words[-25:])), (2, " ".join(words[WORDS // 3 :][:90])), (3, "of none " * 9)], "item_id long, text string"
    )
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, items).collect()}
    assert {(0, 1), (1, 1), (0, 2), (1, 2), (3, 2), (4, 1)} <= got and not any(i == 3 for _, i in got)


def test_sizes_of_the_mix(docs):
    got = {r.doc_id: r["size"] for r in mixing.plan_mix(docs).collect()}
    assert got == {0: WORDS, 1: WORDS, 2: WORDS, 3: WORDS, 4: 30, 5: 1, 6: 0}


def test_scores(spark, docs):
    labels = spark.createDataFrame([(n, n % 2, n % 2) for n in range(7)], "doc_id long, toxic int, quality int")
    found = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(found) == 7 and all(0 <= r["__score"] <= 1 for r in found)
    found = quality.quality_scores(docs, labels).collect()
    assert len(found) == 7 and all(0 <= r["__score"] <= 1 for r in found)


def test_personal_data_at_the_end(spark):
    text = "word " * 300_000 + "me@example.org 10.0.0.1"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.find_personal_data(docs, pii.Finder(None)).first()
    assert (row.n_email, row.n_ip) == (1, 1) and f"email:{1_500_000}:" in row.spans
