import random

import brute
import pytest
from pyspark.sql import functions as F

from depthgrid.llm import exact_dedup, near_dedup, suffix_dedup
from depthgrid.llm.components import components

SCHEMA = "doc_id long, text string"


def prose(draw, n, vocabulary=400):
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def edited(draw, ws, changes):
    ws = list(ws)
    for _ in range(changes):
        ws[draw.randrange(len(ws))] = f"e{draw.randrange(10**6)}"
    return ws


# ------------------------------------------------------------------ exact


def test_exact_groups_follow_the_rule(spark):
    rows = [
        (1, "Same"), (2, "same"), (3, "sAME"), (4, "SAMÉ"), (5, "samé"), (6, ""), (7, None),
        (8, "x" * 300 + "a"), (9, "x" * 300 + "b"), (10, "x" * 300 + "a"), (11, "same "),
        (None, "same"), (12, "alone"), (13, "tie"), (13, "tie"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = exact_dedup.exact_groups(docs, carry=exact_dedup.full_digest(F.col("text"))).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(brute.fold(t), []).append(i)
    assert len(got) == len(rows)
    for r in got:
        members = next(g for g in groups.values() if r.doc_id in g)
        if r.doc_id is None:
            members = groups["same"]
        assert r.keep_id == max(i for i in members if i is not None)
        assert r.group_size == len(members)
    assert sum(r.kept for r in got) == len(groups)
    stays = [r for r in got if r.kept]
    assert {r.doc_id for r in stays} == {3, 4, 5, 7, 9, 10, 11, 12, 13}
    import hashlib

    assert {r.carried for r in got if r.doc_id in (1, 2, 3)} == {hashlib.sha256(b"same").hexdigest()}


def test_drop_exact_copies_returns_whole_rows(spark):
    rows = [(1, "A", 7), (2, "a", 8), (2, "a", 8), (3, None, 9), (4, "", 1), (5, "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int").withColumn(
        "group_size", F.lit("mine")
    )
    got = exact_dedup.drop_exact_copies(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.kept) for r in got.collect()) == [(2, 8), (4, 1), (5, 2)]


def test_exact_on_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.drop_exact_copies(docs).count() == 0


# ------------------------------------------------------------------ near


def near_rows():
    draw = random.Random(5)
    rows, doc = [], 0
    for size in (5, 8, 30, 60, 120, 300):
        base = prose(draw, size)
        for changes in (0, 0, 1, 1, 2, 3, 5, 8):
            rows.append((doc, " ".join(edited(draw, base, changes))))
            doc += 1
    chain = prose(draw, 200)  # neighbours are similar, the ends are not
    for _ in range(8):
        rows.append((doc, " ".join(chain)))
        doc += 1
        chain = edited(draw, chain, 3)
    rows += [(doc, ""), (doc + 1, None), (doc + 2, "one two"), (doc + 3, "One  TWO"), (doc + 4, "one")]
    draw.shuffle(rows)
    return rows


def check_near(spark, rows):
    got = near_dedup.link_components(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute.components(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (want[r.doc_id] == r.doc_id) for r in got)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(brute.shingles(t)) for i, t in rows}


def test_near_components_match_all_pairs(spark):
    check_near(spark, near_rows())


def test_the_rest_loses_no_link(spark, monkeypatch):
    """With one bucket for everything, the blocks after the stars have to find the links."""
    import numpy as np

    monkeypatch.setattr(near_dedup, "band_keys", lambda s: np.zeros(1, np.uint64))
    check_near(spark, near_rows())
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 3)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 600)
    monkeypatch.setattr(near_dedup, "COLUMNS", 64)
    check_near(spark, near_rows())


def test_near_null_ids_repeats_and_other_columns(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(5, text, 1), (5, text, 1), (9, text + " more", 2), (None, text, 3), (7, "other", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = near_dedup.link_components(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [
        (-1, -1, True), (5, 5, True), (5, 5, True), (7, 7, True), (9, 5, False),
    ]
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.kept for r in left.collect()) == [1, 1, 3, 4]


def test_near_on_empty_tables_and_wrong_percent(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_dedup.link_components(docs).count() == 0
    with pytest.raises(ValueError):
        near_dedup.link_components(docs, percent=60)


def test_sketch_of_tiny_sets_is_full_and_repeatable():
    import numpy as np

    for n in (1, 2, 5, 127, 128, 3000):
        values = np.unique(near_dedup.words.mix(np.arange(n, dtype=np.uint64)))
        one, two = near_dedup.sketch(values), near_dedup.sketch(values.copy())
        assert (one == two).all() and set(one.tolist()) <= set(values.tolist())


def test_sketch_agreement_estimates_similarity():
    import numpy as np

    draw = np.random.default_rng(0)
    rates = []
    for _ in range(200):
        pool = draw.integers(0, 2**63, 250).astype(np.uint64)
        a, b = np.unique(pool[:200]), np.unique(pool[50:])  # Jaccard 150 / 250
        rates.append((near_dedup.sketch(a) == near_dedup.sketch(b)).mean())
    assert abs(np.mean(rates) - 0.6) < 0.02


def test_components_of_a_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(40)]
    hub = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(path + hub + [(7, 7)], "a long, b long")
    label = {r.node: r.label for r in components(edges).collect()}
    assert all(label[i] == 0 for i in range(41))
    assert all(label[i] == 100 for i in range(100, 160))


# ------------------------------------------------------------------ repeated passages


def test_spans_match_the_windows_rule(spark):
    draw = random.Random(8)
    passage, second = prose(draw, 75, 10**6), prose(draw, 50, 10**6)
    short = prose(draw, 49, 10**6)
    rows = []
    for i in range(12):
        ws = prose(draw, draw.randrange(10, 200), 10**6)
        if i % 3 == 0:
            ws += passage + prose(draw, 20, 10**6)
        if i % 4 == 0:
            ws = second + ws
        if i % 2 == 0:
            ws += short
        rows.append((i, " ".join(ws).upper() if i == 3 else "\n ".join(ws)))
    copy = " ".join(prose(draw, 400, 10**6))
    rows += [(20, copy), (21, copy), (22, "x " * 120), (23, "x " * 60), (24, ""), (25, None)]
    got = suffix_dedup.repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.doc_id, r.start_word, r.end_word) for r in got} == brute.spans(rows)
    assert all(r.n_words == r.end_word - r.start_word and r.partner_id != r.doc_id for r in got)


def test_spans_over_many_partitions(spark):
    """A passage shared by most documents is split over partitions and still found everywhere."""
    draw = random.Random(9)
    passage = prose(draw, 90, 10**6)
    rows = [
        (i, " ".join(prose(draw, 30, 10**6) + passage + prose(draw, 30, 10**6))) for i in range(60)
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = suffix_dedup.repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.doc_id, r.start_word, r.end_word) for r in got} == brute.spans(rows)


def test_spans_with_words_on_both_sides_of_a_frequent_passage(spark):
    """Many documents share 45 words; of each two, other 5 words before these are the same too.

    The two stand apart by their words after the passage, so no bounded group of neighbours in
    that order holds both.
    """
    draw = random.Random(10)
    licence = prose(draw, 45, 10**6)
    rows, pairs = [], 6_000
    for i in range(pairs):
        own = prose(draw, 5, 10**9)
        for side, first in ((0, "a"), (1, "z")):
            tail = [f"{first}{draw.randrange(10**9)}" for _ in range(25)]
            rows.append((2 * i + side, " ".join(prose(draw, 20, 10**9) + own + licence + tail)))
    got = suffix_dedup.repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.doc_id, r.start_word, r.end_word, r.partner_id) for r in got} == {
        (i, 20, 70, i ^ 1) for i in range(2 * pairs)
    }


def test_spans_grow_right_where_the_left_is_whole(spark):
    """Of a place, one partner has 40 words after it and none before it, one 28 and 24, and one
    40 and 15, in all orders: the last one alone makes the span reach its end.
    """
    draw = random.Random(11)
    rows = []
    for _ in range(1_500):
        base = prose(draw, 140, 10**9)
        for part in (base, base[60:100], base[36:88], base[45:100]):
            ws = part if part is base else prose(draw, 12, 10**9) + part + prose(draw, 12, 10**9)
            rows.append((len(rows), " ".join(ws)))
    got = suffix_dedup.repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute.spans(rows)
    assert {(i, 36, 100) for i in range(0, len(rows), 4)} <= want
    assert {(r.doc_id, r.start_word, r.end_word) for r in got} == want


def test_spans_edge_tables(spark):
    assert suffix_dedup.repeated_spans(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"v{i}" for i in range(80))
    rows = [(1, text, 0), (1, text, 0), (None, text, 1), (2, text + " " + text, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start_word int")
    got = suffix_dedup.repeated_spans(docs).collect()
    assert {(r.doc_id, r.start_word, r.end_word) for r in got} == {(1, 0, 80), (2, 0, 160)}
    alone = suffix_dedup.repeated_spans(spark.createDataFrame([(1, text + " " + text)], SCHEMA))
    assert alone.count() == 0
