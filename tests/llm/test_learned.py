"""Toxicity and personal data."""

import random
import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from depthgrid.llm import pii, toxicity

FOLDER = "/root/testdata/sf0.1"


# ------------------------------------------------------------------ toxicity


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    got = scored.join(labels.select("doc_id", "toxic"), "doc_id").withColumn(
        "held", toxicity.held_out(F.col("doc_id"))
    )
    rows = got.filter("held").select("__score", "toxic").collect()
    assert len(rows) > 500
    hit = sum((r["__score"] >= 0.5) == (r.toxic == 1) for r in rows)
    assert hit / len(rows) > 0.98
    toxic = [r["__score"] for r in rows if r.toxic]
    clean = [r["__score"] for r in rows if not r.toxic]
    # a tenth of the toxic labels here belong to texts without any telling word
    assert np.mean([a > b for a in toxic for b in clean]) > 0.93
    assert sum(s >= 0.5 for s in clean) / len(clean) < 0.01


def test_folds_and_bounds(spark, tables):
    ids = spark.range(2000).select("id", toxicity.held_out(F.col("id")).alias("held")).collect()
    assert all(r.held == brute.held_out(r.id) for r in ids)
    small = toxicity.fit(*tables, sample_rows=300)
    again = toxicity.fit(*tables, sample_rows=300)
    assert (small.weights == again.weights).all() and len(small.weights) <= toxicity.FEATURES


def test_labels_of_the_held_out_fold_and_other_columns_change_nothing(tables):
    docs, labels = tables
    one = toxicity.fit(docs, labels, sample_rows=400)
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    ).withColumn("quality", F.lit(0))
    two = toxicity.fit(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), flipped, sample_rows=400)
    assert (one.weights == two.weights).all() and (one.factors == two.factors).all()


def test_pairs_are_learned():
    """The label is a pair of terms; either term alone says nothing."""
    draw = np.random.default_rng(0)
    row, feature, label = [], [], []
    for n in range(3000):
        a, b = draw.random() < 0.5, draw.random() < 0.5
        present = [k for k, on in ((0, a), (1, b), (2, draw.random() < 0.5), (3, True)) if on]
        row += [n] * len(present)
        feature += present
        label.append(float(a == b))
    row, feature, label = np.array(row), np.array(feature), np.array(label)
    bias, weights, factors = toxicity.fit_machine(row, feature, label, 4)
    margins, _ = toxicity._margins(row, feature, len(label), bias, weights, factors)
    assert ((margins > 0) == label).mean() > 0.95


def test_a_pure_pair_is_learned_from_texts(spark):
    """The label is a pair of words that say nothing alone, among words that say nothing at all."""
    draw = random.Random(5)
    filler = [f"w{draw.randrange(10**6)}" for _ in range(300)]
    docs, labels = [], []
    for n in range(6000):
        a, b = draw.random() < 0.5, draw.random() < 0.5
        text = draw.sample(filler, 12) + ["insult"] * a + ["group"] * b
        draw.shuffle(text)
        docs.append((n, " ".join(text)))
        labels.append((n, int(a == b)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 1000
    assert sum((r["__score"] >= 0.5) == (r.toxic == 1) for r in rows) / len(rows) > 0.95


def test_texts_without_any_feature_take_part_in_the_fit():
    row, feature = np.array([0, 0, 3], np.int32), np.array([0, 1, 1], np.int16)
    label = np.array([1.0, 0.0, 0.0, 1.0] + [0.0] * 600)  # whole batches have no feature
    bias, weights, factors = toxicity.fit_machine(row, feature, label, 2)
    assert bias < 0 and np.isfinite(weights).all() and np.isfinite(factors).all()


def test_margins_equal_a_loop_over_pairs():
    draw = np.random.default_rng(9)
    weights, factors, bias = draw.normal(size=20), draw.normal(size=(20, 3)), 0.3
    sets = [sorted(draw.choice(20, size, replace=False).tolist()) for size in (0, 1, 2, 7, 20, 0)]
    row = np.array([n for n, own in enumerate(sets) for _ in own])
    feature = np.array([k for own in sets for k in own])
    got, _ = toxicity._margins(row, feature, len(sets), bias, weights, factors)
    for margin, own in zip(got, sets):
        want = bias + sum(weights[k] for k in own)
        want += sum(factors[j] @ factors[k] for i, j in enumerate(own) for k in own[i + 1 :])
        assert margin == pytest.approx(want)


def test_many_texts_of_one_id_stay_within_the_bound(spark):
    docs = spark.createDataFrame(
        [(1, f"word{n} insult") for n in range(500)] + [(n, f"fine{n} text") for n in range(2, 60)], "doc_id long, text string"
    )
    labels = spark.createDataFrame([(n, int(n == 1)) for n in range(60)], "doc_id long, toxic int")
    sets = toxicity._labelled_sets(docs, labels, "doc_id", "text", "toxic", 40)
    assert sets.count() == 40
    twice = toxicity._labelled_sets(docs.union(docs), labels, "doc_id", "text", "toxic", 10_000)
    assert twice.count() == toxicity._labelled_sets(docs, labels, "doc_id", "text", "toxic", 10_000).count()


def test_scores_of_odd_texts(spark, model):
    rows = [(1, None), (2, ""), (3, "!!"), (4, "idiot " * 200_000), (None, "you idiot"), (4, "tie"), (4, "tie")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["__score"] <= 1 and r.score == "mine" for r in got)
    assert got[0]["__score"] == got[1]["__score"] == got[2]["__score"] < 0.5
    assert got[3]["__score"] > 0.5 and got[4]["__score"] > 0.5


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "idiot"), (2, None)], "doc_id long, text string")
    for rows in ([], [(1, 1)], [(1, None), (7, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        assert toxicity.drop_toxic(docs, labels).count() == 2
    assert toxicity.drop_toxic(docs.filter("false"), labels).count() == 0


# ------------------------------------------------------------------ personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(text):
    total = 0
    for k, d in enumerate(int(c) for c in reversed(text) if c.isdigit()):
        total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def plain_spans(text):
    digits = lambda t: len(re.sub("[^0-9]", "", t))
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= digits(m[0]) <= 19 and luhn(m[0])]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= digits(m[0]) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    draw = random.Random(2)
    for _ in range(30_000):
        text = "".join(draw.choice("a@.-1290+ ()é") for _ in range(draw.randint(1, 40)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("4111 1111 1111 1111 x@y.z 001.2.3.4") == plain_spans("4111 1111 1111 1111 x@y.z 001.2.3.4")


def test_base_spans_take_linear_time_on_hostile_texts():
    import time

    begin = time.time()
    for text in ("1" * 300_000, "a" * 300_000, "a@" * 150_000, "+1" + "(" * 300_000, "1." * 150_000, "@" * 300_000):
        pii.base_spans(text)
    assert time.time() - begin < 20


def test_gradient():
    draw = np.random.default_rng(0)
    p = pii.new_parameters(1)
    chars, tags = draw.integers(0, pii.CHARS, (2, pii.WIDTH)), draw.integers(0, pii.TAGS, (2, pii.WIDTH))
    _, grad = pii.loss_and_gradient(p, chars, tags)
    for name in p:
        at = tuple(draw.integers(0, s) for s in p[name].shape)
        if name.startswith("table"):
            at = (chars[0, 7], at[1])
        old, near = p[name][at], []
        for step in (1e-5, -1e-5):
            p[name][at] = old + step
            near.append(pii.loss_and_gradient(p, chars, tags)[0])
        p[name][at] = old
        assert abs((near[0] - near[1]) / 2e-5 - grad[name][at]) < 1e-5


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(1)
    p = pii.new_parameters(3)
    p["move"] = draw.normal(0, 1, p["move"].shape)
    chars = draw.integers(0, pii.CHARS, (3, pii.WIDTH))
    e = pii._emissions(p, chars)[0]
    value = lambda t, n: p["begin"][t[0]] + e[n, range(pii.WIDTH), t].sum() + p["move"][t[:-1], t[1:]].sum()
    for n, best in enumerate(pii.decode(p, chars)):
        for _ in range(300):
            other = best.copy()
            for at in draw.integers(0, pii.WIDTH, 3):
                other[at] = draw.integers(pii.TAGS)
            assert value(best, n) >= value(other, n) - 1e-9


def test_windows_cover_every_spot_and_join_over_seams():
    draw = random.Random(4)
    for _ in range(300):
        text = "".join(draw.choice("ab 1@") if draw.random() < 0.1 else "a" for _ in range(draw.randint(1, 700)))
        starts = pii.window_starts(text)
        for at, c in enumerate(text):
            if c in "1@":
                assert any(s <= at < s + pii.WIDTH for s in starts)
    tags = np.full((4, pii.WIDTH), 4)
    tags[0, 0] = 3
    starts = [0, 48, 96, 144]
    assert pii.reconcile(starts, tags, 200) == [(0, 1, 200)]
    assert pii.reconcile([0, 500], tags[:2], 600) == [(0, 1, 96), (500, 1, 596)]


@pytest.fixture(scope="module")
def finder(tables):
    return pii.fit(tables[0])


def test_network_finds_held_out_base_spans(finder):
    """Numbers and names that no training text has, tagged like the patterns tag them."""
    draw = random.Random(6)

    def card():
        head = [draw.randrange(10) for _ in range(15)]
        return next(c for d in range(10) if luhn(c := "".join(map(str, head + [d]))))

    hit = wanted = 0
    for _ in range(200):
        filler = lambda: " ".join("".join(draw.choice("aeinorst") for _ in range(5)) for _ in range(8))
        thing = draw.choice([
            card(), f"u{draw.randrange(99)}@h{draw.randrange(9)}.example.{draw.choice(['org', 'net', 'com'])}",
            f"+1 ({draw.randrange(100, 999)}) 555-{draw.randrange(1000, 9999)}",
            ".".join(str(draw.randrange(10, 255)) for _ in range(4)),
        ])
        text = f"{filler()} {thing} {filler()}"
        starts = pii.window_starts(text)
        tags = pii.decode(finder.parameters, np.stack([pii.encode(text, s) for s in starts]))
        found = set(pii.reconcile(starts, tags, len(text)))
        wanted += 1
        hit += set(pii.base_spans(text)) <= found
    assert hit / wanted > 0.9


def test_added_spans_keep_base_spans(tables, finder, spark):
    rows = pii.find_personal_data(tables[0], finder).filter("spans <> ''").collect()
    texts = {r.doc_id: r.text for r in tables[0].collect()}
    import hashlib

    assert sum(r.n_added for r in rows) > 0
    for r in rows:
        base = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(texts[r.doc_id])]
        assert set(base) <= set(r.spans.split(","))
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(b.startswith(k + ":") for b in base) for k in pii.KINDS
        ]
        for span in set(r.spans.split(",")) - set(base):
            kind, a, b = span.split(":")
            assert pii._holds(pii.KINDS.index(kind), texts[r.doc_id][int(a) : int(b)])


def test_nulls_repeats_clashes_and_empty_tables(spark, finder):
    rows = [(1, None), (2, ""), (None, "a@b.c"), (3, "é a@b.c"), (3, "é a@b.c"), (4, "7" * 5000 + " a@b.c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("mine"))
    got = pii.find_personal_data(docs, finder).collect()
    assert [r.spans for r in got[:5]] == ["", "", "email:0:5", "email:2:7", "email:2:7"]
    assert "email:5001:5006" in got[5].spans
    empty = docs.filter("false")
    assert pii.find_personal_data(empty, pii.fit(empty)).count() == 0
    assert pii.find_personal_data(docs, pii.Finder(None)).count() == len(rows)
