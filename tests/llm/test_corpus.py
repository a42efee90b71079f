"""Mixing, benchmark leaks and the whole pipeline."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from depthgrid.llm import decontaminate, mixing, queries, toxicity

FOLDER = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ mixing


def plain_targets(sizes, weights=(5, 2, 1), ceiling=3):
    """Share by weight, stop at the ceiling, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, free, target = float(sum(sizes.values())), set(sizes), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] >= ceiling * sizes[s]}
        if not over:
            target |= {s: share * weight[s] for s in free}
            break
        for s in over:
            target[s] = float(ceiling * sizes[s])
            left -= target[s]
        free -= over
    return target


def mixed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs, mixing.plan_mix(docs).collect()


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_sizes(spark, seed):
    draw = random.Random(seed)
    names = ["b", "B", "a", "é", "z", "", None, "src10", "src9"][: draw.randint(2, 9)]
    rows = [(i, "w " * int(draw.paretovariate(0.7)), draw.choice(names)) for i in range(300)]
    rows += [(900, None, "only empty"), (901, " \t", "only empty")]
    _, got = mixed(spark, rows)
    sizes, source = {}, {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
        source[i] = s
    want = plain_targets(sizes)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(rate), int(rate) + (rate > int(rate)))
        assert r.copies <= 3
    assert abs(sum(want.values()) - sum(sizes.values())) < 1e-6 * sum(sizes.values())


def test_taken_words_come_near_their_targets(spark):
    draw = random.Random(1)
    rows = [(i, "w " * draw.randint(20, 200), f"s{i % 5}" if i % 3 else "s0") for i in range(6000)]
    _, got = mixed(spark, rows)
    taken = {}
    for r in got:
        key = (r.source_size, r.target)
        taken[key] = taken.get(key, 0) + r.size * r.copies
    for (_, target), words in taken.items():
        assert abs(words - target) < 0.06 * target


def test_emitted_rows_follow_the_plan_and_repeat(spark):
    rows = [(i, "w " * (i % 9), ["x", "y", None][i % 3]) for i in range(120)] + [(None, "a b", "x"), (5, "t", "x"), (5, "t", "x")]
    docs, plan = mixed(spark, rows)
    docs = docs.withColumn("copy", F.lit("mine")).withColumn("size", F.lit(1))
    out = mixing.emit_mix(docs)
    assert out.columns == [*docs.columns, "copy_"]
    first = sorted(map(repr, out.collect()))
    assert first == sorted(map(repr, mixing.emit_mix(docs.repartition(7)).collect()))
    assert len(first) == sum(r.copies for r in plan)


def test_mix_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.plan_mix(docs).count() == 0 and mixing.emit_mix(docs).count() == 0


# ------------------------------------------------------------------ benchmark leaks


def leak_rows():
    draw = random.Random(3)
    fresh = lambda n: [f"v{draw.randrange(10**6)}" for _ in range(n)]
    items = [(i, " ".join(fresh(n))) for i, n in enumerate([5, 6, 9, 15, 16, 31, 40, 64, 100, 300])]
    items += [(90, "two words"), (91, ""), (92, None), (93, "Shared passage of words that all hold " * 2)]
    docs = []
    for k in range(120):
        ws = fresh(draw.choice([0, 3, 20, 400, 3000]))
        n, text = items[draw.randrange(10)]
        part = text.split()
        kind = k % 6
        if kind == 0:
            ws = ws + part + fresh(30)
        elif kind == 1:  # a part of the item only
            ws = ws + part[: max(1, int(len(part) * draw.uniform(0.5, 1)))]
        elif kind == 2:  # both halves, far apart
            ws = part[: len(part) // 2] + ws + part[len(part) // 2 :]
        elif kind == 3:
            ws = [w.upper() for w in part]
        elif kind == 4:
            ws = ws + ("Shared passage of words that all hold " * 2).split()
        docs.append((k, " ".join(ws)))
    docs += [(200, None), (201, ""), (202, "Two\tWORDS"), (203, "two words more")]
    return docs, items


def plain_leaks(docs, items):
    out = {}
    sets = {i: brute.shingles(t) for i, t in items}
    for d, text in docs:
        have = brute.shingles(text)
        for i, want in sets.items():
            if want and 100 * len(want & have) >= 75 * len(want):
                out[d, i] = (len(want), len(want & have))
    return out


def test_leaks_match_exact_containment(spark):
    docs, items = leak_rows()
    got = decontaminate.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    want = plain_leaks(docs, items)
    assert len(want) > 50
    assert {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in got} == want
    assert all(r.containment == r.n_shared / r.n_item for r in got)


def test_leaks_nulls_repeats_clashes_and_empty_tables(spark):
    text = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame(
        [(1, text, 5), (1, text, 5), (None, text, 6), (2, "clean", 7)], "doc_id long, text string, item_id int"
    )
    items = spark.createDataFrame([(7, text, 1), (7, text, 1), (None, text, 2)], "item_id long, text string, doc_id int")
    got = decontaminate.contained_items(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in got) == [(0, 0), (0, 7), (1, 0), (1, 7)]
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.item_id for r in left.collect()) == [6, 7]
    for a, b in ((docs.filter("false"), items), (docs, items.filter("false"))):
        assert decontaminate.contained_items(a, b).count() == 0
    assert decontaminate.drop_contaminated(docs, items.filter("false")).count() == 4


# ------------------------------------------------------------------ pipeline


def test_every_stage_does_what_its_rule_says(spark):
    docs = queries.table(spark, FOLDER, "documents")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in queries.table(spark, FOLDER, "benchmark").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.fit(docs, queries.table(spark, FOLDER, "labels"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != "mix_sources":
            assert out.columns == columns
        out = corpus_pipeline.stored(out)
        after = {r.doc_id: r.text for r in out.collect()}
        assert all(before[i] == t for i, t in after.items())
        if name == "toxicity":
            scored = toxicity.score(docs.select("doc_id", "text"), model).collect()
            assert set(after) == {r.doc_id for r in scored if r["__score"] < 0.5}
            labels = {r.doc_id: r.toxic for r in queries.table(spark, FOLDER, "labels").collect()}
            clean = [i for i in before if labels.get(i) == 0]
            assert sum(i in after for i in clean) >= 0.99 * len(clean)
        elif name == "exact_copies":
            best = {}
            for i, t in before.items():
                best[brute.fold(t)] = max(i, best.get(brute.fold(t), i))
            assert set(after) == set(best.values())
        elif name == "near_copies":
            assert set(after) == {i for i, c in brute.components(list(before.items())).items() if i == c}
        elif name == "benchmark_leaks":
            assert set(after) == set(before) - {d for d, _ in plain_leaks(before.items(), items)}
        else:
            plan = {r.doc_id: r.copies for r in mixing.plan_mix(docs).collect()}
            seen = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
            assert seen == {i: n for i, n in plan.items() if n}
        docs, before = out, after


def test_run_equals_the_stages_one_after_the_other(spark):
    docs = queries.table(spark, FOLDER, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER))
    key = lambda r: (r.doc_id, r.copy)
    assert sorted(map(key, docs.collect())) == sorted(map(key, corpus_pipeline.run(spark, FOLDER).collect()))


def test_stages_take_nulls_clashing_columns_and_empty_tables(spark):
    source = queries.table(spark, FOLDER, "documents").limit(60)
    odd = source.unionByName(
        spark.createDataFrame([(None, None, None, None, None), (None, "", "x", None, 0), (5000, None, None, "s", None)], source.schema)
    )
    for name in ("kept", "copy", "group_size", "n", "bucket", "rep", "label", "value"):
        odd = odd.withColumn(name, F.lit(name))
    for docs in (odd, odd.filter("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            docs = corpus_pipeline.stored(out)
            if name != "mix_sources":
                assert out.columns == odd.columns


def test_no_small_item_is_overlooked(spark):
    """30,000 items of 1 to 8 shingles, each inside one document of its own words."""
    draw = random.Random(12)
    items, docs = [], []
    for n in range(30_000):
        ws = [f"i{draw.randrange(10**9)}" for _ in range(5 + n % 8)]
        own = [f"d{draw.randrange(10**9)}" for _ in range(12)]
        at = draw.randrange(13)
        items.append((n, " ".join(ws)))
        docs.append((n, " ".join(own[:at] + ws + own[at:])))
    got = decontaminate.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(n, n) for n in range(30_000)}
    assert all(r.n_item == 1 + r.item_id % 8 == r.n_shared for r in got)
