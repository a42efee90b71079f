"""Centroid clustering against a plain loop."""

import hashlib
import math
import random

import numpy as np
import pytest

from depthgrid.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, ids int"


def plain(rows, dims, k, rounds):
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest()
    found = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(found)))
        return out

    for _ in range(rounds):
        near = assign()
        for n in range(len(found)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == n]
            if own:
                found[n] = [sum(col) // len(own) for col in zip(*own)]
    near = assign()
    inertia = {}
    for d, c in near:
        inertia[c] = inertia.get(c, 0) + d
    digest_of = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found]
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), digest_of[c]) for (i, _), (d, c) in zip(kept, near)), key=repr
    )


def run(spark, rows, dims, k, rounds, parts=3):
    table = spark.createDataFrame(
        [(i, v and [x if x is None else float(x) for x in v], "x", 1) for i, v in rows], SCHEMA
    ).repartition(parts)
    got = centroids.cluster_vectors(table, dims=dims, centroids=k, rounds=rounds)
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)


def vectors(n, dims, seed, spread=1.0):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, spread) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 4])
def test_equals_plain_loop(spark, parts):
    rows = vectors(300, 6, 1)
    assert run(spark, rows, 6, 7, 4, parts) == plain(rows, 6, 7, 4)


def test_ties_repeats_and_unfit_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [nan, 0, 0]), (5, [inf, 0, 0]), (6, [0.0, None, 0.0]), (7, [0.0] * 4)]
    rows = odd + [(10, [0.0, 0, 0])] * 5 + [(11, [1.0, 0, 0]), (12, [0.5, 0, 0]), (12, [-0.5, 0, 0]), (None, [9.0, 9, 9])]
    for k in (2, 3, 40):
        assert run(spark, rows, 3, k, 3) == plain(rows, 3, k, 3)


def test_large_components_stay_exact(spark):
    rows = [(i, [x * 3.0e7, -x * 1.1e6, x]) for i, x in enumerate([1.0, -1.0, 2.5, 2.25, 0.0, 1e-9])]
    got, want = run(spark, rows, 3, 2, 3), plain(rows, 3, 2, 3)
    limit = centroids.LARGEST
    want = [(i, c, min(d, limit), min(a, limit), min(b, limit), h) for i, c, d, a, b, h in want]
    assert got == sorted(want, key=repr)


def test_beyond_every_number_of_64_bits(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 0.0]), (2, [1.7e308, 1.0]), (3, [0.0, 0.0])]
    got = run(spark, rows, 2, 2, 2)
    assert len(got) == 4 and all(0 <= r[2] <= centroids.LARGEST for r in got)


def test_empty_table(spark):
    assert run(spark, [], 3, 2, 2) == []
    assert run(spark, [(1, None)], 3, 2, 2) == []


def test_every_row_of_several_blocks_is_assigned(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 16)
    rows = vectors(200, 5, 2)
    assert run(spark, rows, 5, 9, 2, 2) == plain(rows, 5, 9, 2)


def test_block_sums_are_exact():
    draw = np.random.default_rng(0)
    own = draw.integers(-300, 300, (500, 4))
    block = centroids.Block.of(own)
    places = draw.integers(-300, 300, (6, 4))
    cluster, distance = block.nearest(places)
    full = ((own[:, None, :] - places[None]) ** 2).sum(axis=2)
    assert (cluster == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    for c in range(6):
        assert block.sums(cluster, 6)[c].tolist() == own[cluster == c].sum(axis=0).tolist()
