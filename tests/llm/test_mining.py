"""Hard negatives against brute force, the curve, and the bounds of zone maps."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.llm import mining

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=5, positives=5, negatives=3):
    whole = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows}
    labels = {i: label for i, _, label in rows}
    out = []
    for a in whole:
        if a % every:
            continue
        score = {j: sum(x * y for x, y in zip(whole[a], v)) for j, v in whole.items() if j != a}
        order = sorted(score, key=lambda j: (-score[j], j))
        for p in [j for j in order if labels[j] == labels[a]][:positives]:
            fit = [j for j in order if labels[j] != labels[a] and 50 * score[p] <= 100 * score[j] <= 95 * score[p]]
            out += [(a, p, n + 1, j, score[p], score[j]) for n, j in enumerate(fit[:negatives])]
    return sorted(out)


def found(frame, every=5, **how):
    rows = mining.labelled_vectors(frame, F.col("label"))
    return sorted(tuple(r) for r in mining.hard_negatives(rows, F.col("vec_id") % every == 0, **how).collect())


@pytest.mark.parametrize("how", [{}, {"block": 16, "tile": 8, "zones": 3}])
def test_hard_negatives_equal_brute_force(spark, how):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 12))
    rows = []
    for i in range(300):
        v = centres[rng.integers(4)] + rng.normal(size=12) * rng.choice([0.05, 0.6])
        rows.append((i, [float(round(x, 1)) for x in v], int(rng.integers(3))))  # rounded: many ties
    want = plain(rows)
    assert len(want) > 300
    assert found(spark.createDataFrame(rows, SCHEMA), **how) == want


def test_rows_that_take_no_part(spark):
    nan = float("nan")
    good = [(i, [1.0 + i / 9, 0.5, 0.1 * (i % 3)], i % 2) for i in range(20)]
    bad = [(None, [1.0], 1), (100, None, 1), (105, [nan], 0), (110, [None, 1.0], 0), (115, [1.0], None), (120, [float("inf")], 1)]
    names = ("v", "place", "block", "part", "tile", "floor", "window", "rank", "score", "anchor_id", "at", "low", "high")
    frame = spark.createDataFrame(good + bad, SCHEMA).withColumns({n: F.lit("z") for n in names})
    assert found(frame) == plain(good)
    assert found(frame.filter("vec_id >= 100")) == [] and found(frame.limit(0)) == []


def test_repeated_ids_short_and_empty_vectors(spark):
    rows = [(0, [1.0, 1.0], 0), (0, [9.0, 9.0], 1), (1, [1.0], 0), (2, [0.6, 0.2], 1), (3, [], 1), (3, [], 1), (4, [0.7], 1), (5, [], 0)]
    kept = [(0, [1.0, 1.0], 0), (1, [1.0, 0.0], 0), (2, [0.6, 0.2], 1), (3, [0.0, 0.0], 1), (4, [0.7, 0.0], 1), (5, [0.0, 0.0], 0)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(kept)
    assert found(spark.createDataFrame([(0, [], 0), (1, [], 0), (2, [], 1)], SCHEMA)) == [(0, 1, 1, 2, 0, 0)]


def test_large_components_take_part(spark):
    rows = [(0, [float(1 << 20)], 0), (1, [float(1 << 20)], 0), (2, [float(1 << 19)], 1), (3, [-1e300], 1)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == [(0, 1, 1, 2, 1 << 56, 1 << 55)]


def test_the_curve_visits_neighbours():
    bits, n = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    places = mining.hilbert(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_bounds_hold_and_blocks_are_skipped(spark):
    rng = np.random.default_rng(8)
    a, block = rng.integers(-300, 300, (20, 6)).astype(float), rng.integers(-300, 300, (50, 6)).astype(float)
    least, most = mining._bounds(a, block.min(axis=0, keepdims=True), block.max(axis=0, keepdims=True))
    scores = a @ block.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()
    # Four far clusters: an anchor's positives lie in its own, so most blocks need no look.
    centres = np.eye(4) * 50
    rows = [(i, [float(x) for x in centres[i % 4] + rng.normal(size=4)], i % 4) for i in range(400)]
    vectors = mining.labelled_vectors(spark.createDataFrame(rows, SCHEMA), F.col("label"))
    candidates = mining.Candidates(vectors, F.col("vec_id") % 50 == 0, block=16)
    pairs = candidates.maps.crossJoin(candidates.anchors.select("anchor_id", "label", "v")).toPandas()
    floors = {}
    for anchor, group in pairs.groupby("anchor_id"):
        own = [r for r in rows if r[0] != anchor and r[2] == group["label"].iloc[0]]
        v = np.array(group["v"].iloc[0])
        floors[anchor] = sorted((v @ np.floor(256 * np.array(r[1])) for r in own), reverse=True)[4]
    needed = 0
    for _, r in pairs.iterrows():
        least, most = mining._bounds(np.array([r["v"]]), np.array([r["low"]]), np.array([r["high"]]))
        needed += most[0, 0] >= floors[r["anchor_id"]]
    assert needed < len(pairs) / 2
