"""Hard negatives against brute force, with little buckets so that pruning has work to do."""

import math

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from siltstone.llm import negatives, queries, sql

SCHEMA = "vec_id long, embedding array<double>, label int, id string, n int, score long"


def brute(rows, is_anchor, positives=5, size=10, band=(30, 90)):
    """By the contract, in whole numbers of any size."""
    kept = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i, label, tuple(math.floor(256 * x) for x in v)] = None
    out = []
    clip = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    for anchor in kept:
        if not is_anchor(anchor[0]):
            continue
        scored = [(-clip(sum(a * b for a, b in zip(anchor[2], other[2]))), other[0], other[1]) for other in kept]
        best = sorted((s, i) for s, i, label in scored if label == anchor[1] and i != anchor[0])[:positives]
        for s, i in best:
            inside = sorted((n, j) for n, j, label in scored if label != anchor[1] and band[0] * -s <= 100 * -n <= band[1] * -s)
            out += [(anchor[0], i, r, j, -s, -n) for r, (n, j) in enumerate(inside[:size], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)


def clustered(rnd, n, dims=16, spread=0.4):
    centres = rnd.normal(size=(6, dims))
    return [(i, (centres[i % 6] * rnd.uniform(0.2, 2) + rnd.normal(size=dims) * spread).tolist(), int(rnd.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("broadcast", [negatives.BROADCAST_BYTES, -1])
def test_against_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(negatives, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(negatives, "BLOCK_VALUES", 1_000)
    monkeypatch.setattr(negatives, "ANCHOR_VALUES", 100)
    rnd = np.random.default_rng(3)
    rows = clustered(rnd, 400)
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(60)]  # many copies of one vector
    rows += [
        (2000, None, 1), (2010, [1.0], None), (None, [1.0] * 16, 1), (2020, [1.0, None], 1), (2030, [1.0, float("nan")], 1),
        (2040, [float("-inf")] * 16, 1), (2050, [], 1), (2060, [0.0] * 16, 2), (2070, [1.0, 2.0], 0), (2080, [0.5] * 20, 1),
        (2090, [-1.0] * 16, 0), rows[20], rows[20], (20, rows[7][1], 1), (2100, [1e30] * 16, 0), (2110, [-1e30] * 16, 0),
    ]
    found = negatives.mine(table(spark, rows), F.col("id") % 10 == 0)
    assert found.dtypes == [(c, "int" if c == "rank" else "bigint") for c in negatives._COLUMNS]
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 10 == 0)


def test_no_rows_and_no_anchors(spark):
    rows = clustered(np.random.default_rng(4), 30)
    assert negatives.mine(table(spark, []), F.col("id") % 10 == 0).collect() == []
    assert negatives.mine(table(spark, rows), F.col("id") < 0).collect() == []
    # One label only has no negatives, and one row of a label no positives.
    assert negatives.mine(table(spark, [(*r[:2], 1) for r in rows]), F.col("id") == 0).collect() == []
    assert negatives.mine(table(spark, [(*r[:2], r[0]) for r in rows]), F.col("id") == 0).collect() == []


def test_pruning_loses_nothing_and_prunes():
    rnd = np.random.default_rng(5)
    matrix = np.floor(256 * np.array([v for _, v, _ in clustered(rnd, 1_000, spread=0.1)]))
    block = dict(zip(("n", "dims", "ids", "labels", "matrix", "orders"), negatives._block(list(range(1000)), [0] * 1000, list(matrix), True)))
    tested = verified = 0
    for bucket in negatives._buckets(block, 16):
        for anchor in matrix[:60]:
            length = float(np.sqrt(anchor @ anchor))
            scores = bucket.matrix @ anchor
            for bound in np.quantile(scores, (0.5, 0.9, 0.99)):
                rows = bucket.within(anchor, length, bound)
                rows = np.zeros(0, int) if rows is None else rows
                assert set(np.flatnonzero(scores >= bound)) <= set(rows.tolist())
                tested += len(scores)
                verified += len(rows)
    assert verified < 0.8 * tested


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    assert oracle.compare(queries.QUERIES["op12_hard_negatives"](spark, sf), oracle.connect(sf), sql.HARD_NEGATIVES) == []
