"""Hard negatives against brute force; the bounds never drop a wanted pair."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfold.llm import op13_negatives as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=4, positives=op.POSITIVES, negatives=op.NEGATIVES):
    valid = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        valid.append((i, label, [max(-op.LARGEST, min(op.LARGEST, math.floor(256 * float(np.float32(x))))) for x in v]))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for at, (i, label, q) in enumerate(valid):
        if i % every:
            continue
        scored = sorted((-score(q, w), j, m == label, k) for k, (j, m, w) in enumerate(valid) if k != at)
        for p, pid, same, _ in [s for s in scored if s[2]][:positives]:
            good = [s for s in scored if not s[2] and op.LOW * -p <= -100 * s[0] <= op.HIGH * -p]
            out += [(i, pid, n + 1, s[1], -p, -s[0]) for n, s in enumerate(good[:negatives]) if same]
    return sorted(out)


def mined(spark, rows, **options):
    df = op.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 4 == 0, **options)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def _rows(n, d, seed, centres=5, labels=4):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, d))
    return [(int(i), (c[i % centres] * 0.3 + rng.normal(size=d) * 0.2).tolist(), int(rng.integers(labels)))
            for i in range(n)]


@pytest.mark.parametrize("d", [1, 7, 64, 70])
def test_against_brute_force(spark, d):
    rows = _rows(240, d, d)
    assert mined(spark, rows) == brute(rows)


def test_many_anchor_groups_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(op, "ANCHOR_BLOCK", 16)
    monkeypatch.setattr(op, "ROW_BLOCK", 8)
    monkeypatch.setattr(op, "CELL_ROWS", 20)
    monkeypatch.setattr(op, "ANCHOR_TILE", 3)
    rows = _rows(300, 16, 1)
    assert mined(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_lengths(spark):
    same = [0.25] * 8
    rows = _rows(60, 8, 2)
    rows += [(100 + i, same, i % 3) for i in range(40)]                        # copies, many ties
    rows += [(200, None, 1), (201, [0.1, None], 1), (202, [float("nan")] * 8, 1), (203, [float("inf")] * 8, 2),
             (204, same, None), (None, same, 1), (208, [], 1), (209, [0.5, 0.5], 2), (212, [0.5] * 20, 2)]
    rows += [(216, same, 0), (216, same, 0), (216, same, 0)]                   # one id three times
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(4, [1.0], 0)]) == []
    huge = [(i, [1e9 * (1 + i % 3), -3e4], i % 2) for i in range(12)]
    assert mined(spark, huge) == brute(huge)
    extra = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", r int, q string")
    got = op.hard_negatives(extra, F.col("vec_id") % 4 == 0).collect()
    assert sorted(tuple(x) for x in got) == brute(rows)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    q = rng.integers(-90, 90, size=(300, 64)).astype("<i4")
    q[150:] = q[150:] // 30 + 60   # rows with little deviation: their bounds are narrow
    v = op.Vectors(np.arange(300), np.arange(300), np.zeros(300, int), [r.tobytes() for r in q])
    exact = v.x @ v.x.T
    last = np.inf
    for mean, dev in zip(v.mean, v.dev, strict=True):
        spread = dev @ dev.T + 1e-6
        assert (np.abs(exact - mean @ mean.T) <= spread).all()
        assert spread.mean() <= last
        last = spread.mean()
    i, j = (x.ravel() for x in np.indices((300, 300)))
    low, high = np.full(300, 100_000), np.full(300, 200_000)
    a, b, score = op.scored(v, v, i, j, low, high)
    want = np.argwhere((exact >= 100_000) & (exact <= 200_000))
    assert (np.stack((a, b), 1) == want).all() and (score == exact[a, b]).all()
