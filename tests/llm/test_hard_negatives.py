"""Hard negatives against a plain version, and bounds against true scores."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from compare import differences, duck

from clinloom.llm import hard_negatives
from clinloom.llm import queries as _registered  # noqa: F401
from clinloom.workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_query(spark):
    assert differences(QUERIES["op13_hard_negatives"](spark, SF), duck(SF), ORACLES["op13_hard_negatives"]) is None


def _plain(rows, is_anchor, positives=5, negatives=10, window=(30, 90, 100)):
    low, high, unit = window
    ints = [
        (i, label, [max(-hard_negatives._LONG, min(hard_negatives._LONG, math.floor(256 * x))) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, label, v in ints:
        if not is_anchor(a):
            continue
        scored = [
            (-max(-hard_negatives._MOST, min(hard_negatives._MOST, sum(int(x) * int(y) for x, y in zip(v, w)))), i, other == label)
            for i, other, w in ints if i != a and len(w) == len(v)
        ]
        for p, i, _ in sorted(s for s in scored if s[2])[:positives]:
            inside = sorted(s for s in scored if not s[2] and low * -p <= unit * -s[0] <= high * -p)[:negatives]
            out += [(a, i, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(inside)]
    return Counter(out)


def _mined(spark, rows, kind="float", **more):
    frame = spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>").selectExpr("*", "'own' as score", "1 as block")
    return Counter(map(tuple, hard_negatives.mined(frame, "vec_id % 4 = 0", 5, 10, (30, 90, 100), **more).collect()))


@pytest.mark.parametrize("block", [1024, 7])
def test_ties_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 5)
    random.seed(13)
    centres = [[random.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, i % 3, [float(np.float32(c + random.choice([0, 0, 0.5, 0.25]))) for c in random.choice(centres)]) for i in range(150)]
    rows += [(200, 0, None), (204, None, [1.0] * 6), (208, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (212, 1, [float("nan")] * 6)]
    rows += [(None, 1, [1.0] * 6), (216, 1, [0.0] * 6), (220, 2, []), (224, 2, []), (228, 2, [1.0, 2.0]), (229, 2, [1.0, 2.0]), (230, 0, [1.0, 1.0])]
    rows += [rows[8], rows[9]]
    assert _mined(spark, rows) == _plain(rows, lambda i: i % 4 == 0)


def test_large_components_and_no_rows(spark):
    random.seed(14)
    rows = [(i, i % 2, [random.choice([1e15, -1e15, 3e17, 1.0, 1e300]) for _ in range(3)]) for i in range(40)]
    assert _mined(spark, rows, "double") == _plain(rows, lambda i: i % 4 == 0)
    assert not _mined(spark, [])
    assert not _mined(spark, [(4, 1, [1.0])])


def test_bounds_hold_all_scores():
    rng = np.random.default_rng(15)
    for width in (2, 3, 8):
        values = np.floor(256 * rng.normal(size=(300, width)) * rng.choice([0.01, 1, 50], size=(300, 1))).astype(np.int64)
        values[:20] = values[20:40] * 2  # parallel rows
        values[40] = 0
        real = values[60:70].astype(float)
        references = real / np.sqrt((real**2).sum(axis=1))[:, None]
        angles, norms = hard_negatives._angles(values, references)
        least, greatest = hard_negatives._interval(angles[:, None], angles[:, None], angles[None], angles[None])
        product = norms[:, None] * norms[None]
        lower, upper = hard_negatives._bounds(least, greatest, product, product)
        scores = values @ values.T
        assert (lower <= scores).all() and (scores <= upper).all()
        near, far = hard_negatives._limits(scores - 1, scores + 1, product, product)
        true = np.arccos(np.clip(scores / np.where(product > 0, product, 1), -1, 1))
        assert ((near <= true) & (true <= far) | (product == 0)).all()
