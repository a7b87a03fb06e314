"""Slot-decomposed mining against plain search of every window."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, score string, slot string"


def plain(rows, k=5, floor=80):
    """Result rows of every anchor (ids divisible by 100), each window searched by itself."""
    use = []
    for vec_id, label, v, *_ in rows:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((vec_id, label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]))
    out = []
    for a_id, a_label, a in use:
        if a_id % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), i, label) for i, label, v in use if len(v) == len(a)]
        own = sorted(x for x in scored if x[2] == a_label and x[1] != a_id)[:k]
        for minus, p_id, _ in own:
            inside = sorted(x for x in scored if x[2] != a_label and floor * -minus <= 100 * -x[0] <= 100 * -minus)[:k]
            out += [(a_id, p_id, r + 1, x[1], -minus, -x[0]) for r, x in enumerate(inside)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 100 == 0)
                  .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, seed, width=8, grid=None):
    pick = np.random.default_rng(seed)
    v = pick.normal(size=(n, width))
    v = np.round(v * grid) / grid if grid else v
    return [(i, int(pick.integers(0, 3)), [float(x) for x in v[i]], "s", "t") for i in range(n)]


@pytest.mark.parametrize("grid", [None, 2])                 # a coarse grid makes many ties
def test_equals_plain_search(spark, grid):
    rows = vectors(600, 3, grid=grid)
    want = plain(rows)
    assert len(want) > 20 and mined(spark, rows) == want


def test_a_vector_that_a_third_of_the_rows_share(spark):
    rows = vectors(500, 7)
    rows = [(i, label, [1.0] * 8 if i % 3 == 0 else v, *rest) for i, label, v, *rest in rows]
    assert mined(spark, rows) == plain(rows)


def test_groups_of_anchors(spark, monkeypatch):
    rows = vectors(900, 11)
    monkeypatch.setattr(H, "GROUP_BYTES", 8 * 8 * 2)         # two anchors in a group
    assert mined(spark, rows) == plain(rows)


def test_messy_rows(spark):
    rows = vectors(320, 13)
    rows += [(None, 1, [0.5] * 8, "", ""), (400, None, [0.5] * 8, "", ""), (500, 1, None, "", ""), (600, 1, [0.5] * 7 + [None], "", ""),
             (700, 1, [0.5] * 7 + [float("nan")], "", ""), (800, 1, [float("inf")] * 8, "", ""), (900, 1, [0.5, 0.5], None, None),
             (901, 1, [0.25, 0.5], None, None), (902, 2, [0.25, 0.45], None, None), (1000, 2, [], "", ""), (1001, 2, [], "", ""),
             (1002, 1, [], "", ""), (1100, 1, [-1.0, -1.0], "", ""), rows[0], rows[1], rows[1]]
    rows += [(100, 1, [0.5] * 8, "", ""), (2, 1, [0.5] * 8, "", "")]             # ids that repeat with another vector
    pick = random.Random(1)
    pick.shuffle(rows)
    assert mined(spark, rows) == plain(rows)


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [2.0 ** 21 + i, 2.0 ** 20 - 3 * i, float(i)], "", "") for i in range(0, 200, 2)]
    rows += [(i + 1, (i + 1) % 3, [2.0 ** 21 - i, 2.0 ** 20 + i, 1.0], "", "") for i in range(0, 200, 2)]
    assert mined(spark, rows) == plain(rows)


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, [(1, 1, [1.0], "", "")]) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []
