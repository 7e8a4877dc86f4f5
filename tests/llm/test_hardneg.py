"""Hard negatives against brute force and SQL."""

import math
import random

import pytest
from pyspark.sql import functions as F

import compare
from tidemark.llm import hardneg


def plain(rows):
    """Sorted result over (vec_id, vector, label), by comparing everything with everything."""
    able = [(i, k, [math.floor(256 * x) for x in v], b) for i, (k, v, b) in enumerate(rows)
            if b is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, anchor, v, label in able:
        if anchor is None or anchor % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), k is None, k or 0, other, k)
                         for j, k, w, other in able if j != i and len(w) == len(v)),
                        key=lambda r: r[:3])
        for score, _, _, _, positive in [s for s in scored if s[3] == label][:5]:
            found = [s for s in scored if s[3] != label and -80 * score <= -100 * s[0] <= -100 * score]
            out += [(anchor, positive, n, s[4], -score, -s[0]) for n, s in enumerate(found[:5], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = frame.repartition(parts).selectExpr("*", "1 AS row", "2 AS key", "3 AS score", "4 AS dim")
    got = hardneg.mine(frame, F.col("vec_id") % 100 == 0, F.col("label"))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def odd_rows(seed=5):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = [(i * 20, [c + draw.gauss(0, .4) for c in draw.choice(centres)], draw.choice([0, 1, 2]))
            for i in range(150)]
    rows += [(100, rows[5][1], 1)] * 12 + [(None, rows[7][1], 2)] * 2  # repeated rows, null keys
    rows += [(200, None, 1), (300, [], 1), (400, [1.0] * 6, None), (500, [float("nan")] * 6, 0),
             (600, [None] * 6, 0), (700, [float("inf")] * 6, 0), (800, [.5, .5], 1),
             (801, [.4, .6], 1), (802, [.5, .45], 2), (900, [0.0] * 6, 1), (1000, [-1.0] * 6, 2)]
    rows += [(5100, [1e30] * 5, 1), (5101, [1e30] * 4 + [9e29], 1)]
    rows += [(5200, [1e6] * 4, 1), (5201, [1e6, 1e6, 1e6, 9e5], 1), (5202, [9e5] * 4, 2)]
    return rows


@pytest.mark.parametrize("values, matrix", [(1 << 20, 1 << 20), (60, 40)])
def test_mining_equals_brute_force(spark, monkeypatch, values, matrix):
    monkeypatch.setattr(hardneg, "BLOCK_VALUES", values)
    monkeypatch.setattr(hardneg, "MATRIX", matrix)
    rows = odd_rows()
    want = plain(rows)
    assert len(want) > 200 and any(r[0] == 5200 for r in want)
    assert mined(spark, rows) == want


def test_one_vector_held_by_most_rows(spark):
    rows = [(100 * (i % 4), [.5, .5, .1], i % 2) for i in range(300)] + odd_rows()[:30]
    assert mined(spark, rows) == plain(rows)


def test_empty_table_and_no_partner(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1), (101, [1.0], 1), (102, [.9], 2)]) == [
        (100, 101, 1, 102, 65536, 58880)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_query_equals_its_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert compare.differences(spark, compare.oracle_connection(folder), folder,
                               "op11_hard_negatives") is None
