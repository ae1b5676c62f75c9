import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>, size int, is_anchor string, positives long, _row int, rank int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], schema)


def brute(rows, every=10, positives=5, negatives=10):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = min(kept.get(i, (label, v)), (label, v))
    ints = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for a, (label, v) in ints.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m == label) for i, (m, w) in ints.items() if i != a and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2]][:positives]:
            fit = [s for s in scored if not s[2] and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:negatives]
            out += [(a, p, k + 1, n, -ps, -ns) for k, (ns, n, _) in enumerate(fit)]
    return sorted(out)


def given(n=400, size=6, spread=1.0, seed=1, labels=4):
    rng = random.Random(seed)
    rows = [(i, rng.choice([0] * labels + list(range(labels))), [round(rng.gauss(0.3, 1) * spread, 2) for _ in range(size)]) for i in range(n)]
    rows += [(n + k, k % labels, rows[5][2]) for k in range(60)]  # ties
    return rows


@pytest.mark.parametrize("spread", [1.0, 1e-4, 3e5, 1e6])
def test_equals_brute_force_at_any_field_width(spark, spread):
    rows = given(spread=spread)
    got = hn.mine(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    want = brute(rows)
    assert sorted(map(tuple, got)) == want
    assert want or spread < 1


def test_many_cells(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 7)
    monkeypatch.setattr(hn, "COMPONENTS", 200)
    monkeypatch.setattr(hn, "PACKED", 16)
    rows = given(seed=2)
    assert sorted(map(tuple, hn.mine(frame(spark, rows), F.col("vec_id") % 10 == 0).collect())) == brute(rows)


def test_rows_that_take_no_part_and_repeated_rows(spark):
    rows = given(120, seed=3)
    nan, inf = float("nan"), float("inf")
    rows += [(None, 1, [1.0] * 6), (500, None, [1.0] * 6), (501, 1, None), (502, 1, [None] + [1.0] * 5), (503, 1, [nan] * 6)]
    rows += [(504, 1, [-inf] + [1.0] * 5), (510, 2, [1.0, 2.0]), (511, 2, [1.0, 1.0]), (512, 1, [1.0, 0.5]), (520, 1, []), (521, 1, [])]
    rows += [rows[0]] * 40 + [(7, 99, [9.0] * 6), (20, -1, rows[20][2]), (530, 3, [0.0] * 6), (-10, 1, [2.0] * 6)]
    assert sorted(map(tuple, hn.mine(frame(spark, rows), F.col("vec_id") % 10 == 0).collect())) == brute(rows)


def test_empty_and_float_vectors(spark):
    assert hn.mine(frame(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    rows = [(i, m, [float(np.float32(x)) for x in v]) for i, m, v in given(80, seed=4)]
    df = frame(spark, rows, SCHEMA.replace("double", "float"))
    assert sorted(map(tuple, hn.mine(df, F.col("vec_id") % 10 == 0).collect())) == brute(rows)


def test_packed_products_are_exact():
    rng = np.random.default_rng(5)
    for most in (1, 300, 2**20, 2**28, 2**40):
        rows = rng.integers(-most, most + 1, (37, 9))
        anchors = rng.integers(-most, most + 1, (4, 9))
        for low, high in ((-most, most), (int(anchors.min()), int(anchors.max()))):
            packed = hn.Packed(rows, low, high)
            for a in anchors.tolist():
                want = [sum(x * y for x, y in zip(a, r)) for r in rows.tolist()]
                assert packed.scores(a).tolist() == want
    assert hn.Packed(np.full((3, 2), -5), 7, 7).scores([7, 7]).tolist() == [-70] * 3


def test_no_pairs_are_emitted(spark):
    """Cells give a bounded number of rows per anchor and positive, not a row per pair."""
    rows = given(300, seed=6)
    table = frame(spark, rows)
    plan = hn.mine(table, F.col("vec_id") % 10 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "FlatMapGroupsInArrow" in plan
