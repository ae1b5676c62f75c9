import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from parcelwise.operators import temporal as T

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n) if n is not None else None


def test_asof_equals_brute_force(spark):
    rng = random.Random(1)
    left = [(k, rng.choice(["a"] * 6 + ["b", "c", None]), day(rng.choice([None, *range(-400, 900)])), "x") for k in range(400)]
    left += [left[0]] * 3
    right = [(rng.choice(["a", "b", "d", None]), day(rng.choice([None, *range(-300, 800)])), rng.choice([None, 1, 2, 3]), f"v{k}") for k in range(60)]
    right += [("a", day(5), None, "v0"), ("a", day(5), 2, "v1"), ("a", day(5), 2, "v2")]
    got = T.asof_join(
        spark.createDataFrame(left, "n int, city string, d date, _state string").repartition(3),
        spark.createDataFrame(right, "city string, since date, size int, name string"),
        ["city"], "d", "since", ["size", "name"],
    )
    by = got.columns
    assert by == ["n", "city", "d", "_state", "as_of", "size", "name"]
    rank = lambda r: (r[1], r[2] is not None, r[2] or 0, r[3])
    want = []
    for n, city, d, x in left:
        known = [r for r in right if None not in (city, d, r[0], r[1]) and r[0] == city and r[1] <= d]
        best = max(known, key=rank) if known else (None, None, None, None)
        want.append((n, city, d, x, *best[1:]))
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_asof_of_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", DAY)], "n int, city string, d date")
    right = spark.createDataFrame([], "city string, since date, size int")
    assert [tuple(r) for r in T.asof_join(left, right, ["city"], "d", "since", ["size"]).collect()] == [(1, "a", DAY, None, None)]
    assert T.asof_join(left.limit(0), right, ["city"], "d", "since", ["size"]).collect() == []


def test_asof_does_not_sort_left_rows(spark):
    left = spark.range(1000).select("id", F.lit("a").alias("city"), F.current_date().alias("d"))
    right = spark.createDataFrame([("a", DAY, 1)], "city string, since date, size int")
    plan = T.asof_join(left, right, ["city"], "d", "since", ["size"])._jdf.queryExecution().optimizedPlan().toString()
    window = plan.index("Window")
    assert plan.count("Window") == 1 and "Range (0, 1000" in plan and "distinct" not in plan.lower()[:window]


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(2)

    def period():
        first = rng.randrange(-2000, 6000)
        return first, first + rng.choice([0, 0, 3, 40, 400, 5000, -5])

    left = [(k, rng.choice(["a", "a", "b", None]), *map(day, period())) for k in range(150)] + [(999, "a", None, DAY)]
    right = [(rng.choice(["a", "b", "c"]), *map(day, period()), k) for k in range(150)] + [("a", DAY, None, 999)]
    got = T.interval_join(
        spark.createDataFrame(left, "n int, c string, f date, l date"),
        spark.createDataFrame(right, "c string, f date, l date, m int"),
        ["c"], ("f", "l"), ("f", "l"),
    )
    want = [
        (*x, y[1], y[2], y[3])
        for x in left
        for y in right
        if None not in (*x[1:], *y[:3]) and x[1] == y[0] and x[2] <= x[3] and y[1] <= y[2] and x[2] <= y[2] and y[1] <= x[3]
    ]
    assert got.columns == ["n", "c", "f", "l", "right_f", "right_l", "m"]
    assert Counter(map(tuple, got.collect())) == Counter(want) and len(want) > 500


def test_snapshot_diff_equals_brute_force(spark):
    rng = random.Random(3)
    row = lambda: (rng.choice([None, *range(40)]), rng.choice(["x", "", None, "1:x"]), rng.choice([None, 1, 12]))
    old = [row() for _ in range(120)]
    new = rng.sample(old, 100) + [row() for _ in range(20)] + [old[0]] * 2
    schema = "k int, a string, b int"
    got = T.snapshot_diff(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["k"], ["a", "b"]).collect()
    want = {}
    for k in {r[0] for r in old + new}:
        before, after = Counter(r for r in old if r[0] == k), Counter(r for r in new if r[0] == k)
        if before != after:
            change = "new" if not before else "gone" if not after else "changed"
            want[k] = (change, before.total(), after.total(), (before & after).total())
    assert {r["k"]: tuple(r[1:]) for r in got} == want
    empty = spark.createDataFrame([], schema)
    assert T.snapshot_diff(empty, empty, ["k"], ["a", "b"]).collect() == []


def test_rows_without_others(spark):
    rows = spark.createDataFrame([(1, None), (1, "a"), (1, "a"), (None, None)], "k int, a string")
    other = spark.createDataFrame([(1, None)], "k int, a string")
    got = T.without(rows, [other, rows.where("k IS NULL")], ["k", "a"]).collect()
    assert [tuple(r) for r in got] == [(1, "a"), (1, "a")]
