import random

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import poi as N
from parcelwise.operators import rollup as U
from parcelwise.operators.quality import REASON
from parcelwise.plans import incremental as M
from parcelwise.plans import jobs
from parcelwise.sources import files as X
from parcelwise.sources.observed import RowCounts, files_report, watch_files, watch_rejects
from parcelwise.streaming import intake


def test_nearest_poi_equals_brute_force(spark):
    """Far places, a crowded cell, places at the very point, ties, kinds without points, missing coordinates."""
    rng = random.Random(5)
    points = [(rng.choice(["cafe", "stop"]), f"n{k}", None, str(k), round(50 + rng.random() * 3, 3), round(20 + rng.random(), 3)) for k in range(150)]
    points += [("cafe", f"c{k}", "s", "1", 52.0 + (k % 40) * 1e-5, 21.0 + (k // 40) * 1e-5) for k in range(400)]
    points += [("stop", "tie b", "s", "1", 60.0, 21.0), ("stop", "tie a", "s", "1", 60.0, 21.0), ("cafe", "none", "s", "1", None, 21.0), ("other", "x", "s", "1", 52.0, 21.0)]
    places = [(k, round(48 + rng.random() * 8, 4), round(18 + rng.random() * 6, 4)) for k in range(60)]
    places += [(100, 52.0002, 21.0001), (101, 52.0, 21.0), (102, -40.0, 170.0), (103, 61.0, 21.0), (104, None, 21.0), (105, 52.0, 21.0)]
    df = spark.createDataFrame(places, "k int, latitude double, longitude double")
    poi = spark.createDataFrame(points, "poi_type string, name string, street string, number string, lat double, lon double")
    got = {(r["latitude"], r["longitude"], r["poi_type"]): (r["dist"], r["near"]["name"]) for r in N.nearest_poi(df, poi, ["cafe", "stop", "gym"]).collect()}
    want = {}
    for _, y, x in places:
        for kind in ("cafe", "stop"):
            if y is not None:
                near = min((((p[4] - y) ** 2 + (p[5] - x) ** 2) ** 0.5, p[1]) for p in points if p[0] == kind and p[4] is not None)
                want[y, x, kind] = near
    assert {k: (pytest.approx(d), n) for k, (d, n) in want.items()} == got
    wide = {r["k"]: r for r in N.with_poi_distances(df, poi, {"cafedistance": "cafe", "gymdistance": "gym"}).collect()}
    assert len(wide) == len(places) and wide[104]["cafedistance"] is None and wide[101]["cafedistance"] == 0 and wide[101]["gymdistance"] is None
    assert N.nearest_poi(df, poi.limit(0), ["cafe"]).collect() == [] and N.nearest_poi(df.limit(0), poi, ["cafe"]).collect() == []


def test_nearest_poi_takes_two_searches_however_far(spark, monkeypatch):
    searches, search = [], N.nearest_neighbors
    monkeypatch.setattr(N, "nearest_neighbors", lambda *a, **k: searches.append(a[3]) or search(*a, **k))
    df = spark.createDataFrame([(0.0, 0.0), (0.5, 0.0), (80.0, 170.0)], "latitude double, longitude double")
    poi = spark.createDataFrame([("cafe", "a", "s", "1", 0.0, 0.001)], "poi_type string, name string, street string, number string, lat double, lon double")
    got = {r["latitude"]: r["dist"] for r in N.nearest_poi(df, poi, ["cafe"]).collect()}
    assert got == {0.0: pytest.approx(0.001), 0.5: pytest.approx((0.25 + 1e-6) ** 0.5), 80.0: pytest.approx((6400 + 169.999**2) ** 0.5)}
    assert len(searches) == 2


def test_counts_come_out_of_the_write(spark, tmp_path):
    rows = [("a.csv", ""), ("a.csv", "bad"), ("b.csv", "bad"), ("b.csv", "worse")]
    # A row that is counted in a second run of the plan would be counted twice here.
    passed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, f"source_file string, `{REASON}` string").mapInArrow(seen, f"source_file string, `{REASON}` string")
    counts = RowCounts()
    watched = watch_files(counts, df, "x", ["a.csv", "b.csv", "c.csv"], "source_file")
    X.write_rejects(watched, f"{tmp_path}/rejects")
    report = files_report(counts, df, "x", ["a.csv", "b.csv", "c.csv"], "source_file").collect()
    assert sorted(map(tuple, report)) == [("a.csv", 1, 1, False), ("b.csv", 0, 2, True)]
    assert passed.value == len(rows)


def test_columns_of_accepted_rows_are_not_made_where_only_rejects_are_written(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def wide(k: int) -> str:
        made.add(1)
        return f"row {k}"

    rows = [("a.csv", k, "" if k % 10 else "bad") for k in range(100)] + [("b.csv", 100, "worse"), (None, 101, "bad")]
    df = spark.createDataFrame(rows, f"source_file string, k int, `{REASON}` string")
    validated = df.select("source_file", F.udf(wide, "string")("k").alias("wide"), REASON)
    counts = RowCounts()
    X.write_rejects(watch_rejects(counts, validated, "x", ["a.csv", "b.csv", "c.csv"], "source_file"), f"{tmp_path}/rejects")
    report = files_report(counts, validated, "x", ["a.csv", "b.csv", "c.csv"], "source_file").collect()
    assert sorted(map(tuple, report)) == [("a.csv", 90, 10, False), ("b.csv", 0, 1, True)]
    assert counts.of("x")["rows"] == len(rows) and made.value == 12
    back = spark.read.option("header", True).csv(f"{tmp_path}/rejects")
    assert sorted(r["wide"] for r in back.collect()) == sorted(f"row {k}" for _, k, reason in rows if reason)


def test_check_job_runs_its_plan_once(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "all_apartments_sell.csv").write_text("id,source_date,squareMeters,price\n1,2024-01,50,100\n2,2024-01,5,100\n")
    (raw / "all_apartments_rent.csv").write_text("id,source_date,squareMeters,price\n1,2024-01,50,100\n")
    (raw / "baza_bi_miasta_2020.csv").write_text("Miasto_GUS,Glowne_Miasto,Data,Populacja_Ogolna\nA,A,2020-12-31,5\n")
    for name in X.POI_FILES.values():
        (raw / name).write_text("City;LAT;LON;Name\nA;50;20;x\nA;50;20;x\n")
    monkeypatch.setattr(jobs, "quality_report", None)
    assert jobs.check(spark, str(raw), str(tmp_path / "out")) == {"listings": (2, 1), "demography": (1, 0), "poi": (3, 3)}


def listings(spark, rows):
    return spark.createDataFrame(rows, "id string, listing_type string, source_date string, city string, rooms int, type string, squaremeters double, price double, poicount int")


def offer(rng, k, month):
    return (f"i{k}", rng.choice(["sell", "rent"]), month, rng.choice(["A", "B"]), rng.choice([1, None]), "t", rng.choice([10.0, 0.0, 40.0]), float(rng.randrange(100, 900)), rng.choice([None, 3, 30]))


def test_months_one_by_one_equal_all_at_once(spark, tmp_path):
    rng = random.Random(6)
    months = ["2024-01", "2024-02", "2024-03", "2024-04"]
    rows = [offer(rng, k, m) for m in months for k in range(20)] + [offer(rng, 0, None)]
    M.load_months(listings(spark, rows), f"{tmp_path}/all")
    for month in ("2024-03", "2024-01"):
        M.load_months(listings(spark, [r for r in rows if r[2] == month]), f"{tmp_path}/some")
    M.load_months(listings(spark, [offer(rng, k, "2024-02") for k in range(50)]), f"{tmp_path}/some")  # a wrong delivery
    M.load_months(listings(spark, [r for r in rows if r[2] in ("2024-02", "2024-04", None)]), f"{tmp_path}/some")
    M.load_months(listings(spark, []), f"{tmp_path}/some")

    def read(name):
        facts = M.read_facts(spark, f"{tmp_path}/{name}")
        return sorted(map(str, facts.select("offer_key", "id", "source_date", F.round("price_deviation", 9), "location_premium").collect()))

    assert read("some") == read("all") and len(read("all")) == 80
    keys = M.read_facts(spark, f"{tmp_path}/all").select("id", "listing_type", "source_date", "offer_key").distinct()
    assert keys.select("offer_key").distinct().count() == keys.count()


def test_a_load_computes_its_listings_once(spark, tmp_path):
    rng = random.Random(8)
    rows = [offer(rng, k, m) for m in ("2024-01", "2024-02") for k in range(20)]
    passed, df = spark.sparkContext.accumulator(0), listings(spark, rows)

    def seen(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    M.load_months(df.mapInArrow(seen, df.schema), f"{tmp_path}/star")
    assert passed.value == len(rows)
    assert M.read_facts(spark, f"{tmp_path}/star").count() == len(rows)


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    def deliver(name, rows):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("id,price\n" + "".join(f"{i},{p}\n" for i, p in rows))

    def run():
        rows = intake.monthly_stream(spark, str(tmp_path / "in"), ["id", "price"], files_at_once=1)
        intake.take_in(rows, str(tmp_path / "out"), str(tmp_path / "state"))
        return sorted((r["source_date"], r["listing_type"], r["id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    deliver("apartments_pl_2024_01.csv", [(1, 5), (2, 5), (1, 5)])
    assert run() == [("2024-01", "sell", "1"), ("2024-01", "sell", "2")]
    assert run() == [("2024-01", "sell", "1"), ("2024-01", "sell", "2")]
    deliver("apartments_rent_pl_2024_02.csv", [(1, 5)])
    deliver("again_apartments_pl_2024_01.csv", [(2, 5), (3, 5)])
    deliver("apartments_pl_latest.csv", [(9, 9)])
    assert run() == [("2024-01", "sell", "1"), ("2024-01", "sell", "2"), ("2024-01", "sell", "3"), ("2024-02", "rent", "1")]


def test_rollup_tells_null_from_rolled_up(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", "x", 3.0), ("a", "x", None)], "c string, t string, price_per_sqm double")
    got = sorted(map(str, U.rollup_measures(df, ["c", "t"], [["c", "t"], ["c"], []]).collect()))
    want = [("a", None, 0, 1, 1, 1.0), ("a", "x", 0, 2, 1, 3.0), ("a", None, 1, 3, 2, 2.0), (None, None, 3, 3, 2, 2.0)]
    assert got == sorted(f"Row(c={c!r}, t={t!r}, level={n}, offers={o}, priced={p}, mean={m})" for c, t, n, o, p, m in want)


def test_summaries_merge_within_their_error(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("city"), (F.col("id") % 12).alias("source_date"),
        F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(10**6)) / 100.0).alias("v"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(30_000)).alias("item"),
    )
    answers = U.approx_city_median(df, "v")
    for r in U.rank_of(df, ["city"], "v", answers, "median").collect():
        assert abs(r["below"] - r["n"] / 2) <= U.RANK_ERROR * r["n"]
    months = df.withColumn("m", F.add_months(F.lit("2024-01-01").cast("date"), F.col("source_date").cast("int")))
    got = U.distinct_in_span(U.distinct_sketches(months, ["city", "m"], "item"), ["city"], "m", "2024-02-01", "2024-07-01")
    exact = dict(months.where("m BETWEEN '2024-02-01' AND '2024-07-01'").groupBy("city").agg(F.count_distinct("item")).collect())
    assert all(abs(r["items"] - exact[r["city"]]) <= U.COUNT_ERROR * exact[r["city"]] for r in got.collect())


def test_files_in_name_order_give_the_order(spark, tmp_path):
    rows = [(random.Random(k).randrange(50), k) for k in range(500)] + [(7, 1)] * 300
    X.write_sorted(spark.createDataFrame(rows, "a int, b int"), f"{tmp_path}/t", ["a"], 6)
    files = sorted((tmp_path / "t").glob("part-*"))
    back = [(r["a"], r["b"]) for f in files for r in spark.read.parquet(str(f)).collect()]
    assert len(files) > 3 and back == sorted(rows)
    placed = X.read_sorted(spark, f"{tmp_path}/t").orderBy("place").collect()
    assert [(r["a"], r["b"]) for r in placed] == sorted(rows) and [r["place"] for r in placed] == list(range(1, 801))


def test_poi_search_starts_finely_and_leaves_what_it_found(spark, tmp_path, monkeypatch):
    """Fewer steps for the driver to plan: far places begin with 256 cells, and tables of the steps go."""
    steps, write = [], N.written

    def counted(df, path):
        steps.append(path.split("/")[-2:])
        return write(df, path)

    monkeypatch.setattr(N, "scratch_folder", lambda spark: str(tmp_path / "poi"))
    monkeypatch.setattr(N, "written", counted)
    monkeypatch.setattr("parcelwise.operators.spatial.written", counted)
    df = spark.createDataFrame([(k, 0.0, 0.5 * k) for k in range(4)] + [(9, None, 0.0)], "k int, latitude double, longitude double")
    poi = spark.createDataFrame([("cafe", "a", "s", "1", 0.0, 0.001)], "poi_type string, name string, street string, number string, lat double, lon double")
    got = {r["k"]: r["cafedistance"] for r in N.with_poi_distances(df, poi, {"cafedistance": "cafe"}).collect()}
    assert got == {0: pytest.approx(0.001), 1: pytest.approx(0.499), 2: pytest.approx(0.999), 3: pytest.approx(1.499), 9: None}
    assert [n for at, n in steps if at == "search_1" and n.startswith("cells")] == ["cells_16"] and len(steps) == 13
    assert {p.name.split("_")[0] for at in (tmp_path / "poi").iterdir() for p in at.iterdir()} == {"near"}


def test_months_are_loaded_in_turns(spark, tmp_path, monkeypatch):
    """One month a turn gives what one turn for all gives; the load's own table goes and no shuffle outlives its write."""
    rng, kept = random.Random(11), []
    schema = "id int, city string, rooms int, type string, listing_type string, price double, squaremeters double, poicount int, source_date string"
    rows = [
        (k, rng.choice(["x", None]), rng.choice([2, None]), "flat", rng.choice(["sell", "rent"]), 100.0 + k, 10.0, rng.choice([1, 50, None]), rng.choice(["2024-01", "2024-02", "2024-03", None]))
        for k in range(90)
    ]
    df = spark.createDataFrame(rows + rows[:5], schema)
    M.load_months(df, f"{tmp_path}/at_once", ["id", "source_date"])
    monkeypatch.setattr(M, "TURN_ROWS", 1)
    folder = lambda spark: kept.append(f"{tmp_path}/scratch_{len(kept)}") or kept[-1]
    monkeypatch.setattr(M, "scratch_folder", folder)
    M.load_months(df, f"{tmp_path}/in_turns", ["id", "source_date"])
    assert len(kept) == 1 and not (tmp_path / "scratch_0").exists()
    read = [sorted(map(str, M.read_facts(spark, f"{tmp_path}/{name}").collect())) for name in ("at_once", "in_turns")]
    assert read[0] == read[1] and len(read[0]) == sum(r[8] is not None for r in rows + rows[:5])
    assert M._in_turns([("a", 3), ("b", 3), ("c", 9), ("d", 1)], 6) == [["a", "b"], ["c"], ["d"]] and M._in_turns([], 6) == []


def test_stream_keeps_its_state_out_of_the_heap(spark, tmp_path, monkeypatch):
    """A new checkpoint keeps its state in RocksDB; one that began otherwise goes on, and settings of the session stay."""
    def deliver(at, name, ids):
        (tmp_path / at).mkdir(exist_ok=True)
        (tmp_path / at / name).write_text("id,price\n" + "".join(f"{k},5\n" for k in ids))

    def run(at):
        before = {k: spark.conf.get(k, None) for k in intake.STATE}
        intake.take_in(intake.monthly_stream(spark, str(tmp_path / at), ["id", "price"]), f"{tmp_path}/{at}_out", f"{tmp_path}/{at}_state")
        assert before == {k: spark.conf.get(k, None) for k in before}
        return sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/{at}_out").collect())

    deliver("new", "apartments_pl_2024_01.csv", [1, 2, 2])
    assert run("new") == ["1", "2"] and "RocksDBStateStoreProvider" in (tmp_path / "new_state" / "offsets" / "0").read_text()
    deliver("old", "apartments_pl_2024_01.csv", [1, 2, 2])
    with monkeypatch.context() as m:
        m.setattr(intake, "STATE", {})
        assert run("old") == ["1", "2"]
    for at in ("new", "old"):
        deliver(at, "more_apartments_pl_2024_01.csv", [2, 3])
        assert run(at) == ["1", "2", "3"]
