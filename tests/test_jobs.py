"""Raw files to star schema, end to end."""

import random

import pytest
from pyspark.sql import functions as F

from parcelwise.operators.quality import REASON, QualityError
from parcelwise.operators.staging import AMENITY_COLUMNS, DISTANCE_COLUMNS, LISTING_COLUMNS, conform_columns
from parcelwise.plans import jobs
from parcelwise.sources import files, jdbc

HEADER = (
    "id,city,type,squareMeters,rooms,floor,floorCount,buildYear,latitude,longitude,centreDistance,poiCount,"
    "schoolDistance,clinicDistance,postOfficeDistance,kindergartenDistance,restaurantDistance,collegeDistance,"
    "pharmacyDistance,ownership,buildingMaterial,condition,hasParkingSpace,hasBalcony,hasElevator,hasSecurity,"
    "hasStorageRoom,price,source_date"
)


def listing_lines(kind, n):
    rng = random.Random(kind)
    for i in range(n):
        month = f"2024-0{1 + i % 3}" if i % 3 < 2 else "2024-06"
        area = "300.9" if i == 5 else "9" if i == 6 else str(rng.randint(20, 120))
        price = "x" if i == 7 else str(rng.randint(1000, 9000))
        distances = ["" if rng.random() < 0.3 else str(round(rng.uniform(0, 5), 3)) for _ in range(8)]
        flags = ["" if rng.random() < 0.2 else rng.choice(["yes", "no"]) for _ in range(5)]
        yield ",".join([
            f"{kind}{i // 3}", rng.choice(["Łódź", "łódź ", "Radom"]), "blockOfFlats", area, rng.choice(["2", "3.0", ""]),
            rng.choice(["", "4"]), "5", rng.choice(["", "1980"]), str(51 + rng.randint(0, 40) / 1000), str(19 + rng.randint(0, 40) / 1000),
            distances[0], rng.choice(["", "10", "20"]), *distances[1:], "condominium", rng.choice(["", "brick"]), rng.choice(["", "low"]),
            *flags, price, "" if i == 8 else month,
        ])


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for kind in ("sell", "rent"):
        (folder / f"all_apartments_{kind}.csv").write_text("\n".join([HEADER, *listing_lines(kind, 90)]) + "\n")
    demo = "﻿Miasto_GUS,Glowne_Miasto,Data,Populacja_Ogolna,Populacja_Mezczyzni,Populacja_Kobiety,Zarejestrowani_Bezrobotni,Przecietne_Wynagrodzenie_Brutto,Dochody_Wlasne_JST,Oferty_Pracy\n"
    demo += "Powiat m. Łódź,Łódź,2024-12-31,10,4,6,1,,,\nPowiat m. Łódź,Łódź,2024-12-31,11,5,6,1,,,\nPowiat łódzki,Łódź,2024-12-31,,,,,5000.5,,3\n"
    (folder / "baza_bi_miasta_2023_2024.csv").write_text(demo, encoding="utf-8")
    poi = "﻿City;Name;Street;Number;LAT;LON\nŁódź;;Main;1;51.1;19.2\nŁódź;B;Main;1;51.1;19.2\nŁódź;C;;;-1;19.2\n"
    for name in files.POI_FILES.values():
        (folder / name).write_text(poi, encoding="utf-8")
    return str(folder)


def test_check(spark, raw, tmp_path):
    counts = jobs.check(spark, raw, str(tmp_path / "rejected"))
    assert counts == {"listings": (172, 8), "demography": (1, 2), "poi": (3, 6)}
    poi = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "rejected/poi"))
    assert sorted((r["Name"], r[REASON]) for r in poi.filter("source_file = 'all_cafes.csv'").collect()) == [
        ("B", "duplikat"), ("C", "lat_invalid"),
    ]
    demography = spark.read.option("header", True).csv(str(tmp_path / "rejected/demography"))
    assert sorted(r[REASON] for r in demography.collect()) == ["duplikat", "populacja_invalid"]


def test_check_fails_for_a_wholly_rejected_file(spark, raw, tmp_path):
    with open(f"{raw}/all_cafes.csv", "w") as f:
        f.write("City;Name;Street;Number;LAT;LON\n;x;;;1;1\n")
    with pytest.raises(QualityError, match="all_cafes.csv: every row rejected"):
        jobs.check(spark, raw, str(tmp_path / "rejected"))


def test_stage_clean_load(spark, raw, tmp_path):
    jobs.stage(spark, raw, jobs.parquet_in(str(tmp_path / "staged")))
    staged = {n: spark.read.parquet(str(tmp_path / f"staged/{n}")) for n in ("listings", "demography", "poi")}
    assert tuple(staged["listings"].columns) == LISTING_COLUMNS
    assert staged["listings"].count() == 172
    assert staged["poi"].count() == 6
    assert staged["demography"].count() == 2

    gaps = jobs.clean(spark, staged["demography"], staged["listings"], jobs.parquet_in(str(tmp_path / "clean")))
    assert [tuple(r) for r in gaps.collect()] == [("2024-02-01", "2024-06-01", 4)]
    clean = {n: spark.read.parquet(str(tmp_path / f"clean/{n}")) for n in ("listings", "demography")}
    listings = clean["listings"].cache()
    assert listings.count() == 172
    filled = [*DISTANCE_COLUMNS, *AMENITY_COLUMNS, "buildyear", "buildingmaterial", "condition"]
    assert listings.filter(" OR ".join(f"{c} IS NULL OR {c} = 'brak informacji'" if c.startswith(("building", "cond")) else f"{c} IS NULL" for c in filled)).count() == 0

    jobs.load(spark, clean["demography"], listings, jobs.parquet_in(str(tmp_path / "star"), {"Dim_Lokal": ("listing_type",)}))
    star = {p.name: spark.read.parquet(str(p)) for p in (tmp_path / "star").iterdir()}
    fact = star["Fact_Oferta_Nieruchomosci"]
    assert fact.count() == 172 == fact.select("ID_Faktu").distinct().count()
    for dim, key in [("Dim_Lokal", "ID_Lokalu"), ("Dim_Budynek", "ID_Budynku"), ("Dim_Infrastruktura", "ID_Infrastruktury"), ("Dim_Czas", "ID_Czasu")]:
        assert star[dim].select(key).distinct().count() == star[dim].count()
        assert fact.join(star[dim], key, "left_anti").count() == 0
    known = fact.filter("ID_Demografii IS NOT NULL").join(star["Dim_Lokal"], "ID_Lokalu")
    assert {r["city"].strip().lower() for r in known.select("city").distinct().collect()} == {"łódź"}
    ratios = known.filter("listing_type = 'rent'").select(
        F.max(F.abs(F.col("Stosunek_Najmu_Do_Wynagrodzenia") - F.round(F.col("price") / 5000.5, 4)))
    )
    assert ratios.first()[0] < 1e-4
    assert known.filter("listing_type = 'sell' AND Stosunek_Najmu_Do_Wynagrodzenia IS NOT NULL").count() == 0


def test_monthly_files(spark, tmp_path):
    for name in ("apartments_pl_2024_04.csv", "apartments_rent_pl_2024_05.csv", "apartments_pl_latest.csv"):
        (tmp_path / name).write_text("id,price\n1,5\n")
    df = files.read_monthly_listings(spark, f"{tmp_path}/*.csv")
    assert sorted((r["source_date"], r["listing_type"]) for r in df.collect()) == [("", "sell"), ("2024-04", "sell"), ("2024-05", "rent")]


def test_header_in_other_order_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        files.read_delimited(spark, str(tmp_path / "x.csv"), columns=["a", "b"]).collect()


def test_conform(spark):
    df = spark.createDataFrame([(1, "x")], "Bb int, C string")
    out = conform_columns(df, ["d", "b2", "e"], {"Bb": "b2", "C": "D"}, {"e": "double"})
    assert out.dtypes == [("d", "string"), ("b2", "int"), ("e", "double")]
    with pytest.raises(ValueError, match="missing"):
        conform_columns(df, ["nope"])


def test_jdbc_options():
    read = jdbc.read_options("u", "stg.t", "id", 1, 100, 8, properties={"user": "me"})
    assert read == {
        "url": "u", "dbtable": "stg.t", "fetchsize": "10000", "user": "me", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "100", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        jdbc.read_options("u", "t", "id")
    assert jdbc.write_options("u", "t", "overwrite")["truncate"] == "true"
    assert "truncate" not in jdbc.write_options("u", "t", "append")
    with pytest.raises(ValueError):
        jdbc.write_options("u", "t", "ignore")


def test_dates_become_text_for_jdbc(spark):
    df = spark.sql("SELECT DATE'2024-04-01' AS d, 1 AS n")
    assert jdbc.dates_as_text(df).dtypes == [("d", "string"), ("n", "int")]


def test_files_are_read_by_their_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,wage,jobless\n"Bar ""U; Jana"", 1",1.00,6000\n')
    (tmp_path / "b.csv").write_text("\ufeffjobless,name,extra,wage\n7000,x,e,2.00\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("name\ny\n")
    (tmp_path / "d.csv").write_text("")
    df = files.read_delimited(spark, f"{tmp_path}/*.csv", file_column="f")
    assert sorted((r["f"], r["name"], r["wage"], r["jobless"], r["extra"]) for r in df.collect()) == [
        ("a.csv", 'Bar "U; Jana", 1', "1.00", "6000", None), ("b.csv", "x", "2.00", "7000", "e"), ("c.csv", "y", None, None, None),
    ]
    assert [(f.name, len(f.columns)) for f in files.list_delimited(spark, f"{tmp_path}/*.csv")] == [("a.csv", 3), ("b.csv", 4), ("c.csv", 1), ("d.csv", 0)]
    with pytest.raises(FileNotFoundError):
        files.read_delimited(spark, f"{tmp_path}/none*.csv")


def test_rejects_keep_quotes(spark, tmp_path):
    df = spark.createDataFrame([('say ""hi"" \\ "x";', "bad", "f.csv")], f"t string, {REASON} string, source_file string")
    files.write_rejects(df, str(tmp_path / "out"), ";")
    back = files.read_delimited(spark, str(tmp_path / "out/source_file=f.csv"), ";")
    assert back.first()["t"] == 'say ""hi"" \\ "x";'


def test_check_names_every_bad_file_and_keeps_rejects(spark, raw, tmp_path):
    rent = (tmp_path / "raw/all_apartments_rent.csv").read_text().splitlines()
    cut = [",".join(line.split(",")[:-1]) for line in rent]
    (tmp_path / "raw/all_apartments_rent.csv").write_text("\n".join(cut) + "\n")
    (tmp_path / "raw/baza_bi_miasta_2023_2025.csv").write_text("")
    (tmp_path / "raw/all_bus_stops.csv").write_text("City;Name;Street;Number;LAT;LON\n")
    with open(f"{raw}/all_cafes.csv", "w") as f:
        f.write("City;Name;Street;Number;LAT;LON\n;x;;;1;1\n")
    (tmp_path / "raw/all_parkings.csv").unlink()
    with pytest.raises(QualityError) as error:
        jobs.check(spark, raw, str(tmp_path / "rejected"))
    assert sorted(str(error.value).split("; ")) == [
        "all_apartments_rent.csv: columns missing: source_date", "all_bus_stops.csv: empty file",
        "all_cafes.csv: every row rejected", "all_parkings.csv: no such file", "baza_bi_miasta_2023_2025.csv: empty file",
    ]
    poi = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "rejected/poi"))
    assert {(r["source_file"], r[REASON]) for r in poi.collect()} == {("all_cafes.csv", "brak_City")}
    assert (tmp_path / "rejected/listings").exists()


@pytest.mark.parametrize(("stage", "columns", "missing"), [
    ("stage_listings", "id string, city string, price string", "squaremeters"),
    ("stage_poi", "City string, LAT string", "lon"),
    ("stage_demography", "Miasto_GUS string, Data string", "glowne_miasto"),
])
def test_missing_required_columns_are_named(spark, stage, columns, missing):
    from parcelwise.operators import staging

    with pytest.raises(ValueError, match=missing):
        getattr(staging, stage)(spark.createDataFrame([], columns))


def test_newer_demography_file_wins(spark, raw, tmp_path):
    newer = "Glowne_Miasto,Miasto_GUS,Data,Populacja_Ogolna\nŁódź,Powiat m. Łódź,2024-12-31,99\n"
    (tmp_path / "raw/baza_bi_miasta_2023_2025.csv").write_text(newer)
    jobs.stage(spark, raw, jobs.parquet_in(str(tmp_path / "staged")))
    rows = spark.read.parquet(str(tmp_path / "staged/demography")).filter("miasto_gus = 'Powiat m. Łódź'")
    assert [r["populacja_ogolna"] for r in rows.collect()] == [99]


def test_monthly_files_become_listing_files(spark, tmp_path):
    for name, price in (("apartments_pl_2024_04.csv", 5), ("apartments_rent_pl_2024_05.csv", 6), ("apartments_rent_pl_2024_06.csv", 7)):
        (tmp_path / name).write_text(f'id,city,price\n1,"a ""b"", c",{price}\n')
    jobs.collect(spark, str(tmp_path), str(tmp_path / "raw"))
    rows = files.read_listings(spark, str(tmp_path / "raw")).collect()
    assert sorted((r["listing_type"], r["source_date"], r["city"], r["price"]) for r in rows) == [
        ("rent", "2024-05", 'a "b", c', "6"), ("rent", "2024-06", 'a "b", c', "7"), ("sell", "2024-04", 'a "b", c', "5"),
    ]


def test_database_sink_is_wired(monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "write_jdbc", lambda df, url, table, mode, properties: seen.append((df, url, table, mode, properties)))
    jobs.jdbc_in("jdbc:u", "stg", {"user": "me"})("frame", "listings")
    assert seen == [("frame", "jdbc:u", "stg.listings", "overwrite", {"user": "me"})]
