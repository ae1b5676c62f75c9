from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import demography as D
from parcelwise.operators import kpi as K
from parcelwise.operators import star as R


def test_match_city_first_wins(spark):
    df = spark.createDataFrame([("Powiat m. ŁÓDŹ",), ("Powiat lubliniecki",), ("Gmina X",), ("Radom i Lublin",)], "unit string")
    got = {r["unit"]: r["Glowne_Miasto"] for r in D.match_city(df, "unit").collect()}
    assert got == {"Powiat m. ŁÓDŹ": "Łódź", "Powiat lubliniecki": "Lublin", "Radom i Lublin": "Lublin"}


def test_merge_indicators(spark):
    df = spark.createDataFrame(
        [("u", "c", "d1", "Zgony_Ogol", 5.0, 2), ("u", "c", "d1", "Zgony_Ogol", 4.0, 1), ("u", "c", "d2", "Oferty_Pracy", 1.0, 3)],
        "Miasto_GUS string, Glowne_Miasto string, Data string, indicator string, value double, o int",
    )
    wide = D.merge_indicators(df, ["o"])
    assert wide.columns == ["Miasto_GUS", "Glowne_Miasto", "Data", *D.INDICATORS]
    got = {r["Data"]: (r["Zgony_Ogol"], r["Oferty_Pracy"]) for r in wide.collect()}
    assert got == {"d1": (4.0, None), "d2": (None, 1.0)}


DEMO = (
    "miasto_gus string, glowne_miasto string, data string, populacja_ogolna int, populacja_mezczyzni int, "
    "populacja_kobiety int, zarejestrowani_bezrobotni int, przecietne_wynagrodzenie_brutto decimal(10,2), dochody_wlasne_jst decimal(10,2)"
)


def test_merge_demography(spark):
    df = spark.createDataFrame(
        [
            ("Powiat A", "A", "2024-12-31", None, 9, 9, None, Decimal("100.00"), None),
            ("Powiat m. A", "A", "2024-12-31", 99, 3, 4, 5, None, None),
            ("Powiat m. B", "B", "2024-12-31", 99, 3, None, 5, None, None),
        ],
        DEMO,
    )
    got = [tuple(r) for r in D.merge_demography(df).collect()]
    assert got == [("Powiat m. A", "A", "2024-12-31", 70, 30, 40, 5, Decimal("100.00"), None)]


def test_surrogate_keys_are_dense_and_stable(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    one = {r["k"]: r["key"] for r in R.surrogate_key(df.repartition(3), "key", ["k"]).collect()}
    two = {r["k"]: r["key"] for r in R.surrogate_key(df.repartition(11).orderBy(F.desc("k")), "key", ["k"], 2).collect()}
    assert one == two
    assert sorted(one.values()) == list(range(1, 5001))


def test_deviation_ignores_null_groups(spark):
    df = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 1, 30.0), ("a", None, 30.0), ("a", None, 10.0), ("b", 1, None)], "c string, rooms int, price_per_sqm double"
    )
    got = K.price_deviation(df, ["c", "rooms"])
    assert sorted(((r[1], r[2], r["price_deviation"]) for r in got.collect()), key=str) == sorted(
        [(1, 10.0, -0.5), (1, 30.0, 0.5), (None, 30.0, None), (None, 10.0, None), (1, None, None)], key=str
    )
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_premium(spark):
    df = spark.createDataFrame(
        [("sell", 16, 10.0), ("sell", 15, 4.0), ("sell", None, 99.0), ("rent", 3, 2.0), ("swap", 20, 50.0)],
        "listing_type string, poicount int, price_per_sqm double",
    )
    got = {r["listing_type"]: r["location_premium"] for r in K.location_premium(df).collect()}
    assert got == {"sell": 6.0, "rent": -2.0, "swap": -2.0}


def test_rent_to_wage(spark):
    df = spark.createDataFrame(
        [("rent", 100.0, 50.0), ("sell", 100.0, 50.0), ("rent", 100.0, 0.0), ("rent", 100.0, None)],
        "listing_type string, price double, przecietne_wynagrodzenie_brutto double",
    )
    assert [r[0] for r in df.select(K.rent_to_wage()).collect()] == [2.0, None, None, None]


def test_wage_takes_the_latest_city_county_row(spark):
    df = spark.createDataFrame(
        [(1, "Powiat m. A", "Łódź", "2024-06-30", 1), (2, "Powiat m. A", "ŁÓDŹ ", "2024-12-31", 2), (3, "Powiat A", "Łódź", "2024-12-31", 3)],
        "ID_Demografii int, Miasto_GUS string, Glowne_Miasto string, Data string, Przecietne_Wynagrodzenie_Brutto int",
    )
    assert [tuple(r) for r in R.wage_by_city_year(df).collect()] == [("lodz", 2024, 2, 2)]


@pytest.mark.parametrize("column", ["busstopDistance", "caffeDistance", "parkingDistance"])
def test_optional_distances_are_null(spark, column):
    have = [c for c in R.INFRASTRUCTURE_COLUMNS.values() if c not in R.OPTIONAL_COLUMNS]
    df = spark.range(1).select(F.lit(1).alias("row_id"), *[F.lit("1").alias(c) for c in have])
    dim = R.dim_infrastructure(df)
    assert dict(dim.dtypes)[column] == "decimal(10,2)" and dim.first()[column] is None


def test_keys_that_stand_once_carry_no_other_columns(spark):
    df = spark.range(200).selectExpr("id AS k", "id % 7 AS wide", "id % 5 AS v")
    once = R.surrogate_key(df, "key", ["k"]).select("key", "v")
    assert "wide" not in once._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["key"] for r in once.collect()) == list(range(1, 201))


def test_repeated_keys_follow_the_other_columns(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 9), (None, 2)], "k string, v int")
    got = sorted((r["key"], r["v"]) for r in R.surrogate_key(df.repartition(3), "key", ["k"]).select("key", "v").collect())
    assert [v for _, v in got if v != 9] == [1, 2, 3] and [n for n, _ in got] == [1, 2, 3, 4]


def test_surrogate_keys_of_no_rows(spark):
    assert R.surrogate_key(spark.range(0).selectExpr("id AS k"), "key", ["k"]).count() == 0
