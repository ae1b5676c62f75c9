"""Demography: city matching, wide table from indicator rows, one row per city and date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scalars import contains_any, is_blank

# The cities covered and the indicators collected, in their order.
CITIES = (
    "Warszawa", "Kraków", "Łódź", "Wrocław", "Poznań", "Gdańsk", "Szczecin", "Bydgoszcz",
    "Lublin", "Białystok", "Gdynia", "Katowice", "Radom", "Rzeszów", "Częstochowa",
)
INDICATORS = (
    "Populacja_Ogolna", "Populacja_Mezczyzni", "Populacja_Kobiety", "Urodzenia_Zywe",
    "Zgony_Ogol", "Saldo_Migracji", "Przyrost_Naturalny", "Pracujacy_Ogol",
    "Zarejestrowani_Bezrobotni", "Stopa_Bezrobocia", "Oferty_Pracy",
    "Przecietne_Wynagrodzenie_Brutto", "Podmioty_Gospodarcze_REGON",
    "Podmioty_Sektor_Prywatny", "Podmioty_Sektor_Publiczny", "Spolki_Handlowe",
    "Spolki_Z_Udzialem_Zagranicznym", "Mieszkania_Oddane_Do_Uzytku", "Mieszkania_Ogol_Zasob",
    "Przecietna_Pow_Uzytkowa_Mieszk", "Wydane_Pozwolenia_Na_Budowe", "Dochody_Budzetu_Ogol",
    "Wydatki_Budzetu_Ogol", "Dochody_Wlasne_JST", "Miejsca_Noclegowe",
    "Turysci_Krajowi_Zagraniczni", "Drogi_Publiczne_Km",
)
CITY_COUNTY_MARKS = ("%m.%", "%st.%")
POPULATION_FACTOR = 10


def match_city(df: DataFrame, unit: str, cities: Sequence[str] = CITIES, name: str = "Glowne_Miasto") -> DataFrame:
    """Rows whose unit name contains a city (letter case ignored), with the first such city."""
    return df.withColumn(name, contains_any(unit, cities)).filter(F.col(name).isNotNull())


def merge_indicators(
    rows: DataFrame,
    order: Sequence[str],
    indicators: Sequence[str] = INDICATORS,
    keys: Sequence[str] = ("Miasto_GUS", "Glowne_Miasto", "Data"),
    indicator: str = "indicator",
    value: str = "value",
) -> DataFrame:
    """One column per indicator, one row per unit, city and date that has any of them.

    Of several values for one cell the first by ``order`` counts.
    """
    return rows.groupBy(*keys).pivot(indicator, list(indicators)).agg(F.min_by(value, F.struct(*order)))


def is_city_county(unit: Column | str) -> Column:
    unit = F.col(unit) if isinstance(unit, str) else unit
    marks = F.lit(False)
    for pattern in CITY_COUNTY_MARKS:
        marks = marks | unit.like(pattern)
    return marks


def merge_demography(df: DataFrame, factor: int = POPULATION_FACTOR) -> DataFrame:
    """One row per main city and date from its partial rows.

    Each field is its first known value, city counties first, then by unit name. Men and
    women are scaled by ``factor`` and the total is their sum; rows without a positive
    total are dropped.
    """
    fields = (
        "miasto_gus", "populacja_mezczyzni", "populacja_kobiety", "zarejestrowani_bezrobotni",
        "przecietne_wynagrodzenie_brutto", "dochody_wlasne_jst",
    )
    preference = F.struct(~is_city_county("miasto_gus"), F.col("miasto_gus"))

    def first_known(c: str) -> Column:
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), preference)).alias(c)

    merged = df.groupBy("glowne_miasto", "data").agg(*[first_known(c) for c in fields])
    scaled = merged.withColumns(
        {c: F.col(c).cast("bigint") * factor for c in ("populacja_mezczyzni", "populacja_kobiety")}
    ).withColumn("populacja_ogolna", F.col("populacja_mezczyzni") + F.col("populacja_kobiety"))
    return scaled.filter(~is_blank("miasto_gus") & (F.col("populacja_ogolna") > 0)).select(
        "miasto_gus", "glowne_miasto", "data", "populacja_ogolna", "populacja_mezczyzni", "populacja_kobiety",
        "zarejestrowani_bezrobotni", "przecietne_wynagrodzenie_brutto", "dochody_wlasne_jst",
    )
