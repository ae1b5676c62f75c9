"""Property-market views over the driver's tables, as SQL that Spark and DuckDB both run.

The tables hold no listings, so listings, demography and points of interest are derived
from them row by row: every listing is an order line, with its part as the unit and its
supplier's nation as the city. Whole tables, no sampling.
"""

from __future__ import annotations

LISTINGS = """
SELECT concat(CAST(l_orderkey AS STRING),'-',CAST(l_linenumber AS STRING),'-',CAST(l_partkey AS STRING),'-',CAST(l_suppkey AS STRING),'-',CAST(CAST(round(l_extendedprice*100.0E0,0) AS BIGINT) AS STRING)) AS row_key,
 concat(CAST(l_partkey AS STRING),'-',CAST(l_suppkey AS STRING)) AS id,
 l_orderkey*8+l_linenumber AS seq,
 CASE WHEN l_returnflag='R' THEN 'rent' ELSE 'sell' END AS listing_type,
 n_name AS city, p_type AS type,
 l_quantity*6.5E0 AS squaremeters,
 CASE WHEN l_orderkey%11=0 THEN NULL ELSE CAST(l_linenumber AS INT) END AS rooms,
 CASE WHEN l_partkey%9=0 THEN -1 ELSE CAST(p_size AS INT) END AS floor,
 CASE WHEN l_suppkey%7=0 THEN NULL ELSE CAST(p_size+l_linenumber AS INT) END AS floorcount,
 CASE WHEN (l_orderkey+l_linenumber)%5=0 OR s_nationkey=24 OR (s_nationkey%5=3 AND (l_orderkey*7919+l_partkey*104729)%20000<8000)
  THEN NULL ELSE 1900+CAST(l_suppkey%120 AS INT) END AS buildyear,
 CASE WHEN (l_orderkey+l_suppkey)%4=0 THEN 'brak informacji' ELSE p_brand END AS buildingmaterial,
 CASE WHEN (l_orderkey+2*l_partkey)%6=0 THEN 'brak informacji' WHEN p_size%3=0 THEN 'premium' WHEN p_size%3=1 THEN 'normal' ELSE 'low' END AS condition,
 CASE WHEN l_partkey%2=0 THEN 'condominium' ELSE 'cooperative' END AS ownership,
 CASE WHEN (l_partkey+l_suppkey)%6=0 THEN ' ' ELSE l_linestatus END AS haselevator,
 CASE WHEN (l_partkey+2*l_suppkey)%8=0 THEN 'brak informacji' WHEN l_linenumber%2=0 THEN 'yes' ELSE 'no' END AS hasparkingspace,
 CASE WHEN (l_partkey+3*l_suppkey)%9=0 THEN NULL WHEN l_partkey%3=0 THEN 'yes' ELSE 'no' END AS hasbalcony,
 CASE WHEN l_suppkey%2=0 THEN 'yes' ELSE 'no' END AS hassecurity,
 CASE WHEN p_size%2=0 THEN 'yes' ELSE 'no' END AS hasstorageroom,
 round(49.0E0+(s_nationkey%5)*0.5E0+((l_orderkey*7919+l_partkey*104729)%20000)/100000.0E0,6) AS latitude,
 round(15.0E0+(s_nationkey-s_nationkey%5)*0.1E0+((l_partkey*15485863+l_suppkey*32452843)%20000)/100000.0E0,6) AS longitude,
 CASE WHEN (l_orderkey+l_partkey)%7=0 OR s_nationkey=24 OR (s_nationkey%5=3 AND (l_orderkey*7919+l_partkey*104729)%20000<8000)
  THEN NULL ELSE round(l_tax*100.0E0+l_discount*10.0E0,2) END AS centredistance,
 CASE WHEN (l_orderkey+2*l_partkey)%9=0 OR s_nationkey=24 THEN NULL ELSE round(l_tax*60.0E0+(p_size%7)*0.31E0,2) END AS schooldistance,
 CASE WHEN (l_orderkey+3*l_partkey)%10=0 OR s_nationkey=24 THEN NULL ELSE round(l_discount*30.0E0+(p_size%5)*0.17E0,2) END AS clinicdistance,
 CASE WHEN (l_orderkey+4*l_partkey)%11=0 OR s_nationkey%12=11 THEN NULL ELSE round(l_tax*20.0E0+(l_suppkey%9)*0.23E0,2) END AS postofficedistance,
 CASE WHEN (l_orderkey+5*l_partkey)%12=0 THEN NULL ELSE round(l_discount*15.0E0+(l_suppkey%11)*0.13E0,2) END AS kindergartendistance,
 CASE WHEN (l_orderkey+6*l_partkey)%13=0 THEN NULL ELSE round((p_size%13)*0.11E0+l_linenumber*0.07E0,2) END AS restaurantdistance,
 CASE WHEN (l_orderkey+7*l_partkey)%14=0 OR l_partkey%10=3 THEN NULL ELSE round(l_tax*90.0E0+l_linenumber*0.03E0,2) END AS collegedistance,
 CASE WHEN (l_orderkey+8*l_partkey)%15=0 THEN NULL ELSE round(l_discount*25.0E0+(l_partkey%17)*0.05E0,2) END AS pharmacydistance,
 CASE WHEN l_orderkey%13=0 THEN NULL ELSE CAST(p_size AS INT) END AS poicount,
 CASE WHEN l_returnflag='R' THEN CAST(round(CAST(l_extendedprice/100.0E0 AS DECIMAL(18,6)),2) AS DOUBLE) ELSE l_extendedprice END AS price,
 CAST(date_trunc('month',l_shipdate) AS DATE) AS source_date
FROM lineitem JOIN part ON l_partkey=p_partkey
 JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey
"""

# The same listings as raw text, some of it spoilt.
RAW_LISTINGS = """
SELECT row_key, seq,
 CASE WHEN seq%101=0 THEN NULL ELSE id END AS id,
 CASE WHEN seq%53=0 THEN NULL WHEN seq%47=0 THEN '  ' || city || ' ' ELSE city END AS city,
 CASE WHEN seq%19=0 THEN ' ' ELSE type END AS type,
 CASE WHEN seq%97=0 THEN '' WHEN seq%89=0 THEN 'x' WHEN seq%83=0 THEN '300.9' WHEN seq%79=0 THEN '9.99' WHEN seq%73=0 THEN 'NaN'
  ELSE CAST(squaremeters AS STRING) END AS "squareMeters",
 CASE WHEN seq%29=0 THEN CAST(rooms AS STRING) || '.0' WHEN seq%31=0 THEN 'two' ELSE CAST(rooms AS STRING) END AS rooms,
 CASE WHEN floor=-1 THEN '' ELSE CAST(floor AS STRING) || '.0' END AS floor,
 CAST(floorcount AS STRING) AS "floorCount",
 CASE WHEN seq%37=0 THEN '99999999999' ELSE CAST(buildyear AS STRING) END AS "buildYear",
 buildingmaterial AS "buildingMaterial", condition, ownership,
 haselevator AS "hasElevator", hasparkingspace AS "hasParkingSpace", hasbalcony AS "hasBalcony",
 hassecurity AS "hasSecurity", hasstorageroom AS "hasStorageRoom",
 CASE WHEN seq%61=0 THEN '' ELSE CAST(latitude AS STRING) END AS latitude, CAST(longitude AS STRING) AS longitude,
 CAST(centredistance AS STRING) AS "centreDistance", CAST(schooldistance AS STRING) AS "schoolDistance",
 CAST(clinicdistance AS STRING) AS "clinicDistance", CAST(postofficedistance AS STRING) AS "postOfficeDistance",
 CAST(kindergartendistance AS STRING) AS "kindergartenDistance", CAST(restaurantdistance AS STRING) AS "restaurantDistance",
 CAST(collegedistance AS STRING) AS "collegeDistance", CAST(pharmacydistance AS STRING) AS "pharmacyDistance",
 CAST(poicount AS STRING) AS "poiCount",
 CASE WHEN seq%71=0 THEN '0' WHEN seq%67=0 THEN '-1' WHEN seq%59=0 THEN '12,5' ELSE CAST(price AS STRING) END AS price,
 CASE WHEN seq%43=0 THEN '' WHEN seq%41=0 THEN ' ' ELSE substr(CAST(source_date AS STRING),1,7) END AS source_date,
 listing_type,
 concat('all_apartments_',listing_type,'.csv') AS source_file
FROM listings
"""

# Two rows per city and year: the city county has the people, the land county the wage.
DEMOGRAPHY = """
SELECT 'Powiat m. ' || n_name AS miasto_gus, n_name AS glowne_miasto, CAST(yr AS STRING) || '-12-31' AS data, yr,
 CAST(NULL AS INT) AS populacja_ogolna, CAST(men AS INT) AS populacja_mezczyzni, CAST(women AS INT) AS populacja_kobiety,
 CAST(NULL AS INT) AS zarejestrowani_bezrobotni, CAST(NULL AS DOUBLE) AS przecietne_wynagrodzenie_brutto,
 CASE WHEN yr%2=0 THEN wage*2 END AS dochody_wlasne_jst
FROM city_year
UNION ALL
SELECT 'Powiat ' || n_name, n_name, CAST(yr AS STRING) || '-12-31', yr, CAST(NULL AS INT), CAST(NULL AS INT), CAST(NULL AS INT),
 CAST(men AS INT), wage, CAST(NULL AS DOUBLE)
FROM city_year
"""

CITY_YEAR = """
SELECT n_name, CAST(year(o_orderdate) AS INT) AS yr,
 count(CASE WHEN c_custkey%2=0 THEN 1 END) AS men, count(CASE WHEN c_custkey%2=1 THEN 1 END) AS women,
 CAST(round(CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE)/count(*)/100.0E0 AS DECIMAL(18,6)),2) AS DOUBLE) AS wage
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
GROUP BY n_name, year(o_orderdate)
"""

# Order rows as single indicator values of administrative units.
INDICATOR_ROWS = """
SELECT o_orderkey,
 concat(CASE WHEN o_orderkey%3=0 THEN 'Powiat m. ' ELSE 'Powiat ' END, n_name) AS unit,
 CAST(year(o_orderdate) AS INT) AS yr,
 CASE WHEN o_orderkey%4=0 THEN concat(CAST(month(o_orderdate) AS STRING),' miesiąc')
      WHEN o_orderkey%4=1 THEN ' rok' WHEN o_orderkey%4=2 THEN NULL ELSE 'x MIESIĄC' END AS period,
 CASE WHEN o_orderkey%5=0 THEN 'Populacja_Mezczyzni' WHEN o_orderkey%5=1 THEN 'Populacja_Kobiety'
      WHEN o_orderkey%5=2 THEN 'Przecietne_Wynagrodzenie_Brutto' ELSE 'Oferty_Pracy' END AS indicator,
 CASE WHEN o_orderkey%37=0 THEN NULL ELSE o_totalprice END AS value
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
"""

RAW_POI = """
SELECT event_id, event_type AS poi_type,
 CASE WHEN event_id%23=0 THEN ' ' ELSE n_name END AS "City",
 CASE WHEN event_id%7=0 THEN '' ELSE concat(' ',event_type,' ') END AS "Name",
 CASE WHEN event_id%5=0 THEN NULL ELSE concat('street ',CAST(user_id%10 AS STRING)) END AS "Street",
 CAST(user_id AS STRING) AS "Number",
 CASE WHEN event_id%29=0 THEN '-1.5' WHEN event_id%31=0 THEN 'x' ELSE
  CAST(round(49.0E0+(n_nationkey%5)*0.5E0+((event_id*7919+user_id*104729)%2000)/10000.0E0,6) AS STRING) END AS "LAT",
 CASE WHEN event_id%37=0 THEN NULL ELSE
  CAST(round(15.0E0+(n_nationkey-n_nationkey%5)*0.1E0+((event_id*15485863)%20)/100.0E0,6) AS STRING) END AS "LON",
 concat('all_',event_type,'.csv') AS source_file
FROM events JOIN nation ON n_nationkey=user_id%25
"""


# View name -> (SQL, the views it reads).
VIEWS = {
    "listings": (LISTINGS, ()),
    "raw_listings": (RAW_LISTINGS, ("listings",)),
    "city_year": (CITY_YEAR, ()),
    "demography": (DEMOGRAPHY, ("city_year",)),
    "indicator_rows": (INDICATOR_ROWS, ()),
    "raw_poi": (RAW_POI, ()),
}
TABLES = ("lineitem", "part", "supplier", "nation", "orders", "customer", "events")


def _closure(names) -> list[str]:
    found: list[str] = []
    for name in names:
        for needed in [*_closure(VIEWS[name][1]), name]:
            if needed not in found:
                found.append(needed)
    return found


def view(spark, sf_dir: str, name: str):
    """One bridge view as DataFrame.

    The views are wide projections, which Spark otherwise puts into methods that the JVM does not compile; ``jobs.py`` sets the same.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    for needed in _closure([name]):
        df = spark.sql(VIEWS[needed][0].replace('"', "`"))
        df.createOrReplaceTempView(needed)
    return df


def with_views(*names: str) -> str:
    """``WITH`` clause that defines bridge views in DuckDB."""
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name][0]})" for name in _closure(names))


#: Replaces columns of the listings so that one cell is crowded and one point holds many of them.
CROWDED = {
    "latitude": "CASE WHEN seq%12=0 THEN round(52.0E0+(seq%1511)/1000000.0E0,6) WHEN seq%60=1 THEN 52.0007E0 ELSE latitude END",
    "longitude": "CASE WHEN seq%12=0 THEN round(21.0E0+((seq*7)%1709)/1000000.0E0,6) WHEN seq%60=1 THEN 21.0007E0 ELSE longitude END",
    "city": "CASE WHEN seq%12=0 OR seq%60=1 THEN 'crowded' ELSE city END",
}
