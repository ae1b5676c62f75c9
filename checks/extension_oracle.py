"""SQL for ``extension_queries``, from the meaning of each: pairs of all rows where a search or a join is checked."""

from __future__ import annotations

from checks.bridge import with_views
from checks.extension_queries import KINDS
from checks.oracle import _CROWDED_LISTINGS, LISTING_VALID, MERGED, ORACLE as BASE, POI_VALID, PPS, PREMIUM, L, idw, plain, rnd

_STAGED_POI = BASE["stage_poi"].partition(with_views("raw_poi"))[2]
_PLACES = f"""{with_views("listings", "raw_poi")}, staged AS ({_STAGED_POI}),
 k AS (SELECT poi_type, lat, lon, min(struct_pack(name := name, street := street, number := number)) AS s FROM staged GROUP BY ALL)"""
_D = "sqrt((p.latitude-k.lat)*(p.latitude-k.lat)+(p.longitude-k.lon)*(p.longitude-k.lon))"


def _nearest(kinds) -> str:
    listed = ", ".join(f"'{x}'" for x in kinds)
    return f"""p AS (SELECT DISTINCT latitude, longitude FROM places WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
 d AS (SELECT p.latitude, p.longitude, k.poi_type, min({_D}) AS dist FROM p JOIN k ON k.poi_type IN ({listed}) GROUP BY ALL)"""


_SNAPSHOT = f"""{L}, s AS (SELECT source_date, id, listing_type,
  concat(coalesce(CAST(rooms AS VARCHAR),'-'),'|',coalesce(CAST(buildyear AS VARCHAR),'-'),'|',coalesce(condition,'-')) AS d FROM listings),
 n AS (SELECT source_date, id, listing_type, d, count(*) AS n FROM s GROUP BY ALL),
 o AS (SELECT CAST(source_date + INTERVAL 1 MONTH AS DATE) AS source_date, id, listing_type, d, n AS o FROM n),
 b AS (SELECT source_date, id, listing_type, coalesce(n,0) AS n, coalesce(o,0) AS o FROM n FULL JOIN o USING (source_date, id, listing_type, d)),
 k AS (SELECT source_date, id, listing_type, CAST(sum(o) AS BIGINT) AS rows_old, CAST(sum(n) AS BIGINT) AS rows_new,
  CAST(sum(least(o,n)) AS BIGINT) AS rows_same FROM b GROUP BY ALL)
 SELECT CAST(source_date AS VARCHAR) AS source_date, id, listing_type,
  CASE WHEN rows_old=0 THEN 'new' WHEN rows_new=0 THEN 'gone' ELSE 'changed' END AS change, rows_old, rows_new, rows_same
 FROM k WHERE rows_old<>rows_new OR rows_same<>rows_new"""

_SETS = "(city, type), (city, listing_type), (listing_type, source_date), (city), (rooms), ()"
_ALL = "city, type, listing_type, source_date, rooms"

ORACLE: dict[str, str] = {
    "observed_counts": f"""{LISTING_VALID} SELECT source_file, count(*) FILTER (WHERE _rejection_reason='') AS rows_ok,
        count(*) FILTER (WHERE _rejection_reason<>'') AS rows_rejected, CAST(count(*) FILTER (WHERE _rejection_reason='')=0 AS INTEGER) AS all_rejected
        FROM valid GROUP BY source_file""",
    "quality_gate": f"""{POI_VALID}, spoilt AS (SELECT source_file, CASE WHEN poi_type='click' THEN 'spoilt' ELSE _rejection_reason END AS r FROM valid),
        g AS (SELECT source_file, count(*) FILTER (WHERE r='') AS rows_ok, count(*) FILTER (WHERE r<>'') AS rows_rejected FROM spoilt GROUP BY 1)
        SELECT source_file, rows_ok, rows_rejected, CASE WHEN rows_ok=0 THEN 'every row rejected' ELSE 'ok' END AS verdict FROM g
        UNION ALL SELECT 'empty.csv', 0, 0, 'empty file' UNION ALL SELECT 'short.csv', 0, 0, 'columns missing: LAT, LON'""",
    "read_two_headers": f"""{with_views("raw_poi")} SELECT event_id, poi_type, trim(concat("Name", ';"x" ')) AS "Name", "LAT",
        CASE WHEN event_id%2=1 THEN "Street" END AS "Street" FROM raw_poi""",
    "idw_hot_cell": idw().replace("FROM listings", "FROM crowd").replace(f"{L}, cells", f"{L}, crowd AS ({_CROWDED_LISTINGS}), cells"),
    "nearest_poi": f"""{_PLACES}, places AS (SELECT row_key, CASE WHEN seq%977=0 THEN latitude+20 ELSE latitude END AS latitude, longitude
         FROM ({_CROWDED_LISTINGS})), {_nearest(KINDS)},
        t AS (SELECT p.latitude, p.longitude, p.poi_type, p.dist, min(k.s) AS s FROM d p JOIN k ON k.poi_type=p.poi_type AND {_D}=p.dist GROUP BY ALL)
        SELECT row_key, poi_type, {rnd('dist', 6)} AS dist, s.name AS name, s.street AS street, s.number AS number
        FROM places JOIN t ON t.latitude=places.latitude AND t.longitude=places.longitude""",
    "poi_distances": f"""{_PLACES}, places AS (SELECT * FROM listings), {_nearest(("view", "click", "purchase"))},
        keyed AS (SELECT *, row_number() OVER (ORDER BY md5(row_key)) AS k FROM listings),
        w AS (SELECT latitude, longitude, max(dist) FILTER (WHERE poi_type='view') AS a, max(dist) FILTER (WHERE poi_type='click') AS b,
         max(dist) FILTER (WHERE poi_type='purchase') AS c FROM d GROUP BY 1, 2)
        SELECT k AS "ID_Infrastruktury", id AS source_id, {rnd('a', 6)} AS "busstopDistance", {rnd('b', 6)} AS "caffeDistance", {rnd('c', 6)} AS "parkingDistance"
        FROM keyed LEFT JOIN w USING (latitude, longitude)""",
    "asof_demography": f"""{with_views("listings", "demography")},{MERGED}, r AS (SELECT {plain('glowne_miasto')} AS c, CAST(data AS DATE) AS d,
         populacja_ogolna, przecietne_wynagrodzenie_brutto FROM merged), l AS (SELECT row_key, {plain('city')} AS c, source_date FROM listings)
        SELECT row_key, CAST(r.d AS VARCHAR) AS as_of, populacja_ogolna, przecietne_wynagrodzenie_brutto
        FROM l ASOF LEFT JOIN r ON l.c=r.c AND l.source_date>=r.d""",
    "snapshot_changes": _SNAPSHOT,
    "incremental_load": f"""{L}, {PREMIUM}, q AS (SELECT row_key, source_date, {plain('city')} AS c, rooms, type, listing_type, {PPS} AS v FROM listings),
        g AS (SELECT c, rooms, type, listing_type, avg(v) AS a FROM q GROUP BY ALL)
        SELECT row_key, CAST(source_date AS VARCHAR) AS source_date, {rnd('(v-a)/a', 4)} AS price_deviation, location_premium
        FROM q LEFT JOIN g ON g.c=q.c AND g.rooms=q.rooms AND g.type=q.type AND g.listing_type=q.listing_type
         LEFT JOIN premium ON premium.listing_type=q.listing_type""",
    "stream_intake": f"""{L} SELECT row_key, id, price, CAST(rooms AS VARCHAR) AS rooms, substr(CAST(source_date AS VARCHAR),1,7) AS source_date, listing_type FROM listings""",
    "rollup_prices": f"""{L}, q AS (SELECT city, type, listing_type, CAST(source_date AS VARCHAR) AS source_date, rooms, {PPS} AS v FROM listings)
        SELECT {_ALL}, CAST(grouping_id({_ALL}) AS BIGINT) AS level, count(*) AS offers, count(v) AS priced, {rnd('avg(v)', 4)} AS mean
        FROM q GROUP BY GROUPING SETS ({_SETS})""",
    "interval_periods": f"""{with_views("listings", "demography")},{MERGED}, o AS (SELECT id, listing_type, {plain('city')} AS c, min(source_date) AS a,
         last_day(max(source_date)) AS z FROM listings GROUP BY 1, 2, 3),
        y AS (SELECT {plain('glowne_miasto')} AS c, CAST(date_trunc('year', CAST(data AS DATE)) AS DATE) AS a, CAST(data AS DATE) AS z, populacja_ogolna FROM merged)
        SELECT id, listing_type, o.c AS c, CAST(year(y.z) AS INTEGER) AS year, populacja_ogolna FROM o JOIN y ON o.c=y.c AND o.a<=y.z AND y.a<=o.z""",
    "approx_city_median": f"{L} SELECT city, count(*) AS n, 1 AS within_error FROM listings WHERE centredistance IS NOT NULL GROUP BY city",
    "distinct_listings": f"""{L} SELECT city, '1990-01-01' AS first_day, count(DISTINCT id) AS n, 1 AS within_error FROM listings
         WHERE source_date BETWEEN DATE '1990-01-01' AND DATE '2009-12-31' GROUP BY city
        UNION ALL SELECT city, '1997-01-01', count(DISTINCT id), 1 FROM listings WHERE source_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY city""",
    "sorted_demography": f"""{with_views("demography")},{MERGED} SELECT row_number() OVER (ORDER BY glowne_miasto, data, populacja_ogolna) AS place,
         glowne_miasto, data, populacja_ogolna FROM merged""",
}
