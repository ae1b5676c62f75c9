"""The same answers in SQL for DuckDB, written from the meaning of each operator.

Neighbour searches are plain self-joins over the 3x3 cells with every pair ranked.
"""

from __future__ import annotations

from checks.bridge import CROWDED, with_views

L = with_views("listings")
RAW = with_views("raw_listings")
DISTANCES = (
    "schooldistance", "clinicdistance", "postofficedistance", "kindergartendistance",
    "restaurantdistance", "collegedistance", "pharmacydistance", "centredistance",
)
FLAGS = ("hasparkingspace", "hasbalcony", "haselevator", "hassecurity", "hasstorageroom")


def rnd(x: str, digits: int) -> str:
    """Half-up rounding of the printed number, as Spark does it."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)),{digits}) AS DOUBLE)"


def dec(x: str, precision: int, scale: int) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL({precision},{scale}))"


def num(x: str) -> str:
    return f"(CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END)"


def cut(x: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER)"


def plain(x: str) -> str:
    return f"translate(lower(trim({x})),'ąćęłńóśźż','acelnoszz')"


def label(x: str) -> str:
    return f"coalesce(nullif(trim({x}),''),'brak informacji')"


def month(x: str) -> str:
    return f"CAST(try_strptime({x},'%Y-%m') AS DATE)"


PPS = "CASE WHEN squaremeters>0 THEN price/squaremeters END"
PERIOD_END = """
CAST(last_day(make_date(yr,
  CASE WHEN regexp_full_match(trim(replace(lower(period),'miesiąc','')),'[0-9]+') AND lower(period) LIKE '%miesiąc%'
        AND TRY_CAST(trim(replace(lower(period),'miesiąc','')) AS INT) BETWEEN 1 AND 12
       THEN TRY_CAST(trim(replace(lower(period),'miesiąc','')) AS INT) ELSE 12 END, 1)) AS VARCHAR)
"""

CELLS = "floor(latitude/0.018E0) AS cy, floor(longitude/0.018E0) AS cx"
DIST = "sqrt((m.latitude-n.latitude)*(m.latitude-n.latitude)+(m.longitude-n.longitude)*(m.longitude-n.longitude))"
BLOCK = "abs(m.cy-n.cy)<=1 AND abs(m.cx-n.cx)<=1"


def block_join(m: str, n: str, extra: str = "") -> str:
    """3x3 block join as an equi-join, so that DuckDB can hash it."""
    return (
        f"(SELECT * FROM {m}, (SELECT unnest([-1,0,1]) AS sy) ys, (SELECT unnest([-1,0,1]) AS sx) xs) m "
        f"JOIN {n} n ON n.cy=m.cy+m.sy AND n.cx=m.cx+m.sx {extra}"
    )


SIDES = f"""{L},
sides AS (SELECT *, {CELLS}, (buildyear IS NULL OR buildingmaterial='brak informacji' OR condition='brak informacji') AS lacking FROM listings),
m0 AS (SELECT * FROM sides WHERE lacking), n0 AS (SELECT * FROM sides WHERE NOT lacking)"""

NEAR_BUILDINGS = f"""{SIDES},
near AS (SELECT m.row_key, n.row_key AS near_row_key, {DIST} AS dist, n.buildingmaterial AS nm, n.condition AS nc, n.buildyear AS ny
  FROM {block_join('m0', 'n0', 'AND m.city=n.city')} WHERE {DIST}<=0.018E0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY dist, near_row_key) AS rank FROM near)"""


_CROWDED_LISTINGS = "SELECT * REPLACE (" + ", ".join(f"{sql} AS {c}" for c, sql in CROWDED.items()) + ") FROM listings"
NEAR_CROWDED = NEAR_BUILDINGS.replace("AS lacking FROM listings", f"AS lacking FROM ({_CROWDED_LISTINGS})")


def top_value(source: str, key: str, value: str) -> str:
    return (
        f"(SELECT {key}, {value} FROM (SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {value}) AS p"
        f" FROM {source} WHERE {value} IS NOT NULL GROUP BY {key}, {value}) t WHERE p=1)"
    )


def idw() -> str:
    parts = [f"{L}, cells AS (SELECT *, {CELLS} FROM listings)"]
    for c in DISTANCES:
        parts.append(
            f"m_{c} AS (SELECT row_key, latitude, longitude, cy, cx FROM cells WHERE {c} IS NULL),"
            f"n_{c} AS (SELECT row_key, latitude, longitude, cy, cx, {c} AS v FROM cells WHERE {c} IS NOT NULL),"
            f"p_{c} AS (SELECT m.row_key, n.v, {DIST} AS d, n.row_key AS k FROM {block_join(f'm_{c}', f'n_{c}')} WHERE {DIST}>0),"
            f"r_{c} AS (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY d, k) AS p FROM p_{c}),"
            f"i_{c} AS (SELECT row_key, {rnd('sum(v/d ORDER BY p)/sum(1/d ORDER BY p)', 2)} AS v FROM r_{c} WHERE p<=10 GROUP BY row_key),"
            f"c_{c} AS (SELECT city, quantile_disc({c},0.5) AS v FROM listings GROUP BY city)"
        )
    picks = ", ".join(f"coalesce(l.{c}, i_{c}.v, c_{c}.v) AS {c}" for c in DISTANCES)
    joins = " ".join(f"LEFT JOIN i_{c} ON i_{c}.row_key=l.row_key LEFT JOIN c_{c} ON c_{c}.city=l.city" for c in DISTANCES)
    return ",\n".join(parts) + f"\nSELECT l.row_key, {picks} FROM listings l {joins}"


BUILDING = f"""{NEAR_BUILDINGS},
ten AS (SELECT * FROM ranked WHERE rank<=10),
first AS (SELECT * FROM ranked WHERE rank=1 AND dist<=0.00045E0),
tm AS {top_value('ten', 'row_key', 'nm')}, tc AS {top_value('ten', 'row_key', 'nc')},
ty AS (SELECT row_key, CAST(trunc(quantile_cont(ny,0.5)) AS INTEGER) AS y FROM ten GROUP BY row_key),
cm AS {top_value('n0', 'city', 'buildingmaterial')}, cc AS {top_value('n0', 'city', 'condition')},
cy AS (SELECT city, CAST(trunc(quantile_cont(buildyear,0.5)) AS INTEGER) AS y FROM n0 GROUP BY city)
SELECT l.row_key,
 CASE WHEN l.buildingmaterial='brak informacji' THEN coalesce(first.nm, tm.nm, cm.buildingmaterial, 'brak informacji') ELSE l.buildingmaterial END AS buildingmaterial,
 CASE WHEN l.condition='brak informacji' THEN coalesce(first.nc, tc.nc, cc.condition, 'brak informacji') ELSE l.condition END AS condition,
 coalesce(l.buildyear, first.ny, ty.y, cy.y, 2000) AS buildyear
FROM listings l LEFT JOIN first ON first.row_key=l.row_key LEFT JOIN tm ON tm.row_key=l.row_key LEFT JOIN tc ON tc.row_key=l.row_key
 LEFT JOIN ty ON ty.row_key=l.row_key LEFT JOIN cm ON cm.city=l.city LEFT JOIN cc ON cc.city=l.city LEFT JOIN cy ON cy.city=l.city"""

LACKS_FLAG = " OR ".join(f"coalesce(trim({c}),'') IN ('','brak informacji')" for c in FLAGS)
AMENITIES = f"""{L},
marked AS (SELECT *, floor(latitude/0.0009E0) AS cy, floor(longitude/0.0009E0) AS cx, ({LACKS_FLAG}) AS lacking FROM listings),
m0 AS (SELECT * FROM marked WHERE lacking), n0 AS (SELECT * FROM marked WHERE NOT lacking),
near AS (SELECT m.row_key, {", ".join(f"n.{c} AS n_{c}" for c in FLAGS)},
   row_number() OVER (PARTITION BY m.row_key ORDER BY {DIST}, n.row_key) AS p
  FROM {block_join('m0', 'n0', 'AND m.city=n.city')} WHERE {DIST}<=0.00027E0)
SELECT l.row_key, {", ".join(f"CASE WHEN coalesce(trim(l.{c}),'') IN ('','brak informacji') THEN coalesce(near.n_{c},'brak') ELSE l.{c} END AS {c}" for c in FLAGS)}
FROM listings l LEFT JOIN near ON near.row_key=l.row_key AND near.p=1"""

MERGED = """
grouped AS (SELECT glowne_miasto, data,
  coalesce(min(miasto_gus) FILTER (WHERE miasto_gus LIKE '%m.%' OR miasto_gus LIKE '%st.%'), min(miasto_gus)) AS miasto_gus,
  10*CAST(max(populacja_mezczyzni) AS BIGINT) AS men, 10*CAST(max(populacja_kobiety) AS BIGINT) AS women,
  max(zarejestrowani_bezrobotni) AS zarejestrowani_bezrobotni,
  max(przecietne_wynagrodzenie_brutto) AS przecietne_wynagrodzenie_brutto, max(dochody_wlasne_jst) AS dochody_wlasne_jst
 FROM demography GROUP BY glowne_miasto, data),
merged AS (SELECT miasto_gus, glowne_miasto, data, men+women AS populacja_ogolna, men AS populacja_mezczyzni, women AS populacja_kobiety,
  zarejestrowani_bezrobotni, przecietne_wynagrodzenie_brutto, dochody_wlasne_jst FROM grouped WHERE men+women>0)
"""
DEMO = with_views("demography") + "," + MERGED
DIM_DEMO = f"""
demo AS (SELECT row_number() OVER (ORDER BY md5(miasto_gus || chr(31) || data)) AS "ID_Demografii", miasto_gus AS "Miasto_GUS", glowne_miasto AS "Glowne_Miasto", data AS "Data",
  CAST(populacja_ogolna AS INTEGER) AS "Populacja_Ogolna", zarejestrowani_bezrobotni AS "Zarejestrowani_Bezrobotni",
  {dec('przecietne_wynagrodzenie_brutto', 10, 2)} AS "Przecietne_Wynagrodzenie_Brutto", {dec('dochody_wlasne_jst', 10, 2)} AS "Dochody_Wlasne_JST" FROM merged)
"""
WAGES = f"""{with_views("listings", "demography")},{MERGED},{DIM_DEMO},
wage AS (SELECT {plain('"Glowne_Miasto"')} AS c, year(CAST("Data" AS DATE)) AS y, max("ID_Demografii") AS id, max("Przecietne_Wynagrodzenie_Brutto") AS w
 FROM demo WHERE "Miasto_GUS" LIKE '%m.%' GROUP BY 1, 2)
"""
KEYED = "keyed AS (SELECT *, row_number() OVER (ORDER BY md5(row_key)) AS k FROM listings)"
TIME = """time AS (SELECT row_number() OVER (ORDER BY d) AS "ID_Czasu", CAST(d AS VARCHAR) AS source_date,
 CAST(month(d) AS INTEGER) AS miesiac, CAST(year(d) AS INTEGER) AS rok, CAST(month(d) AS INTEGER) AS source_date_m, CAST(year(d) AS INTEGER) AS source_date_y
 FROM (SELECT DISTINCT source_date AS d FROM listings) t)"""
PREMIUM = f"""premium AS (SELECT listing_type, {rnd("coalesce(avg(v) FILTER (WHERE poicount>15),0)-coalesce(avg(v) FILTER (WHERE poicount<=15),0)", 2)} AS location_premium
 FROM (SELECT *, {PPS} AS v FROM listings) t GROUP BY listing_type)"""
POI_VALID = f"""{with_views("raw_poi")},
numbered AS (SELECT *, row_number() OVER (PARTITION BY source_file, "City", "LAT", "LON" ORDER BY event_id) AS nth FROM raw_poi),
valid AS (SELECT *, rtrim(
  CASE WHEN coalesce(trim("City"),'')='' THEN 'brak_City;' ELSE '' END ||
  CASE WHEN coalesce(trim("LAT"),'')='' THEN 'brak_LAT;' ELSE '' END ||
  CASE WHEN coalesce(trim("LON"),'')='' THEN 'brak_LON;' ELSE '' END ||
  CASE WHEN nth>1 THEN 'duplikat;' ELSE '' END ||
  CASE WHEN coalesce({num('"LAT"')}>=0,false) THEN '' ELSE 'lat_invalid;' END ||
  CASE WHEN coalesce({num('"LON"')}>=0,false) THEN '' ELSE 'lon_invalid;' END, ';') AS _rejection_reason FROM numbered)"""
LISTING_VALID = f"""{RAW},
valid AS (SELECT *, rtrim(
  CASE WHEN coalesce(trim(source_date),'')='' THEN 'brak_source_date;brak_daty;' ELSE '' END ||
  CASE WHEN coalesce({num('"squareMeters"')} BETWEEN 10 AND 300,false) THEN '' ELSE 'squareMeters_out_of_range;' END ||
  CASE WHEN coalesce({num('price')}>0,false) THEN '' ELSE 'price_invalid;' END, ';') AS _rejection_reason FROM raw_listings)"""

STAGED = f"""{RAW},
typed AS (SELECT id, city, {label('type')} AS type, {num('"squareMeters"')} AS area, TRY_CAST("squareMeters" AS DECIMAL(10,2)) AS squaremeters,
 {cut('rooms')} AS rooms, coalesce({cut('floor')},-1) AS floor, {cut('"floorCount"')} AS floorcount, {cut('"buildYear"')} AS buildyear,
 {rnd(num('latitude'), 6)} AS latitude, {rnd(num('longitude'), 6)} AS longitude, {cut('"poiCount"')} AS poicount,
 {", ".join(f'TRY_CAST({rnd(num(c), 2)} AS DECIMAL(10,2)) AS {c}' for c in DISTANCES)},
 {label('ownership')} AS ownership, {label('"buildingMaterial"')} AS buildingmaterial, {label('condition')} AS condition,
 {", ".join(f'{label(c)} AS {c}' for c in FLAGS)},
 TRY_CAST(price AS DECIMAL(15,2)) AS price, CAST({month('source_date')} AS VARCHAR) AS source_date, listing_type FROM raw_listings)
SELECT * EXCLUDE (area) FROM typed WHERE id IS NOT NULL AND city IS NOT NULL AND area BETWEEN 10 AND 300 AND squaremeters IS NOT NULL
 AND price>0 AND latitude IS NOT NULL AND longitude IS NOT NULL AND source_date IS NOT NULL"""

NAMES = ["nation_12", "NATION_1", "Nation_2", "NATION_7", "NATION_24"]

ORACLE: dict[str, str] = {
    "price_per_sqm": f"{L} SELECT row_key, id, {rnd(PPS, 2)} AS price_per_sqm FROM listings",
    "price_deviation": f"""{L}, p AS (SELECT row_key, {plain('city')} AS c, rooms, type, listing_type, {PPS} AS v FROM listings),
        g AS (SELECT c, rooms, type, listing_type, avg(v) AS a FROM p GROUP BY ALL)
        SELECT row_key, {rnd('(v-a)/a', 4)} AS price_deviation FROM p LEFT JOIN g USING (c, rooms, type, listing_type)""",
    "normalize_city": f"""{RAW} SELECT row_key, {plain('city')} AS city_norm, {plain("' ŁÓDŹ-Ąćęń' || city || 'Świt Żar '")} AS polish_norm FROM raw_listings""",
    "missing_label": f"""{RAW} SELECT row_key, {label('city')} AS city_label, {label('type')} AS type_label,
        {label('"hasElevator"')} AS "hasElevator_label", {label('"hasBalcony"')} AS "hasBalcony_label" FROM raw_listings""",
    "round_num": f"""{RAW} SELECT row_key, {rnd(num('"squareMeters"'), 0)} AS area_0, {rnd(num('price'), 1)} AS price_1, {rnd(num('latitude'), 3)} AS latitude_3 FROM raw_listings""",
    "to_int": f"""{RAW} SELECT row_key, {cut('rooms')} AS rooms_int, {cut('floor')} AS floor_int, {cut('"buildYear"')} AS "buildYear_int",
        {cut('"squareMeters"')} AS "squareMeters_int" FROM raw_listings""",
    "to_decimal": f"""{RAW} SELECT row_key, TRY_CAST("squareMeters" AS DECIMAL(10,1)) AS area_dec, TRY_CAST(price AS DECIMAL(15,2)) AS price_dec,
        TRY_CAST("buildYear" AS DECIMAL(10,2)) AS year_dec FROM raw_listings""",
    "parse_month": f"""{RAW} SELECT row_key, CAST({month('source_date')} AS VARCHAR) AS month, CAST(year({month('source_date')}) AS INTEGER) AS year,
        CAST(month({month('source_date')}) AS INTEGER) AS month_number FROM raw_listings""",
    "period_end_date": f"{with_views('indicator_rows')} SELECT o_orderkey, {PERIOD_END} AS period_end FROM indicator_rows",
    "planar_distance": f"""{L} SELECT row_key, {rnd('sqrt((latitude-floor(latitude))*(latitude-floor(latitude))+(longitude-floor(longitude))*(longitude-floor(longitude)))', 6)} AS dist FROM listings""",
    "grid_key": f"""{L} SELECT row_key, CAST(floor(latitude/0.018E0) AS BIGINT) AS cell_lat, CAST(floor(longitude/0.018E0) AS BIGINT) AS cell_lon,
        CAST(floor(latitude/0.018E0*4) AS BIGINT) AS fine_lat, CAST(floor(-longitude/0.0009E0) AS BIGINT) AS negative_lon FROM listings""",
    "conform_columns": f"""{RAW} SELECT row_key, "squareMeters" AS squaremeters, "floorCount" AS floorcount, CAST(NULL AS DOUBLE) AS busstopdistance, city FROM raw_listings""",
    "stage_listings": STAGED,
    "stage_demography": f"""{with_views('demography')} SELECT miasto_gus, glowne_miasto, data, populacja_ogolna, populacja_mezczyzni, populacja_kobiety, zarejestrowani_bezrobotni,
        {dec('przecietne_wynagrodzenie_brutto', 10, 2)} AS przecietne_wynagrodzenie_brutto, {dec('dochody_wlasne_jst', 10, 2)} AS dochody_wlasne_jst FROM demography
        WHERE przecietne_wynagrodzenie_brutto IS NOT NULL OR dochody_wlasne_jst IS NOT NULL OR zarejestrowani_bezrobotni IS NOT NULL
        UNION ALL SELECT miasto_gus, glowne_miasto, data, populacja_ogolna, 7, populacja_kobiety, zarejestrowani_bezrobotni, NULL, NULL FROM demography WHERE false""",
    "stage_poi": f"""{with_views('raw_poi')} SELECT "City" AS city, {label('"Name"')} AS name, {label('"Street"')} AS street, {label('"Number"')} AS number,
        {rnd(num('"LAT"'), 6)} AS lat, {rnd(num('"LON"'), 6)} AS lon, poi_type FROM raw_poi
        WHERE trim("City")<>'' AND {num('"LAT"')}>=0 AND {num('"LON"')}>=0""",
    "validate_rows": f"""{LISTING_VALID} SELECT row_key, "squareMeters", price, source_date, _rejection_reason FROM valid""",
    "validate_poi": f"""{POI_VALID} SELECT event_id, "City", "LAT", "LON", _rejection_reason FROM valid""",
    "flag_duplicates": f"""{L} SELECT row_key, CAST(row_number() OVER (PARTITION BY id, listing_type, rooms ORDER BY source_date, row_key)>1 AS INTEGER) AS is_duplicate FROM listings""",
    "split_rejects": f"{LISTING_VALID} SELECT row_key, CASE WHEN _rejection_reason='' THEN 1 ELSE 0 END AS accepted FROM valid",
    "quality_report": f"""{POI_VALID} SELECT source_file, count(*) FILTER (WHERE _rejection_reason='') AS rows_ok, count(*) FILTER (WHERE _rejection_reason<>'') AS rows_rejected,
        CASE WHEN count(*) FILTER (WHERE _rejection_reason='')=0 THEN 1 ELSE 0 END AS all_rejected FROM valid GROUP BY source_file""",
    "dedup_keep_first": f"""{L} SELECT id, listing_type, row_key, CAST(source_date AS VARCHAR) AS source_date, price, rooms
        FROM (SELECT *, row_number() OVER (PARTITION BY id, listing_type ORDER BY source_date, row_key) AS p FROM listings) t WHERE p=1""",
    "quality_recheck": f"{L} SELECT row_key, squaremeters, price FROM listings WHERE squaremeters>=10 AND squaremeters<=300 AND price>0",
    "month_gaps": f"""{L}, m AS (SELECT DISTINCT CAST(source_date + to_months(CAST(quarter(source_date)*2 AS INTEGER)) AS DATE) AS d FROM listings),
        n AS (SELECT d, (SELECT max(o.d) FROM m o WHERE o.d<m.d) AS b FROM m)
        SELECT CAST(b AS VARCHAR) AS month_before, CAST(d AS VARCHAR) AS month_after, CAST(datediff('month', b, d) AS INTEGER) AS months_apart FROM n WHERE datediff('month', b, d)>1""",
    "read_delimited": f"""{with_views('raw_poi')} SELECT CAST(event_id AS VARCHAR) AS event_id, poi_type, nullif(trim("City"),'') AS "City", nullif(trim("Name"),'') AS "Name",
        "Street", "Number", "LAT", "LON" FROM raw_poi""",
    "union_tagged": f"""{L} SELECT row_key, price, CASE WHEN listing_type='sell' THEN rooms END AS rooms, listing_type AS kind, CASE WHEN listing_type='rent' THEN buildyear END AS buildyear FROM listings""",
    "tag_from_filename": f"""{L}, f AS (SELECT *, (CASE WHEN listing_type='rent' THEN 'Apartments_RENT_pl_' ELSE 'apartments_pl_' END) || (CASE WHEN rooms IS NULL THEN 'latest' ELSE strftime(source_date,'%Y_%m') END) || '.csv' AS file FROM listings)
        SELECT row_key, file, CASE WHEN rooms IS NULL THEN '' ELSE strftime(source_date,'%Y-%m') END AS source_date, listing_type FROM f""",
    "write_star": f"{L} SELECT listing_type, city, count(*) AS n, {rnd('max(price)', 2)} AS max_price FROM listings GROUP BY listing_type, city",
    "write_rejects": f"{POI_VALID} SELECT event_id, source_file, _rejection_reason FROM valid WHERE _rejection_reason<>''",
    "match_city": f"""{with_views('indicator_rows')} SELECT o_orderkey, unit, city FROM (SELECT o_orderkey, unit,
        CASE {" ".join(f"WHEN unit ILIKE '%{n}%' THEN '{n}'" for n in NAMES)} END AS city FROM indicator_rows) t WHERE city IS NOT NULL""",
    "merge_indicators": f"""{with_views('indicator_rows')}, i AS (SELECT unit AS "Miasto_GUS", {plain('unit')} AS "Glowne_Miasto", {PERIOD_END} AS "Data", indicator, value, o_orderkey FROM indicator_rows),
        f AS (SELECT *, row_number() OVER (PARTITION BY "Miasto_GUS", "Data", indicator ORDER BY o_orderkey) AS p FROM i)
        SELECT "Miasto_GUS", "Glowne_Miasto", "Data", {", ".join(f'''max(value) FILTER (WHERE p=1 AND indicator='{n}') AS "{n}"''' for n in ("Populacja_Mezczyzni", "Populacja_Kobiety", "Przecietne_Wynagrodzenie_Brutto", "Oferty_Pracy"))}
        FROM f GROUP BY 1, 2, 3""",
    "merge_demography": f"{DEMO} SELECT * FROM merged",
    "explode_neighbors": f"""{L}, c AS (SELECT CAST(floor(latitude/0.018E0) AS BIGINT) AS y, CAST(floor(longitude/0.018E0) AS BIGINT) AS x FROM listings)
        SELECT y+sy AS near_lat, x+sx AS near_lon, count(*) AS n FROM c, (SELECT unnest([-1,0,1]) AS sy) a, (SELECT unnest([-1,0,1]) AS sx) b GROUP BY 1, 2""",
    "grid_neighbor_join": f"""{L}, cells AS (SELECT *, {CELLS} FROM listings), m0 AS (SELECT * FROM cells WHERE centredistance IS NULL), n0 AS (SELECT * FROM cells WHERE centredistance IS NOT NULL),
        pairs AS (SELECT m.row_key, count(*) AS c FROM {block_join('m0', 'n0')} WHERE {DIST}>0 GROUP BY m.row_key)
        SELECT row_key, coalesce(c,0) AS neighbors FROM m0 LEFT JOIN pairs USING (row_key)""",
    "nearest_within_radius": f"{NEAR_BUILDINGS} SELECT row_key, near_row_key, {rnd('dist', 6)} AS dist FROM ranked WHERE rank=1 AND dist<=0.00045E0",
    "knn_within_radius": f"{NEAR_BUILDINGS} SELECT row_key, CAST(rank AS INTEGER) AS rank, near_row_key, {rnd('dist', 6)} AS dist FROM ranked WHERE rank<=10",
    "knn_hot_cell": f"{NEAR_CROWDED} SELECT row_key, CAST(rank AS INTEGER) AS rank, near_row_key, {rnd('dist', 6)} AS dist FROM ranked WHERE rank<=10",
    "city_median": f"{L} SELECT city, quantile_disc(centredistance,0.5) AS median_distance FROM listings WHERE centredistance IS NOT NULL GROUP BY city",
    "city_mode": f"""{L}, known AS (SELECT * FROM listings WHERE buildingmaterial<>'brak informacji'), a AS {top_value('known', 'city', 'buildingmaterial')},
        y AS (SELECT city, CAST(trunc(quantile_cont(buildyear,0.5)) AS INTEGER) AS year FROM listings WHERE buildyear IS NOT NULL GROUP BY city)
        SELECT city, a.buildingmaterial AS material, y.year FROM a FULL JOIN y USING (city)""",
    "idw_impute": idw(),
    "impute_building": BUILDING,
    "impute_amenities": AMENITIES,
    "rent_to_wage": f"""{WAGES} SELECT row_key, CASE WHEN listing_type='rent' AND w>0 THEN {rnd('price/CAST(w AS DOUBLE)', 4)} END AS rent_to_wage
        FROM listings LEFT JOIN wage ON wage.c={plain('city')} AND wage.y=year(source_date)""",
    "location_premium": f"{L}, {PREMIUM} SELECT * FROM premium",
    "surrogate_key": f"{L} SELECT row_number() OVER (ORDER BY md5(row_key)) AS key, row_key, price FROM listings",
    "dim_time": f"{L}, {TIME} SELECT * FROM time",
    "dim_unit": f"""{L}, {KEYED} SELECT k AS "ID_Lokalu", id AS source_id, listing_type, latitude, longitude, city, squaremeters AS "squareMeters", rooms, floor, floorcount AS "floorCount", condition,
        haselevator AS "hasElevator", hasparkingspace AS "hasParkingSpace", hasstorageroom AS "hasStorageRoom", hassecurity AS "hasSecurity", hasbalcony AS "hasBalcony", price, ownership FROM keyed""",
    "dim_building": f"""{L}, {KEYED} SELECT k AS "ID_Budynku", id AS source_id, listing_type, city, type, buildyear AS "buildYear", buildingmaterial AS "buildingMaterial" FROM keyed""",
    "dim_infrastructure": f"""{L}, {KEYED} SELECT k AS "ID_Infrastruktury", id AS source_id, listing_type, centredistance AS "centreDistance", schooldistance AS "schoolDistance", clinicdistance AS "clinicDistance",
        postofficedistance AS "postOfficeDistance", collegedistance AS "collegeDistance", kindergartendistance AS "kindergartenDistance", CAST(NULL AS DECIMAL(10,2)) AS "busstopDistance",
        CAST(NULL AS DECIMAL(10,2)) AS "caffeDistance", CAST(NULL AS DECIMAL(10,2)) AS "parkingDistance", restaurantdistance AS "restaurantDistance", pharmacydistance AS "pharmacyDistance", poicount AS "poiCount" FROM keyed""",
    "dim_demography": f"{DEMO}, {DIM_DEMO} SELECT * FROM demo",
    "fact_offers": f"""{WAGES}, {KEYED}, {TIME}, {PREMIUM},
        priced AS (SELECT *, {PPS} AS v, {plain('city')} AS c FROM keyed),
        g AS (SELECT c, rooms, type, listing_type, avg(v) AS a FROM priced GROUP BY ALL)
        SELECT p.k AS "ID_Faktu", p.k AS "ID_Lokalu", p.k AS "ID_Budynku", p.k AS "ID_Infrastruktury", t."ID_Czasu", w.id AS "ID_Demografii",
         {dec('price', 15, 2)} AS "Cena_Calkowita", {dec(rnd('v', 2), 10, 2)} AS "Cena_Za_M2", {dec('squaremeters', 10, 2)} AS "Powierzchnia_Lokalu",
         {dec(rnd('(v-a)/a', 4), 8, 4)} AS "Odchylenie_Procentowe_Ceny",
         CASE WHEN p.listing_type='rent' AND w.w>0 THEN {dec(rnd('price/CAST(w.w AS DOUBLE)', 4), 8, 4)} END AS "Stosunek_Najmu_Do_Wynagrodzenia",
         {dec('location_premium', 10, 2)} AS "Premia_Lokalizacyjna"
        FROM priced p JOIN time t ON t.source_date=CAST(p.source_date AS VARCHAR) LEFT JOIN wage w ON w.c=p.c AND w.y=year(p.source_date)
         LEFT JOIN g ON g.c=p.c AND g.rooms=p.rooms AND g.type=p.type AND g.listing_type=p.listing_type
         LEFT JOIN premium ON premium.listing_type=p.listing_type""",
}
