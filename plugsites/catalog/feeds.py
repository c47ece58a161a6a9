"""Queries for the three feeds and the consolidated registry.

Raw feed tables are rendered from the driver tables, dirt included, and go through
the feed jobs. Every tenth row comes twice, every 97th is empty, every 101st has
no coordinates. The SQL states the expected clean values directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plugsites.catalog import Query
from plugsites.catalog.areas import BRUTE_FORCE_SQL
from plugsites.catalog.frames import (
    DATE_SQL,
    GOOD_SQL,
    LAST_YEAR,
    LATITUDE_SQL,
    LONGITUDE_SQL,
    ORDER_DATE_SQL,
    STATE_SQL,
    table,
)
from plugsites.functions.plugs import lists_as_text
from plugsites.operators.areas import AreaIndex, index_areas
from plugsites.operators.checks import accepted
from plugsites.plans.feeds import FEED_A, FEED_B, FEED_C, ROW_KEY, FeedSpec, transform_feed
from plugsites.plans.registry import registry
from plugsites.schema import CANONICAL, SITES
from plugsites.sinks.stage import export_csv, shared_folder, write_stage
from plugsites.sinks.warehouse import load_table

LOADED_TABLE = "plugsites_loaded"

# Areas for the feeds: (level, order, name, rings).
AREAS = [
    (1, 0, "A", [[(5.5, 47.3), (9.0, 47.5), (10.2, 51.0), (6.0, 52.0)]]),
    (1, 1, "B", [[(10.2, 51.0), (15.0, 50.5), (14.0, 54.9), (8.0, 55.0)]]),
    (2, 0, "West", [[(5.0, 47.0), (10.0, 47.0), (10.0, 55.5), (5.0, 55.5)]]),
    (2, 1, "East", [[(9.5, 47.0), (15.5, 47.0), (15.5, 55.5), (9.5, 55.5)]]),
    (
        3,
        0,
        "Centre",
        [
            [(8.0, 49.0), (12.0, 49.0), (12.0, 53.0), (8.0, 53.0)],
            [(9.5, 50.5), (10.5, 50.5), (10.5, 51.5), (9.5, 51.5)],
        ],
    ),
]


def feed_index(spark: SparkSession) -> AreaIndex:
    def ring_sql(ring: list[tuple[float, float]]) -> str:
        return "array({})".format(", ".join(f"struct({x}D AS x, {y}D AS y)" for x, y in ring))

    rows = ", ".join(
        "({}, {}L, '{}', array({}))".format(level, ord_, name, ", ".join(map(ring_sql, rings)))
        for level, ord_, name, rings in AREAS
    )
    boundaries = spark.sql(f"SELECT * FROM VALUES {rows} AS areas(level, ord, name, rings)")
    return index_areas(boundaries)


def _rendered(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """All columns as text, some rows empty, some rows twice.

    ``columns`` holds Spark SQL over the table, with ``k`` for its key. Exploding
    whole rows keeps the rendering in one place of the plan, as a raw file would:
    no filter of the feed job is moved in front of it.
    """
    texts = ", ".join(f"CAST({text} AS STRING) AS `{name}`" for name, text in columns.items())
    row = f"CASE WHEN k % 97 <> 0 THEN struct({texts}) END"
    rows = f"explode(array_repeat({row}, CASE WHEN k % 10 = 0 THEN 2 ELSE 1 END))"
    return df.withColumnRenamed(key, "k").selectExpr(f"k AS {ROW_KEY}", f"{rows} AS raw").select(ROW_KEY, "raw.*")


SPARK_LATITUDE = "(47D + CAST((k * 53) % 211 AS DOUBLE) / 25)"
SPARK_LONGITUDE = "(5D + CAST((k * 37) % 211 AS DOUBLE) / 20)"
SPARK_DATE = "date_add(DATE'1998-01-01', CAST((k * 97) % 12000 AS INT))"
SPARK_STATE = "CASE k % 5 WHEN 0 THEN 'N.A' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN '' WHEN 4 THEN 'Hessen' END"
SPARK_PLUG = "CASE k % 4 WHEN 0 THEN 'CHAdeMO' WHEN 1 THEN 'DC CHAdeMO' WHEN 2 THEN 'CCS (Type 2)' ELSE 'Other' END"
SPARK_DISTRICT = "CASE k % 7 WHEN 0 THEN 'N.A' WHEN 1 THEN 'UNKNOWN' ELSE 'Kreis ' || (k % 11) END"
SPARK_POSTAL = "CASE WHEN k % 17 = 0 THEN 'D-1234' ELSE CAST((k * 7) % 100000 AS STRING) END"


def raw_a(spark: SparkSession, folder: str) -> DataFrame:
    def comma(number: str) -> str:
        return f"CASE WHEN k % 101 <> 0 THEN replace(CAST({number} AS STRING), '.', ',') END"

    return _rendered(
        table(spark, folder, "customer"),
        "c_custkey",
        {
            "Betreiber": "c_name",
            "Art der Ladeeinrichung": "CASE k % 3 WHEN 0 THEN 'Normalladeeinrichtung' WHEN 1 THEN 'Schnellladeeinrichtung' END",
            "Anzahl Ladepunkte": "CASE WHEN k % 29 = 0 THEN 'N.A' WHEN k % 31 = 0 THEN '' ELSE CAST(k % 24 AS STRING) END",
            "Nennleistung Ladeeinrichtung [kW]": "(k % 350) || ',5'",
            "Steckertypen1": SPARK_PLUG,
            "Steckertypen2": "CASE WHEN k % 3 = 0 THEN 'AC Typ 2 Steckdose' END",
            "P1 [kW]": "(k % 50) || ',5'",
            "P2 [kW]": "CASE WHEN k % 3 = 0 THEN k % 1100 END",
            "Kreis/kreisfreie Stadt": SPARK_DISTRICT,
            "Ort": "CASE WHEN k % 19 = 0 THEN '' ELSE 'Ort\\n' || (k % 13) END",
            "Postleitzahl": SPARK_POSTAL,
            "Straße": "c_mktsegment || ' \\\\\\\\  Weg\\n' || (k % 5)",
            "Hausnummer": "k % 90",
            "Adresszusatz": "NULL",
            "Bundesland": SPARK_STATE,
            "Inbetriebnahmedatum": f"date_format({SPARK_DATE}, 'dd.MM.yyyy')",
            "Breitengrad": comma(SPARK_LATITUDE),
            "Längengrad": comma(SPARK_LONGITUDE),
            "Public Key1": "'not needed'",
        },
    )


def raw_b(spark: SparkSession, folder: str) -> DataFrame:
    return _rendered(
        table(spark, folder, "supplier"),
        "s_suppkey",
        {
            "ID": "k",
            "AddressLine1": "'Markt\\n' || (k % 40) || '\\t \\tb'",
            "AddressLine2": "CASE WHEN k % 2 = 0 THEN 'Hinterhof' END",
            "Town": "CASE WHEN k % 6 = 0 THEN 'N.A' ELSE 'Stadt ' || (k % 13) END",
            "Postcode": "(k * 11) % 100000",
            "Latitude": f"CASE WHEN k % 101 <> 0 THEN {SPARK_LATITUDE} END",
            "Longitude": f"CASE WHEN k % 101 <> 0 THEN {SPARK_LONGITUDE} END",
            "ConnectionType": f"CASE WHEN k % 8 <> 7 THEN {SPARK_PLUG} || ' ;;CHAdeMO' END",
            "UsageType": "CASE k % 3 WHEN 0 THEN 'Public' WHEN 1 THEN 'Private' END",
            "NumberOfPoints": "CASE WHEN k % 11 = 0 THEN '' WHEN k % 13 = 0 THEN 'abc' ELSE CAST(k % 24 AS STRING) END",
            "StatusType": "'Operational'",
            "DateCreated": f"{SPARK_DATE} || 'T12:00:00Z'",
            "Operator": "s_name",
            "Country": "'Germany'",
            "StateOrProvince": "'not needed'",
        },
    )


def raw_c(spark: SparkSession, folder: str) -> DataFrame:
    return _rendered(
        table(spark, folder, "orders"),
        "o_orderkey",
        {
            "betreiber": "o_orderpriority",
            "art_der_ladeeinrichung": "'Normalladeeinrichtung'",
            "anzahl_ladepunkte": "CASE WHEN k % 29 = 0 THEN 'N.A' ELSE CAST(k % 24 AS STRING) END",
            "nennleistung_ladeeinrichtung_kw": "k % 300",
            "steckertypen1": SPARK_PLUG,
            "steckertypen2": "CASE WHEN k % 5 = 0 THEN 'Type 1 (J1772)' END",
            "p1_kw": "k % 30",
            "kreis_kreisfreie_stadt": SPARK_DISTRICT,
            "ort": "'Ort\\n' || (k % 13)",
            "postleitzahl": SPARK_POSTAL,
            "strasse": "o_orderstatus || '  Weg'",
            "hausnummer": "k % 90",
            "inbetriebnahmedatum": "date_add(CAST(o_orderdate AS DATE), 1500)",
            "koordinaten": f"{SPARK_LATITUDE} || CASE WHEN k % 101 = 0 THEN '' ELSE ', ' || {SPARK_LONGITUDE} END",
        },
    )


def checked_feeds(spark: SparkSession, folder: str) -> list[DataFrame]:
    index = feed_index(spark)
    raws = ((FEED_A, raw_a), (FEED_B, raw_b), (FEED_C, raw_c))
    return [transform_feed(raw(spark, folder), spec, LAST_YEAR, index) for spec, raw in raws]


def _clean_feed(spec: FeedSpec, raw):
    def build(spark: SparkSession, folder: str) -> DataFrame:
        checked = transform_feed(raw(spark, folder), spec, LAST_YEAR, feed_index(spark))
        return lists_as_text(accepted(checked, ROW_KEY))

    return build


def consolidated_sites(spark: SparkSession, folder: str) -> DataFrame:
    return registry(checked_feeds(spark, folder))


def exported_and_loaded_sites(spark: SparkSession, folder: str) -> DataFrame:
    """The consolidated sites through the export's text into a warehouse table."""
    stage, export = shared_folder(spark, "sites"), shared_folder(spark, "export")
    write_stage(consolidated_sites(spark, folder), stage)
    export_csv(spark, stage, export)
    load_table(spark, f"{export}/part-*.csv", SITES, LOADED_TABLE)
    return spark.table(LOADED_TABLE)


_AREA_EDGES_SQL = ", ".join(
    "({}, {}, '{}', {})".format(level, ord_, name, ", ".join(f"CAST({v} AS DOUBLE)" for v in (*start, *end)))
    for level, ord_, name, rings in AREAS
    for ring in rings
    for start, end in zip(ring, [*ring[1:], ring[0]], strict=True)
)
_PLUG_SQL = """CASE {k} % 4 WHEN 2 THEN 'CCS Combo 2 (DC)' WHEN 3 THEN 'Other' ELSE 'CHAdeMO (DC)' END"""
_DISTRICT_SQL = "CASE WHEN {k} % 7 > 1 THEN 'Kreis ' || ({k} % 11) END"


def _feed_ctes(name: str, source: str, k: str, columns: dict[str, str]) -> str:
    """CTEs from the source to the clean rows ``clean_<name>`` of one feed.

    Columns named ``own_<area>`` hold an area the feed knows, NULL where it is to
    be looked up.
    """
    named = ", ".join(f"{value.format(k=k)} AS {column}" for column, value in columns.items())
    return f"""rows_{name} AS (SELECT {k} AS row_key, {named} FROM {source} WHERE {k} % 97 <> 0),
        found_{name} AS (WITH places AS (SELECT row_key AS id, longitude AS px, latitude AS py FROM rows_{name}),
            {BRUTE_FORCE_SQL} SELECT * FROM found),
        filled_{name} AS (SELECT r.* EXCLUDE (own_state, own_district_city, own_city),
            coalesce(own_state, f.state, 'UNKNOWN') AS state,
            coalesce(own_district_city, f.district_city, 'UNKNOWN') AS district_city,
            coalesce(own_city, f.city, 'UNKNOWN') AS city
            FROM rows_{name} r LEFT JOIN found_{name} f ON r.row_key = f.id),
        clean_{name} AS (SELECT * FROM filled_{name} WHERE {GOOD_SQL})"""


_EDGES_CTE = f"edges AS (SELECT * FROM (VALUES {_AREA_EDGES_SQL}) AS e(level, ord, name, x1, y1, x2, y2))"
_COORDINATES = {
    "latitude": f"CASE WHEN {{k}} % 101 <> 0 THEN {LATITUDE_SQL} END",
    "longitude": f"CASE WHEN {{k}} % 101 <> 0 THEN {LONGITUDE_SQL} END",
}
_POSTAL_SQL = "lpad(CAST(({k} * 7) % 100000 AS VARCHAR), 5, '0')"

CLEAN_A = _feed_ctes(
    "a",
    "customer",
    "c_custkey",
    {
        "operator": "c_name",
        "charging_facility_type": "CASE {k} % 3 WHEN 0 THEN 'Normalladeeinrichtung' WHEN 1 THEN 'Schnellladeeinrichtung' END",
        "number_of_charging_points": "CASE WHEN {k} % 29 = 0 OR {k} % 31 = 0 THEN 1 ELSE CAST({k} % 24 AS INTEGER) END",
        "power_connection_capacity": "CAST({k} % 350 AS DOUBLE) + 0.5",
        "plug_types": f"concat_ws(',', {_PLUG_SQL}, CASE WHEN {{k}} % 3 = 0 THEN 'Type 2 (AC)' END)",
        "power_capacities_kw": """concat_ws(',', CASE WHEN {k} % 50 >= 1 THEN ({k} % 50) || '.5' END,
            CASE WHEN {k} % 3 = 0 AND {k} % 1100 > 1 AND {k} % 1100 < 1000 THEN CAST({k} % 1100 AS VARCHAR) END)""",
        "own_district_city": _DISTRICT_SQL,
        "own_city": "CASE WHEN {k} % 19 <> 0 THEN 'Ort ' || ({k} % 13) END",
        "postal_code": f"CASE WHEN {{k}} % 17 <> 0 THEN {_POSTAL_SQL} END",
        "street": "c_mktsegment || ' Weg ' || ({k} % 5)",
        "house_number": "CAST({k} % 90 AS VARCHAR)",
        "address_additional": "CAST(NULL AS VARCHAR)",
        "own_state": f"CASE WHEN {{k}} % 5 = 4 THEN {STATE_SQL} END",
        "commissioning_date": DATE_SQL,
        **_COORDINATES,
    },
)
CLEAN_B = _feed_ctes(
    "b",
    "supplier",
    "s_suppkey",
    {
        "operator": "s_name",
        "charging_facility_type": "CAST(NULL AS VARCHAR)",
        "number_of_charging_points": "CASE WHEN {k} % 11 = 0 OR {k} % 13 = 0 THEN 1 ELSE CAST({k} % 24 AS INTEGER) END",
        "power_connection_capacity": "CAST(NULL AS DOUBLE)",
        "plug_types": f"""CASE WHEN {{k}} % 8 = 7 THEN '' WHEN {{k}} % 4 < 2 THEN 'CHAdeMO (DC)'
            ELSE {_PLUG_SQL} || ',CHAdeMO (DC)' END""",
        "power_capacities_kw": "CAST(NULL AS VARCHAR)",
        "own_district_city": "CAST(NULL AS VARCHAR)",
        "own_city": "CASE WHEN {k} % 6 <> 0 THEN 'Stadt ' || ({k} % 13) END",
        "postal_code": "lpad(CAST(({k} * 11) % 100000 AS VARCHAR), 5, '0')",
        "street": "'Markt' || ({k} % 40) || ' b'",
        "house_number": "CAST(NULL AS VARCHAR)",
        "address_additional": "CASE WHEN {k} % 2 = 0 THEN 'Hinterhof' END",
        "own_state": "CAST(NULL AS VARCHAR)",
        "commissioning_date": DATE_SQL,
        "usage_type": "CASE {k} % 3 WHEN 0 THEN 'Public' WHEN 1 THEN 'Private' END",
        "status_type": "'Operational'",
        **_COORDINATES,
    },
)
CLEAN_C = _feed_ctes(
    "c",
    "orders",
    "o_orderkey",
    {
        "operator": "o_orderpriority",
        "charging_facility_type": "'Normalladeeinrichtung'",
        "number_of_charging_points": "CASE WHEN {k} % 29 = 0 THEN 1 ELSE CAST({k} % 24 AS INTEGER) END",
        "power_connection_capacity": "CAST({k} % 300 AS DOUBLE)",
        "plug_types": f"concat_ws(',', {_PLUG_SQL}, CASE WHEN {{k}} % 5 = 0 THEN 'Type 1 (AC)' END)",
        "power_capacities_kw": "CASE WHEN {k} % 30 > 1 THEN CAST({k} % 30 AS VARCHAR) ELSE '' END",
        "own_district_city": _DISTRICT_SQL,
        "own_city": "'Ort' || ({k} % 13)",
        "postal_code": f"CASE WHEN {{k}} % 17 = 0 THEN 'D-1234' ELSE {_POSTAL_SQL} END",
        "street": "o_orderstatus || '  Weg'",
        "house_number": "CAST({k} % 90 AS VARCHAR)",
        "address_additional": "CAST(NULL AS VARCHAR)",
        "own_state": "CAST(NULL AS VARCHAR)",
        "commissioning_date": ORDER_DATE_SQL,
        "latitude": LATITUDE_SQL,
        "longitude": _COORDINATES["longitude"],
    },
)


def _feed_sql(name: str, ctes: str) -> str:
    source = {"a": 1, "b": 2, "c": 3}[name]
    return f"WITH {_EDGES_CTE}, {ctes} SELECT *, {source} AS src FROM clean_{name}"


def _first_sql(name: str, source: int) -> str:
    columns = ", ".join(CANONICAL.names)
    return f"""SELECT {source} AS src, {columns} FROM (SELECT *, row_number() OVER (
        PARTITION BY latitude, longitude ORDER BY row_key) AS place FROM clean_{name}) WHERE place = 1"""


def _known_sql(column: str, known: str) -> str:
    return f"arg_min({column}, src) FILTER (WHERE {known}) AS {column}"


_TEXTS = ("address_additional", "charging_facility_type", "house_number", "operator", "postal_code", "street")
_AREA_COLUMNS = ("city", "district_city", "state")


def _list_sql(column: str, kind: str) -> str:
    return f"""lists_{column} AS (SELECT latitude, longitude, array_to_string(list_transform(list_sort(
        list_distinct(list(CAST(token AS {kind})))), lambda x: regexp_replace(CAST(x AS VARCHAR), '\\.0$', '')), ',')
        AS {column} FROM (SELECT latitude, longitude, unnest(string_split({column}, ',')) AS token FROM firsts)
        WHERE token <> '' GROUP BY latitude, longitude)"""


CONSOLIDATED_SQL = f"""WITH {_EDGES_CTE}, {CLEAN_A}, {CLEAN_B}, {CLEAN_C},
    firsts AS ({_first_sql("a", 1)} UNION ALL {_first_sql("b", 2)} UNION ALL {_first_sql("c", 3)}),
    {_list_sql("plug_types", "VARCHAR")}, {_list_sql("power_capacities_kw", "DOUBLE")},
    merged AS (SELECT latitude, longitude, max(commissioning_date) AS commissioning_date,
        CAST(sum(number_of_charging_points) AS BIGINT) AS number_of_charging_points,
        max(power_connection_capacity) AS power_connection_capacity,
        {", ".join(_known_sql(name, f"{name} IS NOT NULL") for name in _TEXTS)},
        {", ".join(_known_sql(name, f"{name} <> 'UNKNOWN'") for name in _AREA_COLUMNS)}
        FROM firsts GROUP BY latitude, longitude)
    SELECT m.* REPLACE (coalesce(city, 'UNKNOWN') AS city, coalesce(district_city, 'UNKNOWN') AS district_city,
        coalesce(state, 'UNKNOWN') AS state), coalesce(p.plug_types, '') AS plug_types,
        coalesce(w.power_capacities_kw, '') AS power_capacities_kw
    FROM merged m LEFT JOIN lists_plug_types p USING (latitude, longitude)
        LEFT JOIN lists_power_capacities_kw w USING (latitude, longitude)"""

QUERIES = {
    "feed_a": Query(_clean_feed(FEED_A, raw_a), _feed_sql("a", CLEAN_A)),
    "feed_b": Query(_clean_feed(FEED_B, raw_b), _feed_sql("b", CLEAN_B)),
    "feed_c": Query(_clean_feed(FEED_C, raw_c), _feed_sql("c", CLEAN_C)),
    "consolidated_sites": Query(consolidated_sites, CONSOLIDATED_SQL),
    "exported_and_loaded_sites": Query(exported_and_loaded_sites, CONSOLIDATED_SQL),
}
