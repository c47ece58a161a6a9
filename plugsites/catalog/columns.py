"""Queries for projections and column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugsites.catalog import Query
from plugsites.catalog.frames import LATITUDE_SQL, LONGITUDE_SQL, latitude, longitude, sites_b, table
from plugsites.functions.plugs import pack, plausible_power, plug_labels, plug_text, powers_text
from plugsites.functions.text import (
    TextRule,
    clean_all_text,
    clean_text,
    coordinate_part,
    decimal_comma,
    parse_date,
    safe_cast,
)
from plugsites.operators.missing import fill_count, fill_text
from plugsites.operators.shape import align_schema, drop_empty_rows, rename_and_drop
from plugsites.plans.feeds import FEED_B
from plugsites.schema import CANONICAL


def project_canonical(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("ID"),
        F.col("s_name").alias("Operator"),
        F.concat_ws(" ", F.lit("Weg"), "s_nationkey").alias("AddressLine1"),
        F.lit("DE").alias("Country"),
        F.col("s_suppkey").cast("string").alias("NumberOfPoints"),
    )
    return rename_and_drop(raw, FEED_B.renames, FEED_B.drops, FEED_B.placeholders)


def align(spark: SparkSession, folder: str) -> DataFrame:
    return align_schema(sites_b(spark, folder), CANONICAL, ("row_key",)).drop("plug_types", "power_capacities_kw")


def _spoiled_price(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice").cast("string")
    text = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("D-"), price)).otherwise(price)
    return table(spark, folder, "orders").select("o_orderkey", text.alias("text"))


def safe_casts(spark: SparkSession, folder: str) -> DataFrame:
    texts = _spoiled_price(spark, folder).select(
        "o_orderkey", F.col("text").alias("as_int"), F.col("text").alias("as_double")
    )
    typed = safe_cast(texts, {"as_int": "int", "as_double": "double"})
    return typed.withColumn("as_int", F.col("as_int").cast("string"))


def decimal_commas(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    comma = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    text = F.when(k % 7 == 0, F.lit("k. A.")).when(k % 7 == 1, F.col("c_acctbal").cast("string")).otherwise(comma)
    return table(spark, folder, "customer").select("c_custkey", decimal_comma(text).alias("balance"))


def split_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    lat, lon = latitude(k).cast("string"), longitude(k).cast("string")
    text = F.when(k % 7 == 0, lat).when(k % 7 == 1, F.concat_ws(",", lat, lon)).otherwise(F.concat_ws(" , ", lat, lon))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        coordinate_part(text, 0).alias("latitude"),
        coordinate_part(text, 1).alias("longitude"),
    )


def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    k, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    text = (
        F.when(k % 11 == 0, F.lit("unbekannt"))
        .when(k % 3 == 0, date.cast("string"))
        .when(k % 3 == 1, F.date_format(date, "dd.MM.yyyy"))
        .otherwise(F.concat(date.cast("string"), F.lit("T12:00:00Z")))
    )
    return table(spark, folder, "orders").select("o_orderkey", parse_date(text).cast("string").alias("commissioning_date"))


def drop_all_null(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("event_id")
    rows = table(spark, folder, "events").select(
        F.when(k % 3 != 0, F.col("event_type")).alias("event_type"),
        F.when(k % 5 != 0, F.col("value")).alias("value"),
        F.when(k % 7 != 0, F.col("props")).alias("props"),
    )
    return drop_empty_rows(rows)


def fill_missing(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = (
        F.when(k % 6 == 0, "N.A")
        .when(k % 6 == 1, "UNKNOWN")
        .when(k % 6 == 2, "UNKOWN")
        .when(k % 6 == 3, "")
        .when(k % 6 == 4, F.lit(None))
        .otherwise(F.col("o_orderstatus"))
    )
    points = (
        F.when(k % 5 == 0, "N.A").when(k % 5 == 1, "").when(k % 5 == 2, "viele").when(k % 5 == 3, (k % 30).cast("string"))
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        fill_text(status, F.when(k % 4 == 0, F.col("o_orderpriority"))).alias("status"),
        fill_count(points).cast("string").alias("points"),
    )


def clean_texts(spark: SparkSession, folder: str) -> DataFrame:
    def digest(rule: TextRule):
        return F.md5(clean_text(F.col("text"), rule))

    return table(spark, folder, "documents").select(
        "doc_id",
        digest(TextRule(newline=" ")).alias("spaced"),
        digest(TextRule(newline="")).alias("joined"),
        digest(TextRule(collapse=False)).alias("unbroken"),
    )


def clean_every_text(spark: SparkSession, folder: str) -> DataFrame:
    """All text columns of a table, told by its schema; one is kept as it is."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    spoiled = docs.withColumn("lang", F.concat(F.lit("\n"), "lang", F.lit("\n\n"), "lang"))
    cleaned = clean_all_text(spoiled, TextRule(newline=" "), keep=("source",))
    return cleaned.withColumn("text", F.md5("text"))


# Labels the dictionary knows and one it does not, by order priority.
LABELS_BY_PRIORITY = {
    "1-URGENT": "CHAdeMO",
    "2-HIGH": "DC CHAdeMO",
    "3-MEDIUM": "CCS (Type 2)",
    "4-NOT SPECIFIED": "AC Typ 2 Steckdose",
}


def _label():
    label = F.col("o_orderpriority")
    for priority, name in LABELS_BY_PRIORITY.items():
        label = F.when(F.col("o_orderpriority") == priority, name).otherwise(label)
    return label


def plug_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    labels = F.array(_label(), F.col("o_orderstatus"), F.lit("Tesla (Roadster)"))
    return table(spark, folder, "orders").select(
        "o_orderkey", F.array_join(plug_labels(labels), ",").alias("plug_types")
    )


def plug_texts(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    text = F.when(
        k % 9 != 0, F.concat(_label(), F.lit(" ; ;CHAdeMO;\t"), F.col("o_orderstatus"), F.lit("; "), _label())
    )
    return table(spark, folder, "orders").select("o_orderkey", plug_text(text).alias("plug_types"))


def _power_texts(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        *[
            F.when(
                (F.col("l_partkey") + i) % 4 != 0,
                F.replace(F.col(name).cast("string"), F.lit("."), F.lit(",")),
            ).alias(f"power_capacity_kw_{i}")
            for i, name in enumerate(columns, 1)
        ],
    )


POWER_COLUMNS = [f"power_capacity_kw_{i}" for i in range(1, 5)]


def pack_arrays(spark: SparkSession, folder: str) -> DataFrame:
    return _power_texts(spark, folder).select(
        "l_orderkey", "l_linenumber", F.array_join(pack(POWER_COLUMNS), ";").alias("packed")
    )


def power_filter(spark: SparkSession, folder: str) -> DataFrame:
    return _power_texts(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        powers_text(pack(POWER_COLUMNS, plausible_power), ";").alias("power_capacities_kw"),
    )


_LABEL_SQL = "CASE o_orderpriority {} ELSE o_orderpriority END"
_MAPPED_LABEL_SQL = _LABEL_SQL.format(
    "WHEN '1-URGENT' THEN 'CHAdeMO (DC)' WHEN '2-HIGH' THEN 'CHAdeMO (DC)' "
    "WHEN '3-MEDIUM' THEN 'CCS Combo 2 (DC)' WHEN '4-NOT SPECIFIED' THEN 'Type 2 (AC)'"
)
_CHAIN_SQL = r"regexp_replace(regexp_replace(replace(text, chr(10), '{}'), '\\+', ' ', 'g'), '\s+', ' ', 'g')"


def _power_sql(i: int, column: str, value: str) -> str:
    return f"CASE WHEN (l_partkey + {i}) % 4 <> 0 THEN {value.format(column)} END"


_POWER_COLUMNS_SQL = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
_PACKED_SQL = ", ".join(
    _power_sql(i, name, "replace(CAST({} AS VARCHAR), '.', ',')")
    for i, name in enumerate(_POWER_COLUMNS_SQL, 1)
)
_POWERS_SQL = ", ".join(
    _power_sql(i, name, "{}") for i, name in enumerate(_POWER_COLUMNS_SQL, 1)
)

QUERIES = {
    "project_canonical": Query(
        project_canonical,
        """SELECT s_name AS operator, 'Weg ' || s_nationkey AS street,
            CAST(s_suppkey AS VARCHAR) AS number_of_charging_points, 'N.A' AS state, 'N.A' AS district_city
        FROM supplier""",
    ),
    "align_schema": Query(
        align,
        f"""SELECT CAST(NULL AS VARCHAR) AS address_additional, CAST(NULL AS VARCHAR) AS charging_facility_type,
            CAST(NULL AS VARCHAR) AS city,
            DATE '1998-01-01' + CAST((s_suppkey * 97) % 12000 AS INTEGER) AS commissioning_date,
            CAST(NULL AS VARCHAR) AS district_city, CAST(NULL AS VARCHAR) AS house_number,
            {LATITUDE_SQL.format(k="s_suppkey")} AS latitude, {LONGITUDE_SQL.format(k="s_suppkey")} AS longitude,
            CAST(s_suppkey % 24 AS INTEGER) AS number_of_charging_points, s_name AS operator,
            CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS DOUBLE) AS power_connection_capacity,
            CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS street, s_suppkey AS row_key
        FROM supplier""",
    ),
    "safe_casts": Query(
        safe_casts,
        r"""SELECT o_orderkey,
            CAST(TRY_CAST(regexp_extract(text, '^([+-]?\d+)(\.\d*)?$', 1) AS INTEGER) AS VARCHAR) AS as_int,
            TRY_CAST(text AS DOUBLE) AS as_double
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'D-' ELSE '' END
            || CAST(o_totalprice AS VARCHAR) AS text FROM orders)""",
    ),
    "decimal_comma": Query(
        decimal_commas,
        "SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance FROM customer",
    ),
    "split_coordinates": Query(
        split_coordinates,
        f"""SELECT o_orderkey, {LATITUDE_SQL.format(k="o_orderkey")} AS latitude,
            CASE WHEN o_orderkey % 7 <> 0 THEN {LONGITUDE_SQL.format(k="o_orderkey")} END AS longitude
        FROM orders""",
    ),
    "parse_dates": Query(
        parse_dates,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
            AS commissioning_date FROM orders""",
    ),
    "drop_all_null": Query(
        drop_all_null,
        """SELECT * FROM (SELECT CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type,
            CASE WHEN event_id % 5 <> 0 THEN value END AS value,
            CASE WHEN event_id % 7 <> 0 THEN props END AS props FROM events)
        WHERE NOT (event_type IS NULL AND value IS NULL AND props IS NULL)""",
    ),
    "fill_missing": Query(
        fill_missing,
        """SELECT o_orderkey,
            CASE WHEN o_orderkey % 6 = 5 THEN o_orderstatus
                WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE 'UNKNOWN' END AS status,
            CAST(CASE o_orderkey % 5 WHEN 2 THEN NULL WHEN 3 THEN o_orderkey % 30 ELSE 1 END AS VARCHAR) AS points
        FROM orders""",
    ),
    "clean_text": Query(
        clean_texts,
        f"""SELECT doc_id, md5({_CHAIN_SQL.format(" ")}) AS spaced, md5({_CHAIN_SQL.format("")}) AS joined,
            md5(replace(text, chr(10), '')) AS unbroken FROM documents""",
    ),
    "clean_all_text": Query(
        clean_every_text,
        f"""SELECT doc_id, md5({_CHAIN_SQL.format(" ")}) AS text, ' ' || lang || ' ' || lang AS lang, source
        FROM documents""",
    ),
    "plug_dictionary": Query(
        plug_dictionary,
        f"""SELECT o_orderkey, concat_ws(',', {_MAPPED_LABEL_SQL}, o_orderstatus, 'Tesla Proprietary') AS plug_types
        FROM orders""",
    ),
    "plug_text": Query(
        plug_texts,
        f"""SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN ''
            WHEN label = 'CHAdeMO (DC)' THEN label || '; ' || o_orderstatus
            ELSE label || '; CHAdeMO (DC); ' || o_orderstatus END AS plug_types
        FROM (SELECT *, {_MAPPED_LABEL_SQL} AS label FROM orders)""",
    ),
    "pack_arrays": Query(
        pack_arrays,
        f"SELECT l_orderkey, l_linenumber, concat_ws(';', {_PACKED_SQL}) AS packed FROM lineitem",
    ),
    "power_filter": Query(
        power_filter,
        rf"""SELECT l_orderkey, l_linenumber, array_to_string(list_transform(
            list_filter([{_POWERS_SQL}], lambda x: x > 1 AND x < 1000),
            lambda x: regexp_replace(CAST(x AS VARCHAR), '\.0$', '')), ';') AS power_capacities_kw
        FROM lineitem""",
    ),
}
