"""Queries for checks, set operations and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugsites.catalog import Query
from plugsites.catalog.frames import (
    ALL_SITES_SQL,
    BBOX_SQL,
    COUNT_SQL,
    LAST_YEAR,
    NO_COORDINATES_SQL,
    SITES_A_SQL,
    SITES_C_SQL,
    STATE_SQL,
    STATIONS_SQL,
    YEAR_SQL,
    sentinel_state,
    sites_a,
    sites_b,
    sites_c,
    stations,
    table,
)
from plugsites.operators import checks, consolidate
from plugsites.operators.missing import known
from plugsites.operators.shape import union_sources
from plugsites.schema import SITE_KEY


def bbox_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    sites = sites_c(spark, folder)
    return sites.where(checks.outside_box(F.col("latitude"), F.col("longitude")))


def year_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return sites_a(spark, folder).where(checks.implausible_year(F.col("commissioning_date"), LAST_YEAR))


def count_range_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity").cast("int") % 24).alias("number_of_charging_points")
    )
    return rows.where(checks.implausible_count(F.col("number_of_charging_points")))


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check(stations(spark, folder), LAST_YEAR)


def anomalies_with_reason(spark: SparkSession, folder: str) -> DataFrame:
    return checks.rejected(_checked(spark, folder))


def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    return checks.accepted(_checked(spark, folder))


def anomaly_counts(spark: SparkSession, folder: str) -> DataFrame:
    return checks.anomaly_counts(_checked(spark, folder))


def all_sites(spark: SparkSession, folder: str) -> DataFrame:
    return union_sources([build(spark, folder) for build in (sites_a, sites_b, sites_c)])


ORDER = ["src", "row_key"]


def site_first(spark: SparkSession, folder: str) -> DataFrame:
    return consolidate.site_first(sites_c(spark, folder), ORDER)


def first_non_null(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    states = table(spark, folder, "customer").select(
        "c_nationkey", "c_custkey", known(sentinel_state(k)).alias("state"), F.when(k % 3 == 1, F.col("c_name")).alias("name")
    )
    return states.groupBy("c_nationkey").agg(
        consolidate.first_non_null(F.col("state"), ["c_custkey"]).alias("state"),
        consolidate.first_non_null(F.col("name"), ["c_custkey"]).alias("name"),
    )


def latest_date(spark: SparkSession, folder: str) -> DataFrame:
    return all_sites(spark, folder).groupBy(*SITE_KEY).agg(
        consolidate.latest_date(F.col("commissioning_date")).alias("commissioning_date")
    )


def total_points(spark: SparkSession, folder: str) -> DataFrame:
    return all_sites(spark, folder).groupBy(*SITE_KEY).agg(
        consolidate.total_points(F.col("number_of_charging_points")).alias("number_of_charging_points")
    )


def max_capacity(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        consolidate.max_capacity(F.col("l_extendedprice")).alias("power_connection_capacity")
    )


def distinct_tokens(spark: SparkSession, folder: str) -> DataFrame:
    lists = F.array(F.col("o_orderpriority"), F.col("o_orderstatus"))
    orders = table(spark, folder, "orders").select("o_custkey", lists.alias("plug_types"))
    tokens = consolidate.distinct_tokens(orders, ["o_custkey"], ["plug_types"])
    return tokens.select("o_custkey", F.array_join("plug_types", ",").alias("plug_types"))


_REASONS_SQL = " UNION ALL ".join(
    f"SELECT *, '{reason}' AS reason FROM s WHERE {bad}"
    for reason, bad in {
        "bbox": BBOX_SQL,
        "year": YEAR_SQL,
        "count_range": COUNT_SQL,
        "missing_coordinates": NO_COORDINATES_SQL,
    }.items()
)

QUERIES = {
    "bbox_anomalies": Query(bbox_anomalies, f"SELECT * FROM ({SITES_C_SQL}) WHERE {BBOX_SQL}"),
    "year_anomalies": Query(year_anomalies, f"SELECT * FROM ({SITES_A_SQL}) WHERE {YEAR_SQL}"),
    "count_range_anomalies": Query(
        count_range_anomalies,
        f"""SELECT * FROM (SELECT l_orderkey, l_linenumber,
            CAST(l_quantity AS INTEGER) % 24 AS number_of_charging_points FROM lineitem) WHERE {COUNT_SQL}""",
    ),
    "anomalies_with_reason": Query(anomalies_with_reason, f"WITH s AS ({STATIONS_SQL}) {_REASONS_SQL}"),
    "clean_rows": Query(
        clean_rows,
        f"""WITH s AS ({STATIONS_SQL}), bad AS ({_REASONS_SQL})
        SELECT * FROM s EXCEPT SELECT * EXCLUDE (reason) FROM bad""",
    ),
    "anomaly_counts": Query(
        anomaly_counts,
        f"""WITH s AS ({STATIONS_SQL}), bad AS ({_REASONS_SQL})
        SELECT reason, count(*) AS rows FROM bad GROUP BY reason""",
    ),
    "union_sources": Query(all_sites, ALL_SITES_SQL),
    "site_first": Query(
        site_first,
        f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
            PARTITION BY latitude, longitude ORDER BY row_key) AS place FROM ({SITES_C_SQL})) WHERE place = 1""",
    ),
    "first_non_null": Query(
        first_non_null,
        f"""WITH s AS (SELECT *, {STATE_SQL.format(k="c_custkey")} AS state FROM customer)
        SELECT c_nationkey,
            arg_min(state, c_custkey) FILTER (WHERE state NOT IN ('N.A', 'UNKNOWN', 'UNKOWN', '')) AS state,
            arg_min(c_name, c_custkey) FILTER (WHERE c_custkey % 3 = 1) AS name
        FROM s GROUP BY c_nationkey""",
    ),
    "latest_date": Query(
        latest_date,
        f"""SELECT latitude, longitude, max(commissioning_date) AS commissioning_date
        FROM ({ALL_SITES_SQL}) GROUP BY latitude, longitude""",
    ),
    "total_points": Query(
        total_points,
        f"""SELECT latitude, longitude, CAST(sum(number_of_charging_points) AS BIGINT) AS number_of_charging_points
        FROM ({ALL_SITES_SQL}) GROUP BY latitude, longitude""",
    ),
    "max_capacity": Query(
        max_capacity,
        "SELECT l_suppkey, max(l_extendedprice) AS power_connection_capacity FROM lineitem GROUP BY l_suppkey",
    ),
    "distinct_tokens": Query(
        distinct_tokens,
        """SELECT o_custkey, string_agg(DISTINCT token, ',' ORDER BY token) AS plug_types
        FROM (SELECT o_custkey, o_orderpriority AS token FROM orders
            UNION ALL SELECT o_custkey, o_orderstatus FROM orders) GROUP BY o_custkey""",
    ),
}
