"""Stations derived from the driver tables.

``k`` is the source table's key. The formulas are written once more in SQL, for
the oracle, next to each frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LAST_YEAR = 2026


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def latitude(k: Column) -> Column:
    return F.lit(47.0) + ((k * 53) % 211).cast("double") / 25


def longitude(k: Column) -> Column:
    return F.lit(5.0) + ((k * 37) % 211).cast("double") / 20


def generated_date(k: Column) -> Column:
    return F.date_add(F.lit("1998-01-01").cast("date"), ((k * 97) % 12000).cast("int"))


def sentinel_state(k: Column) -> Column:
    return (
        F.when(k % 5 == 0, "N.A").when(k % 5 == 1, "UNKNOWN").when(k % 5 == 2, "").when(k % 5 == 4, "Hessen")
    )


def _sites(df: DataFrame, src: int, key: str, operator: str, date: Column) -> DataFrame:
    k = F.col(key)
    return df.select(
        F.lit(src).alias("src"),
        k.alias("row_key"),
        F.col(operator).alias("operator"),
        latitude(k).alias("latitude"),
        longitude(k).alias("longitude"),
        (k % 24).cast("int").alias("number_of_charging_points"),
        date.alias("commissioning_date"),
    )


def sites_a(spark: SparkSession, folder: str) -> DataFrame:
    key = "c_custkey"
    return _sites(table(spark, folder, "customer"), 1, key, "c_name", generated_date(F.col(key)))


def sites_b(spark: SparkSession, folder: str) -> DataFrame:
    key = "s_suppkey"
    return _sites(table(spark, folder, "supplier"), 2, key, "s_name", generated_date(F.col(key)))


def sites_c(spark: SparkSession, folder: str) -> DataFrame:
    date = F.date_add(F.col("o_orderdate").cast("date"), 1500)
    return _sites(table(spark, folder, "orders"), 3, "o_orderkey", "o_orderpriority", date)


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Stations from ``lineitem``, many of them equal and some without a latitude."""
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    return table(spark, folder, "lineitem").select(
        F.when(order % 50 != 0, latitude(order)).alias("latitude"),
        longitude(part).alias("longitude"),
        F.date_add(F.col("l_shipdate").cast("date"), 1500).alias("commissioning_date"),
        (F.col("l_quantity").cast("int") % 24).alias("number_of_charging_points"),
        F.col("l_returnflag").alias("operator"),
    )


LATITUDE_SQL = "CAST(47.0 AS DOUBLE) + CAST(({k} * 53) % 211 AS DOUBLE) / 25"
LONGITUDE_SQL = "CAST(5.0 AS DOUBLE) + CAST(({k} * 37) % 211 AS DOUBLE) / 20"
DATE_SQL = "DATE '1998-01-01' + CAST(({k} * 97) % 12000 AS INTEGER)"
ORDER_DATE_SQL = "CAST(o_orderdate AS DATE) + 1500"
STATE_SQL = (
    "CASE {k} % 5 WHEN 0 THEN 'N.A' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN '' WHEN 4 THEN 'Hessen' END"
)


def _sites_sql(src: int, source: str, k: str, operator: str, date: str) -> str:
    return f"""SELECT {src} AS src, {k} AS row_key, {operator} AS operator,
        {LATITUDE_SQL.format(k=k)} AS latitude, {LONGITUDE_SQL.format(k=k)} AS longitude,
        CAST({k} % 24 AS INTEGER) AS number_of_charging_points, {date} AS commissioning_date
    FROM {source}"""


SITES_A_SQL = _sites_sql(1, "customer", "c_custkey", "c_name", DATE_SQL.format(k="c_custkey"))
SITES_B_SQL = _sites_sql(2, "supplier", "s_suppkey", "s_name", DATE_SQL.format(k="s_suppkey"))
SITES_C_SQL = _sites_sql(3, "orders", "o_orderkey", "o_orderpriority", ORDER_DATE_SQL)
ALL_SITES_SQL = f"{SITES_A_SQL} UNION ALL {SITES_B_SQL} UNION ALL {SITES_C_SQL}"

STATIONS_SQL = f"""SELECT
        CASE WHEN l_orderkey % 50 <> 0 THEN {LATITUDE_SQL.format(k="l_orderkey")} END AS latitude,
        {LONGITUDE_SQL.format(k="l_partkey")} AS longitude,
        CAST(l_shipdate AS DATE) + 1500 AS commissioning_date,
        CAST(l_quantity AS INTEGER) % 24 AS number_of_charging_points,
        l_returnflag AS operator
    FROM lineitem"""

# The checks as conditions, written apart from the library.
BBOX_SQL = "(latitude < 47.2 OR latitude > 55.1 OR longitude < 5.5 OR longitude > 15.1)"
YEAR_SQL = (
    f"(year(commissioning_date) < 2000 OR year(commissioning_date) > {LAST_YEAR})"
)
COUNT_SQL = "(number_of_charging_points < 1 OR number_of_charging_points > 20)"
NO_COORDINATES_SQL = "(latitude IS NULL OR longitude IS NULL)"
GOOD_SQL = " AND ".join(
    f"{bad} IS NOT TRUE" for bad in (BBOX_SQL, YEAR_SQL, COUNT_SQL, NO_COORDINATES_SQL)
)
