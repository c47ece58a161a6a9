"""Queries for sources and sinks: tables are written as raw files and read back.

Files go to a new folder below the one the session names for checkpoints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugsites.catalog import Query
from plugsites.catalog.frames import table
from plugsites.operators.shape import union_sources
from plugsites.sinks.stage import compact, shared_folder, write_stage
from plugsites.sinks.warehouse import parse_with_budget
from plugsites.sources.delimited import (
    ROW_BITS,
    Layout,
    landed_lines,
    read_tolerant,
    scan_delimited,
    scan_feed,
)


def _write_raw(df: DataFrame, sep: str) -> str:
    path = shared_folder(df.sparkSession, "raw")
    df.write.csv(path, header=True, sep=sep)
    return path


def _write_lines(df: DataFrame, header: str, line: Column) -> str:
    """Text files of given lines, each beginning with the header."""
    path = shared_folder(df.sparkSession, "raw")
    starts_file = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)) == 0
    text = F.when(starts_file, F.concat(F.lit(f"{header}\n"), line)).otherwise(line)
    df.select(text.alias("value")).write.text(path)
    return path


def scan_semicolon_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Two sets of files, which order their columns differently, with blank lines."""
    raw = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("Anzahl Ladepunkte"),
        F.concat("c_name", F.lit('; "Süd", §')).alias("Betreiber"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("Straße"),
    )
    odd = F.col("Anzahl Ladepunkte").cast("long") % 2 == 1
    other = raw.where(odd).select("Straße", "Betreiber", "Anzahl Ladepunkte")
    quoted = F.concat(F.lit('"'), F.replace("Betreiber", F.lit('"'), F.lit('\\"')), F.lit('"'))
    line = F.concat_ws(";", F.coalesce("Straße", F.lit("")), quoted, F.concat("Anzahl Ladepunkte", F.lit("\n  \n")))
    paths = [
        _write_raw(raw.where(~odd), ";"),
        _write_lines(other, "Straße;Betreiber;Anzahl Ladepunkte", line),
    ]
    return scan_delimited(spark, paths, Layout(sep=";", records="lines"))


def scan_comma_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Values with line feeds and stray quotes; two column orders; some blank lines."""
    raw = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("ID"),
        F.when(F.col("p_partkey") % 5 == 0, F.concat("p_name", F.lit(",\n"), "p_type"))
        .otherwise(F.col("p_name"))
        .alias("AddressLine1"),
        F.col("p_brand").alias("Town"),
    )
    odd = F.col("ID").cast("long") % 2 == 1
    town = F.concat("Town", F.lit(' 5" wide'))
    line = F.concat(town, F.lit(',"'), "AddressLine1", F.lit('",'), "ID", F.lit("\n\n"))
    paths = [
        _write_raw(raw.where(~odd), ","),
        _write_lines(raw.where(odd), "Town,AddressLine1,ID", line),
    ]
    return scan_delimited(spark, paths, Layout(sep=","))


def lines_after_preamble(spark: SparkSession, folder: str) -> DataFrame:
    """Write ISO-8859-1 files that begin with ten other lines, read the rest."""
    line = F.concat(F.lit("Säule "), "o_orderkey", F.lit(";"), "o_orderpriority")
    preamble = F.lit("".join("\n" if i == 4 else f"Vorbemerkung für {i}\n" for i in range(10)))
    starts_file = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)) == 0
    text = F.when(starts_file, F.concat(preamble, line)).otherwise(line)
    path = shared_folder(spark, "landing")
    table(spark, folder, "orders").select(F.encode(text, "ISO-8859-1").cast("string").alias("value")).write.text(path)
    return landed_lines(spark, path, "ISO-8859-1", skip=10)


def stage_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    fragments, compacted = shared_folder(spark, "stage"), shared_folder(spark, "compacted")
    write_stage(table(spark, folder, "orders"), fragments)
    compact(spark, fragments, compacted)
    return spark.read.parquet(compacted)


def tolerant_sources(spark: SparkSession, folder: str) -> DataFrame:
    """A feed that can be read beside one that is missing, an empty one, one without header."""
    raw = table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name"
    )
    missing, empty, headless = (shared_folder(spark, name) for name in ("none", "empty", "short"))
    raw.limit(0).select("s_name").coalesce(1).write.text(empty)
    spark.createDataFrame([("only a preamble",)], "value string").coalesce(1).write.text(headless)
    good = _write_lines(raw.coalesce(1), "a preamble\ns_suppkey,s_name", F.concat_ws(",", *raw.columns))
    frames, skipped = read_tolerant(
        [missing, good, empty, headless], lambda path: scan_feed(spark, path, Layout(preamble=1))
    )
    return union_sources(frames).withColumn("n_skipped", F.lit(len(skipped)))


PART = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)


def load_bad_record_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Every 50th record is spoiled, up to the 100 that a load may tolerate."""
    k = F.col("p_partkey")
    spoiled = (k % 50 == 0) & (k < 5000)
    raw = table(spark, folder, "part").select(
        F.when(spoiled, F.concat(F.lit("no"), k)).otherwise(k.cast("string")).alias("p_partkey"),
        "p_name",
        F.col("p_retailprice").cast("string").alias("p_retailprice"),
    )
    good, _ = parse_with_budget(spark, f"{_write_raw(raw, ',')}/part-*.csv", PART)
    return good


QUERIES = {
    "scan_semicolon_csv": Query(
        scan_semicolon_csv,
        """SELECT CAST(c_custkey AS VARCHAR) AS "Anzahl Ladepunkte", c_name || '; "Süd", §' AS Betreiber,
            CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS Straße FROM customer""",
    ),
    "scan_comma_csv": Query(
        scan_comma_csv,
        """SELECT CAST(p_partkey AS VARCHAR) AS ID,
            CASE WHEN p_partkey % 5 = 0 THEN p_name || ',' || chr(10) || p_type ELSE p_name END AS AddressLine1,
            p_brand || CASE WHEN p_partkey % 2 = 1 THEN ' 5" wide' ELSE '' END AS Town FROM part""",
    ),
    "landed_lines": Query(
        lines_after_preamble,
        "SELECT 'Säule ' || o_orderkey || ';' || o_orderpriority AS value FROM orders",
    ),
    "stage_roundtrip": Query(stage_roundtrip, "SELECT * FROM orders"),
    "tolerant_sources": Query(
        tolerant_sources,
        "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(3 AS INTEGER) AS n_skipped FROM supplier",
    ),
    "load_bad_record_budget": Query(
        load_bad_record_budget,
        """SELECT p_partkey, p_name, p_retailprice FROM part
        WHERE NOT (p_partkey % 50 = 0 AND p_partkey < 5000)""",
    ),
}
