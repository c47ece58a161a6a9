"""What the physical plans must and must not contain."""

import re

import pytest

from plugsites.catalog import all_queries
from plugsites.catalog.feeds import consolidated_sites, raw_a
from plugsites.plans.feeds import FEED_A, transform_feed
from plugsites.sources.delimited import scan_feed


def queries():
    return {name: query.build for name, query in all_queries().items()}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def nodes(text, name):
    return len(re.findall(rf"^[ :+\-*()\d]*{name}\b", text, re.MULTILINE))


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_nested_loops(spark, folder, name):
    text = plan(queries()[name](spark, folder))
    for forbidden in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


def test_each_feed_is_scanned_once_and_shuffled_once(spark, folder):
    text = plan(consolidated_sites(spark, folder))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert sum("tile_x" not in line for line in scans) == 3
    by_site = re.findall(r"Exchange hashpartitioning\(latitude#\d+, longitude#\d+", text)
    assert len(by_site) == 3, "one per feed, none after the union"
    assert len(re.findall("Exchange", text)) == 3 + 2 * sum("tile_x" in line for line in scans)


@pytest.mark.parametrize("name", ["point_in_polygon", "point_in_polygon_levels", "enrich_missing_state"])
def test_points_are_matched_by_tile_and_not_shuffled(spark, folder, name):
    text = plan(queries()[name](spark, folder))
    join = text[text.index("BroadcastHashJoin"):]
    points = join[: join.index("BroadcastExchange")]
    assert "Exchange" not in points and "FileScan" in points


def test_one_broadcast_serves_all_depths(spark, folder):
    found = queries()["point_in_polygon_levels"](spark, folder)
    found.collect()
    final = plan(found).split("Initial Plan")[0]
    joins, tables = nodes(final, "BroadcastHashJoin"), nodes(final, "BroadcastExchange")
    assert joins > 1 and tables == 1 and nodes(final, "ReusedExchange") == joins - 1


@pytest.mark.parametrize("name", ["anomalies_with_reason", "clean_rows", "anomaly_counts"])
def test_checks_read_their_input_once(spark, folder, name):
    text = plan(queries()[name](spark, folder))
    assert nodes(text, "FileScan parquet") == 1
    assert text.count("Exchange") == {"anomalies_with_reason": 0}.get(name, 1)


def test_scans_read_only_needed_columns(spark, folder):
    text = plan(queries()["max_capacity"](spark, folder))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in text


def test_simple_filters_reach_the_scan(spark, folder):
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").where("l_quantity > 20")
    assert "GreaterThan(l_quantity,20.0)" in plan(rows)


def test_clean_feed_of_a_wide_file_plans_quickly(spark):
    """The all-NULL filter names every column; renaming must not multiply it."""
    raw = scan_feed(spark, "tests/data/feed_a.csv", FEED_A.layout)
    wide = raw.withColumns({f"Steckertypen{i}": raw["Steckertypen1"] for i in range(4, 7)})
    text = plan(transform_feed(wide, FEED_A, 2026))
    assert nodes(text, "FileScan text") == 0, "text is read once, into the stage"
    assert len(re.findall(r"FileScan parquet \[value", text)) == 1


def test_raw_frame_is_rendered_once(spark, folder):
    text = plan(transform_feed(raw_a(spark, folder), FEED_A, 2026))
    assert text.count("date_format") == 1


def test_list_elements_are_reduced_before_they_meet(spark, folder):
    """One exchange by site and element, one of what is left by site; no set of lists."""
    text = plan(queries()["distinct_tokens"](spark, folder))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^\n]*?), \d+\)", text)
    assert len(exchanges) == 2 and "element" in exchanges[1] and "element" not in exchanges[0]
    assert "collect_set" not in text
