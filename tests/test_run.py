"""The whole run on small hand-written feed files."""

import datetime as dt
import shutil
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plugsites.plans import registry
from plugsites.plans.feeds import FEED_A, FEED_B, FEED_C, transform_feed
from plugsites.plans.registry import RunConfig, run
from plugsites.schema import CANONICAL
from plugsites.sinks.stage import read_csv, shared_folder
from plugsites.sources.delimited import scan_feed

DATA = "tests/data"


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    output = str(tmp_path_factory.mktemp("run"))
    config = RunConfig(
        feeds={
            "a": f"{DATA}/feed_a.csv",
            "b": f"{DATA}/feed_b.csv",
            "c": [f"{DATA}/feed_c.csv"],
        },
        output=output,
        last_year=2026,
        boundaries={1: f"{DATA}/states.geojsonl"},
        table="plugsites_run",
    )
    spark.sql("DROP TABLE IF EXISTS plugsites_run")
    return run(spark, config), output


def by_site(frame):
    return {(row.latitude, row.longitude): row for row in frame.collect()}


def test_feed_a_is_typed(spark):
    raw = scan_feed(spark, f"{DATA}/feed_a.csv", FEED_A.layout)
    rows = transform_feed(raw, FEED_A, 2026).collect()
    assert len(rows) == 7, "the empty row is gone, the duplicate is not"
    row = rows[0]
    assert row.operator == "Stadtwerke Süd"
    assert row.plug_types == ["Type 2 (AC)", "Eigenbau"]
    assert row.power_capacities_kw == [22.5]
    assert row.postal_code == "01067"
    assert row.street == "Große Allee "
    assert row.commissioning_date == dt.date(2020, 2, 1)
    assert (row.latitude, row.longitude, row.power_connection_capacity) == (52.52, 13.405, 22.5)
    assert row.violations == []


def test_unreadable_count_is_kept_in_a_and_one_in_b(spark):
    a = transform_feed(scan_feed(spark, f"{DATA}/feed_a.csv", FEED_A.layout), FEED_A, 2026)
    counts = {row.operator: row.number_of_charging_points for row in a.collect()}
    assert counts["Ohne Zahl"] is None and counts["Ohne Angabe"] == 1
    b = transform_feed(scan_feed(spark, f"{DATA}/feed_b.csv", FEED_B.layout), FEED_B, 2026)
    assert {row.latitude: row.number_of_charging_points for row in b.collect()}[52.64] == 1


def test_quoted_line_feed_stays_in_its_value(spark):
    b = transform_feed(scan_feed(spark, f"{DATA}/feed_b.csv", FEED_B.layout), FEED_B, 2026)
    row = b.where("latitude = 52.52").first()
    assert row.street == "Marktplatz 1"
    assert row.operator == 'Netz "Eins"'
    assert row.plug_types == ["CHAdeMO (DC)", "X"]
    assert (row.usage_type, row.status_type) == ("Public", "Operational")


def test_equal_coordinates_written_differently_are_one_site(spark, finished):
    grouped = spark.read.parquet(f"{finished[1]}/c/grouped")
    assert sorted((row.latitude, row.longitude) for row in grouped.collect()) == [(50.1, 8.2), (52.52, 13.405)]


def test_rejected_rows_have_their_reasons(spark, finished):
    report, output = finished
    reasons = sorted((row.operator, row.reason) for row in spark.read.parquet(f"{output}/a/anomalies").collect())
    assert reasons == [("Alt", "bbox"), ("Alt", "year"), ("Ortlos", "missing_coordinates")]
    counts = spark.read.parquet(f"{output}/b/anomalies").collect()
    assert sorted((row.latitude, row.reason) for row in counts) == [(52.61, "count_range"), (52.63, "count_range")]
    assert report.counts["a"] == {"rows": 7, "bbox": 1, "year": 1, "missing_coordinates": 1}
    assert report.counts["b"] == {"rows": 6, "count_range": 2}
    assert report.counts["c"] == {"rows": 4, "missing_coordinates": 1}


def test_duplicates_are_removed_from_accepted_rows(spark, finished):
    rows = spark.read.parquet(f"{finished[1]}/a/transformed")
    assert rows.count() == 4
    assert rows.where("operator = 'Stadtwerke Süd'").count() == 1


def test_sites_are_consolidated(finished):
    report, _ = finished
    assert report.sites.columns == CANONICAL.names
    assert report.skipped == []
    sites = by_site(report.sites)
    assert report.counts["sites"] == {"rows": len(sites)}
    shared = sites[(52.52, 13.405)]
    assert shared.operator == "Stadtwerke Süd"
    assert shared.number_of_charging_points == 2 + 4 + 5
    assert shared.plug_types == "CCS Combo 2 (DC),CHAdeMO (DC),Eigenbau,Type 2 (AC),X"
    assert shared.power_capacities_kw == "9,22.5"
    assert shared.power_connection_capacity == 22.5
    assert shared.commissioning_date == dt.date(2021, 1, 1)
    assert (shared.state, shared.district_city, shared.city) == ("Sachsen", "Landkreis Görlitz", "Weißwasser")
    assert shared.postal_code == "01067"


def test_missing_states_come_from_the_boundaries(finished):
    sites = by_site(finished[0].sites)
    assert sites[(52.7, 13.405)].state == "Below", "inside the hole of the first area"
    assert sites[(52.6, 13.405)].state == "Sachsen"
    assert sites[(52.62, 13.405)].state == "Ring"
    assert sites[(50.1, 8.2)].state == "Two parts"
    assert sites[(52.6, 13.405)].district_city == "Landkreis Görlitz"
    assert sites[(52.62, 13.405)].district_city == "UNKNOWN", "no layer for districts"
    assert sites[(47.2, 15.1)].number_of_charging_points == 20


def test_export_is_one_readable_file(spark, finished):
    report, output = finished
    export = read_csv(spark, f"{output}/export")
    assert export.columns == CANONICAL.names
    assert export.count() == report.sites.count()
    assert len(export.inputFiles()) == 1


def test_loaded_table_equals_the_sites(spark, finished):
    table = spark.table("plugsites_run")
    assert table.schema.simpleString() == finished[0].sites.schema.simpleString()
    empty_as_null = finished[0].sites.replace("", None)
    assert {str(row) for row in table.collect()} == {str(row) for row in empty_as_null.collect()}


def test_missing_feed_is_reported(spark, tmp_path):
    config = RunConfig(
        feeds={"b": "/no/such/file.csv", "c": f"{DATA}/feed_c.csv"}, output=str(tmp_path), last_year=2026
    )
    report = run(spark, config)
    assert report.skipped == ["b"] and report.sites.count() == 2
    with pytest.raises(ValueError):
        run(spark, RunConfig(feeds={"b": "/no/such/file.csv"}, output=str(tmp_path), last_year=2026))


def test_absent_columns_become_typed_nulls(spark):
    raw = spark.createDataFrame([("50.1, 8.2",)], "koordinaten string")
    row = transform_feed(raw, FEED_C, 2026)
    assert [field.dataType for field in row.schema.fields[:16]] == [field.dataType for field in CANONICAL.fields]
    assert row.first().state == "UNKNOWN"


def copied_feeds(tmp_path):
    feeds = {}
    for name in "abc":
        feeds[name] = str(tmp_path / f"feed_{name}.csv")
        shutil.copyfile(f"{DATA}/feed_{name}.csv", feeds[name])
    return feeds


@pytest.fixture
def scanned(monkeypatch):
    """Files that a run scans."""
    names = []
    scan = registry.scan_feed

    def counted(spark, paths, layout):
        names.append(Path(paths).name)
        return scan(spark, paths, layout)

    monkeypatch.setattr(registry, "scan_feed", counted)
    return names


def test_a_run_that_broke_goes_on_where_it_stopped(spark, tmp_path, scanned, monkeypatch):
    config = RunConfig(copied_feeds(tmp_path), str(tmp_path / "out"), 2026, {1: f"{DATA}/states.geojsonl"})
    transform = registry.transform_feed

    def broken(raw, spec, *rest):
        rows = transform(raw, spec, *rest)
        return rows.withColumn("city", F.raise_error(F.lit("feed c is broken"))) if spec.name == "c" else rows

    monkeypatch.setattr(registry, "transform_feed", broken)
    with pytest.raises(Exception, match="feed c is broken"):
        run(spark, config)
    assert scanned == ["feed_a.csv", "feed_b.csv", "feed_c.csv"]
    monkeypatch.setattr(registry, "transform_feed", transform)
    scanned.clear()
    report = run(spark, config)
    assert scanned == ["feed_c.csv"]
    whole = run(spark, replace(config, output=str(tmp_path / "other")))
    assert report.counts == whole.counts
    assert sorted(map(str, report.sites.collect())) == sorted(map(str, whole.sites.collect()))


def test_only_what_changed_is_made_again(spark, tmp_path, scanned):
    config = RunConfig(copied_feeds(tmp_path), str(tmp_path / "out"), 2026)
    first = run(spark, config)
    scanned.clear()
    again = run(spark, config)
    assert scanned == [] and again.counts == first.counts

    with open(config.feeds["c"], "a", encoding="utf-8") as file:
        file.write(Path(config.feeds["c"]).read_text("utf-8").splitlines()[1] + "\n")
    assert run(spark, config).counts["c"]["rows"] == first.counts["c"]["rows"] + 1
    assert scanned == ["feed_c.csv"]

    scanned.clear()
    run(spark, replace(config, last_year=2019))
    assert scanned == ["feed_a.csv", "feed_b.csv", "feed_c.csv"]


def test_stages_that_lost_files_are_made_again(spark, tmp_path, scanned):
    config = RunConfig(copied_feeds(tmp_path), str(tmp_path / "out"), 2026)
    first = run(spark, config)
    scanned.clear()
    for part in (tmp_path / "out" / "b" / "checked").glob("part-*"):
        part.unlink()
    shutil.rmtree(tmp_path / "out" / "sites")
    assert run(spark, config).counts == first.counts
    assert scanned == ["feed_b.csv"]


def test_scratch_tables_are_gone_after_a_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("plugsites.sinks.stage._scratch_base", lambda spark: str(tmp_path / "shared"))
    run(spark, RunConfig(copied_feeds(tmp_path), str(tmp_path / "out"), 2026, table="plugsites_scratch"))
    assert list((tmp_path / "shared").iterdir()) == []
    assert Path(shared_folder(spark, "kept")).parent == tmp_path / "shared"
