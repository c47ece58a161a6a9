"""The whole run: feeds to stages to one consolidated table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugsites.operators.areas import AreaIndex, stored_index
from plugsites.operators.checks import accepted, good_rows, reason_counters, rejected
from plugsites.operators.consolidate import consolidate, site_first
from plugsites.operators.shape import align_schema, union_sources
from plugsites.operators.tiles import tile_areas
from plugsites.plans.feeds import FEEDS, ROW_KEY, SOURCE, FeedSpec, transform_feed
from plugsites.schema import CANONICAL, SITES
from plugsites.sinks.manifest import Manifest, input_files, stage_key
from plugsites.sinks.stage import export_csv, scratch
from plugsites.sinks.warehouse import load_table
from plugsites.sources.boundaries import boundary_files, read_boundaries
from plugsites.sources.delimited import UNRESOLVED, UnreadableInput, scan_feed

ORDER = [SOURCE, ROW_KEY]


def feed_sites(checked: DataFrame) -> DataFrame:
    """First good row of each site of one feed.

    Duplicates need no removal here: they would give the same first row.
    """
    return site_first(good_rows(checked), ORDER)


def registry(checked_feeds: list[DataFrame]) -> DataFrame:
    """Consolidated sites of several checked feeds, as one lazy plan.

    Feeds are grouped on the site key, and Spark 4.1 keeps that partitioning over
    the union, so the final grouping adds no shuffle.
    """
    aligned = [
        align_schema(feed_sites(checked), CANONICAL, tuple(ORDER)) for checked in checked_feeds
    ]
    return consolidate(union_sources(aligned), ORDER)


@dataclass(frozen=True)
class RunConfig:
    feeds: dict[str, str | list[str]]
    """Raw files by feed name."""
    output: str
    """Folder for the stages and the result."""
    last_year: int | None = None
    """Last plausible commissioning year; None for the year of the run."""
    boundaries: dict[int, str] = field(default_factory=dict)
    """Boundary layer by level; without any, missing areas become UNKNOWN."""
    boundary_options: dict = field(default_factory=dict)
    specs: dict[str, FeedSpec] = field(default_factory=lambda: FEEDS)
    table: str | None = None
    """Table to replace by the exported sites, if any."""


@dataclass(frozen=True)
class RunReport:
    sites: DataFrame
    counts: dict[str, dict]
    """Rows and violations by feed, and sites in all."""
    skipped: list[str]
    """Inputs that could not be resolved."""
    columns: list[str]
    """Columns of the consolidated table."""
    bad_records: DataFrame | None = None
    """``raw, file`` of the export's records that the load left out; None without a table."""


def run(spark: SparkSession, config: RunConfig) -> RunReport:
    """Read each feed once into a stage, derive its outputs from there, consolidate.

    Below ``output``: ``checked``, ``transformed``, ``anomalies`` and ``grouped``
    for each feed, then ``sites`` (Parquet) and ``export`` (comma-separated).
    Stages are Parquet files, so later steps neither parse text again nor depend
    on executors that are gone. ``manifest`` marks those that are finished: a run into the
    same folder makes only stages whose inputs, parameters or files have changed since.
    """
    with scratch(spark):
        return _run(spark, config)


def _run(spark: SparkSession, config: RunConfig) -> RunReport:
    manifest = Manifest(spark, f"{config.output}/manifest")
    last_year = config.last_year
    if last_year is None:
        last_year = spark.range(1).select(F.year(F.current_date())).first()[0]
    tiles, index = stage_boundaries(spark, config, manifest)
    counts: dict[str, dict] = {}
    keys, skipped, grouped = [], [], []
    for name in config.feeds:
        spec, path = config.specs[name], f"{config.output}/{name}/checked"
        try:
            key = stage_key(name, input_files(spark, config.feeds[name]), spec, last_year, tiles)
            found, raw = manifest.finished(f"{name}/checked", path, key), None
            if found is None:
                raw = scan_feed(spark, config.feeds[name], spec.layout)
        except UNRESOLVED:
            skipped.append(name)
            continue
        if raw is not None:
            found = manifest.stage(
                f"{name}/checked",
                path,
                key,
                partial(transform_feed, raw, spec, last_year, index),
                {"rows": F.count(F.lit(1))} | reason_counters(),
            )
        counts[name] = {label: number for label, number in found.items() if number or label == "rows"}
        checked = spark.read.parquet(path)
        derived = {
            "transformed": partial(accepted, checked, ROW_KEY),
            "anomalies": partial(rejected, checked),
            "grouped": partial(feed_sites, checked),
        }
        for output, rows in derived.items():
            manifest.stage(f"{name}/{output}", f"{config.output}/{name}/{output}", key, rows)
        keys.append(key)
        grouped.append(spark.read.parquet(f"{config.output}/{name}/grouped"))
    if not grouped:
        raise UnreadableInput(f"no readable input among {list(config.feeds)}")

    def sites() -> DataFrame:
        aligned = [align_schema(frame, CANONICAL, tuple(ORDER)) for frame in grouped]
        return consolidate(union_sources(aligned), ORDER)

    stored, export, key = f"{config.output}/sites", f"{config.output}/export", stage_key("sites", keys)
    counts["sites"] = manifest.stage("sites", stored, key, sites, {"rows": F.count(F.lit(1))})
    manifest.step("export", export, key, lambda: {"files": export_csv(spark, stored, export)})
    result, bad = spark.read.parquet(stored), None
    if config.table:
        bad = load_table(spark, f"{export}/part-*.csv", SITES, config.table)
        rows = [tuple(row) for row in bad.collect()]  # at most the budget
        bad = spark.createDataFrame(rows, bad.schema)
        counts["bad_records"] = {"rows": len(rows)}
    return RunReport(result, counts, skipped, result.columns, bad)


def stage_boundaries(
    spark: SparkSession, config: RunConfig, manifest: Manifest
) -> tuple[str, AreaIndex | None]:
    """Tile the boundary layers once; every feed reads the tiles from the stage."""
    if not config.boundaries:
        return "", None
    path = f"{config.output}/tiles"
    files = [
        (level, input_files(spark, boundary_files(layer)))
        for level, layer in sorted(config.boundaries.items())
    ]
    key = stage_key("tiles", files, sorted(config.boundary_options.items()))

    def tiles() -> DataFrame:
        return tile_areas(read_boundaries(spark, config.boundaries, **config.boundary_options))

    manifest.stage("tiles", path, key, tiles)
    return key, stored_index(spark, path)
