"""Records that run over several lines, put together in parallel.

Whether a line begins inside a quoted value depends on all lines before it, yet each line
only keeps, flips or sets that state. So the state is a running aggregate: within each
split first, then over one summary row per split. The same holds for files of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plugsites.sinks.stage import shared_folder, write_stage


def line_patterns(sep: str, quote: str, escape: str) -> tuple[str, str]:
    """Patterns for lines that end outside any quoted value: begun outside, begun inside."""
    s, q, e = (f"\\{char}" for char in (sep, quote, escape))
    if quote == escape:  # two quotes are one in the value; a stray one ends nothing
        content = rf"[^{q}]*+(?:(?:{q}{q}|{q}(?!{q}|{s}|\z))[^{q}]*+)*+"
    else:
        content = rf"[^{q}{e}]*+(?:(?:{e}.|{q}(?!{s}|\z))[^{q}{e}]*+)*+"
    value = rf"(?>{q}{content}{q}(?={s}|\z)|(?!{q})[^{s}]*+)"
    return rf"(?s)\A{value}(?:{s}{value})*+\z", rf"(?s)\A{content}{q}(?:{s}{value})*+\z"


def _with_state(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """State after each row, from ``flip`` (0 or 1) and ``fixed`` (0, 1 or NULL).

    ``known`` is the state where some row so far has set it, else NULL; then
    ``turns`` tells whether the state before the first row is turned over.
    """
    so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("flips", F.sum("flip").over(so_far))
    mark = F.when(F.col("fixed").isNotNull(), F.struct("fixed", "flips"))
    df = df.withColumn("mark", F.last(mark, ignorenulls=True).over(so_far))
    known = (F.col("mark.fixed") + F.col("flips") - F.col("mark.flips")) % 2
    return df.withColumns({"known": known, "turns": F.col("flips") % 2}).drop("mark", "flips")


def _resolved(known: Column, turns: Column, before: Column | int) -> Column:
    return F.coalesce(known, (turns + before) % 2)


def stage_lines(spark: SparkSession, files: list[str], layout) -> DataFrame:
    """Decoded lines with their place and their effect on the state, from a written table.

    Where a split begins depends on the executors present when a scan is planned.
    All later steps must see the same splits, so the scan runs once, into a stage.
    """
    raw = F.col("value")
    if layout.charset.upper() in ("UTF-8", "UTF8"):
        text = F.make_valid_utf8(raw)
    else:
        text = F.decode(raw.cast("binary"), layout.charset)
    lines = spark.read.text(files).select(
        text.alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"),
    )
    if layout.records != "lines":
        outside, inside = line_patterns(layout.sep, layout.quote, layout.escape)
        keeps, closes = F.col("value").rlike(outside), F.col("value").rlike(inside)
        lines = lines.withColumns(
            {
                "flip": F.when(~keeps & closes, 1).otherwise(0),
                "fixed": F.when(keeps & closes, 0).when(~keeps & ~closes, 1),
            }
        )
    path = shared_folder(spark, "lines")
    write_stage(lines, path)
    return spark.read.schema(lines.schema).parquet(path)


def numbered_records(lines: DataFrame) -> DataFrame:
    """``value, file, line, unclosed``: the text of each record and its number in its file.

    Texts are shuffled once, by split; only records of several lines are grouped. A value
    that is still open at the end of its file has no end to be found: the states of the
    splits tell, and the lines of that record are given out one by one, ``unclosed``. So a
    stray quote in a large file makes no record of the rest of it. They are numbered on
    from the record that they would have made, in no order among them.
    """
    split = ["file", "split"]
    lines = _with_state(lines, split, "id")
    in_order = Window.partitionBy(*split).orderBy("id")
    lines = lines.withColumns(
        {
            "before_known": F.lag("known").over(in_order),
            "before_turns": F.lag("turns", 1, 0).over(in_order),
        }
    )

    def starts(entering: Column | int) -> Column:
        before = _resolved(F.col("before_known"), F.col("before_turns"), entering)
        return F.when(before == 0, 1).otherwise(0)

    # One row per split: its state at the end, and how many records start in it
    # if it begins outside or inside a quoted value.
    splits = lines.groupBy(*split).agg(
        F.max_by(F.struct("known", "turns"), "id").alias("end"),
        F.sum(starts(F.lit(0))).alias("starts_outside"),
        F.sum(starts(F.lit(1))).alias("starts_inside"),
    )
    splits = splits.withColumns(
        {
            "fixed": F.col("end.known"),
            "flip": F.when(F.col("end.known").isNull(), F.col("end.turns")).otherwise(0),
        }
    )
    splits = _with_state(splits, ["file"], "split")
    by_split = Window.partitionBy("file").orderBy("split")
    splits = splits.withColumn("leaving", _resolved(F.col("known"), F.col("turns"), 0))
    splits = splits.withColumn("entering", F.lag("leaving", 1, 0).over(by_split))
    begun = F.when(F.col("entering") == 0, F.col("starts_outside")).otherwise(F.col("starts_inside"))
    splits = splits.withColumn("begun", begun)
    splits = splits.withColumn("earlier", F.sum("begun").over(by_split) - F.col("begun"))
    # One row per split still: the file's last record, if its value is never closed.
    of_file = Window.partitionBy("file")
    last = F.max_by("leaving", "split").over(of_file) == 1
    splits = splits.withColumn("unclosed", F.when(last, F.sum("begun").over(of_file) - 1))

    lines = lines.join(splits.select(*split, "entering", "earlier", "unclosed"), split)
    lines = lines.withColumns(
        {
            "starts": starts(F.col("entering")),
            "open": _resolved(F.col("known"), F.col("turns"), F.col("entering")),
        }
    )
    running = in_order.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("line", F.col("earlier") + F.sum("starts").over(running) - 1)
    unclosed = F.coalesce(F.col("line") == F.col("unclosed"), F.lit(False))
    alone = unclosed | (F.col("starts") == 1) & (F.col("open") == 0)
    single = lines.where(alone).select("value", "file", "line", unclosed.alias("unclosed"))
    parts = F.array_sort(F.collect_list(F.struct("split", "id", "value")))
    joined = (
        lines.where(~alone)
        .groupBy("file", "line")
        .agg(F.array_join(F.transform(parts, lambda part: part["value"]), "\n").alias("value"))
        .withColumn("unclosed", F.lit(False))
    )
    return single.unionByName(joined)
