import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugsites.sinks.stage import compact, export_csv, read_csv, shared_folder, stored_bytes, write_csv, write_stage
from plugsites.sinks.warehouse import TooManyBadRecords, load_table, parse_with_budget, replace_table
from plugsites.sources.delimited import Layout, UnreadableInput, landed_lines, read_tolerant, scan_delimited, scan_feed


def write(path, text, charset="utf-8"):
    path.write_bytes(text.encode(charset))
    return str(path)


def test_preamble_charset_and_blank_lines(spark, tmp_path):
    path = write(tmp_path / "a.csv", "x\n\nfür\nname;wert\nSüd;1\n\n;2\n", "iso-8859-1")
    assert [row.value for row in landed_lines(spark, path, "ISO-8859-1", 3).collect()] == ["name;wert", "Süd;1", "", ";2"]
    table = scan_feed(spark, path, Layout(sep=";", charset="ISO-8859-1", preamble=3))
    assert [tuple(row) for row in table.collect()] == [("Süd", "1"), (None, "2")]
    assert table.columns == ["name", "wert"]


def test_preamble_is_skipped_once_per_file_and_not_per_split(spark, tmp_path):
    for i in range(3):
        lines = [f"junk {i}"] * 2 + ["name"] + [f"{i}-{j}" for j in range(2000)]
        write(tmp_path / f"{i}.csv", "\n".join(lines) + "\n")
    layout = Layout(preamble=2)
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        many = scan_feed(spark, str(tmp_path), layout)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        assert {row.name for row in many.collect()} == {f"{i}-{j}" for i in range(3) for j in range(2000)}
        assert many.count() == 6000
        assert landed_lines(spark, str(tmp_path / "0.csv"), skip=2).count() == 2001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def test_files_of_one_feed_may_order_their_columns_differently(spark, tmp_path):
    write(tmp_path / "1.csv", "p\na;b\n1;2\n")
    write(tmp_path / "2.csv", "p\nb;a\n4;3\n")
    table = scan_feed(spark, str(tmp_path), Layout(sep=";", preamble=1))
    assert sorted((row.a, row.b) for row in table.collect()) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("records", ["lines", "quoted", "auto"])
@pytest.mark.parametrize("preamble", [0, 1])
def test_every_way_of_reading_gives_one_result(spark, tmp_path, records, preamble):
    top = "prä,\n" * preamble
    write(tmp_path / "1.csv", top + "a,b\n1,2\n   \n\n3,\"x \"\"y\"\"\"\n")
    write(tmp_path / "2.csv", (top + "b,a\n4,3\n").replace("\n", "\r"))
    write(tmp_path / "3.csv", (top + "a,A,,b\n5,6,7,8\n").replace("\n", "\r\n"))
    layout = Layout(records=records, preamble=preamble, escape='"')
    table = scan_feed(spark, str(tmp_path), layout)
    assert set(table.columns) == {"a", "b", "a0", "A1", "_c2"}
    rows = {tuple(row[name] for name in ("a", "b", "a0", "A1", "_c2")) for row in table.collect()}
    assert rows == {
        ("1", "2", None, None, None),
        ("3", 'x "y"', None, None, None),
        ("3", "4", None, None, None),
        (None, "8", "5", "6", "7"),
    }


@pytest.mark.parametrize("preamble", [0, 1])
def test_open_values_are_found_by_the_grammar(spark, tmp_path, preamble):
    write(tmp_path / "1.csv", "p;\n" * preamble + 'id;t\n1;5" pipe;"open\nclose";3" x\n2;b;c\n')
    layout = Layout(sep=";", preamble=preamble)
    write(tmp_path / "2.csv", "p;\n" * preamble + 'id;t;u;v\n1;5" pipe;"open\nclose";3" x\n')
    rows = {row.id: row for row in scan_feed(spark, str(tmp_path / "2.csv"), layout).collect()}
    assert (rows["1"].t, rows["1"].u, rows["1"].v) == ('5" pipe', "open\nclose", '3" x')


def test_unreadable_folders_and_files_are_named(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    write(tmp_path / "zero.csv", "")
    write(tmp_path / "short.csv", "only a preamble\n")
    good = write(tmp_path / "good.csv", "p\na\n1\n")
    paths = [str(tmp_path / name) for name in ("empty", "zero.csv", "short.csv", "none")]
    for layout in (Layout(preamble=1), Layout(preamble=1, records="lines")):
        frames, skipped = read_tolerant([good, *paths], lambda p: scan_feed(spark, p, layout))
        assert [row.a for row in frames[0].collect()] == ["1"] and skipped == paths
    with pytest.raises(UnreadableInput):
        read_tolerant(paths, lambda p: scan_feed(spark, p, Layout(preamble=1)))
    for records in ("lines", "quoted", "auto"):
        with pytest.raises(UnreadableInput):
            scan_feed(spark, str(tmp_path / "zero.csv"), Layout(records=records))


def test_bytes_outside_the_charset_become_the_replacement_character(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes(b"p\nname\nS\xfcd\n")
    assert [row.name for row in scan_feed(spark, str(path), Layout(preamble=1)).collect()] == ["S�d"]


def test_byte_order_mark_is_ignored(spark, tmp_path):
    path = write(tmp_path / "c.csv", "﻿name;wert\nä;1\n")
    assert scan_delimited(spark, path, Layout(sep=";")).columns == ["name", "wert"]


def test_only_files_with_open_values_are_read_whole(spark, tmp_path):
    write(tmp_path / "1.csv", 'a,b\n1,"x, y"\n2,"say \\"hi\\""\n')
    write(tmp_path / "2.csv", 'a,b\n3,"two\nlines"\n')
    table = scan_delimited(spark, str(tmp_path), Layout())
    assert sorted(tuple(row) for row in table.collect()) == [("1", "x, y"), ("2", 'say "hi"'), ("3", "two\nlines")]
    per_line = scan_delimited(spark, str(tmp_path), Layout(records="lines"))
    assert per_line.count() == 4


def test_unreadable_sources_are_reported(spark, tmp_path):
    path = write(tmp_path / "c.csv", "a\n1\n")
    read = lambda name: scan_delimited(spark, name, Layout())
    frames, skipped = read_tolerant([path, "/no/such/file.csv"], read)
    assert len(frames) == 1 and skipped == ["/no/such/file.csv"]
    with pytest.raises(ValueError):
        read_tolerant(["/no/such/file.csv"], read)


def test_stage_metrics_and_compaction(spark, tmp_path):
    rows = spark.range(1000).repartition(8)
    metrics = write_stage(rows, str(tmp_path / "s"), {"rows": F.count(F.lit(1)), "top": F.max("id")})
    assert metrics == {"rows": 1000, "top": 999}
    assert compact(spark, str(tmp_path / "s"), str(tmp_path / "one")) == 1
    size = stored_bytes(spark, str(tmp_path / "s"))
    assert compact(spark, str(tmp_path / "s"), str(tmp_path / "few"), size // 3 + 1) == 3
    assert spark.read.parquet(str(tmp_path / "few")).count() == 1000
    assert len([name for name in os.listdir(tmp_path / "few") if name.endswith(".parquet")]) == 3


def test_empty_stage_gives_no_file(spark, tmp_path):
    write_stage(spark.range(0), str(tmp_path / "empty"))
    assert compact(spark, str(tmp_path / "empty"), str(tmp_path / "none")) == 0
    assert export_csv(spark, str(tmp_path / "empty"), str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()


def test_csv_interchange_reads_empty_text_as_null(spark, tmp_path):
    write_csv(spark.createDataFrame([("", "ä;,\""), (None, "x")], "a string, b string"), str(tmp_path / "i"))
    assert sorted((row.b, row.a) for row in read_csv(spark, str(tmp_path / "i")).collect()) == [("x", None), ('ä;,"', None)]


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base.rstrip("/"))


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("kw", T.DoubleType())])


def spoiled_files(tmp_path, bad):
    for part in range(2):
        lines = ["id,kw"] + [f"{i},1.5" for i in range(200)] + [f"x{i},1.5" for i in range(part, bad, 2)]
        write(tmp_path / f"part-{part}.csv", "\n".join(lines) + "\n")
    write(tmp_path / "other.csv", "id,kw\n1,2\n")
    return f"{tmp_path}/part-*.csv"


def test_a_hundred_bad_records_are_tolerated(spark, tmp_path):
    good, bad = parse_with_budget(spark, spoiled_files(tmp_path, 100), SCHEMA)
    assert good.count() == 400 and bad.count() == 100
    assert bad.columns == ["raw", "file"] and bad.first().raw.startswith("x")


def test_one_more_leaves_the_table_alone(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS loaded_sites")
    load_table(spark, spoiled_files(tmp_path, 3), SCHEMA, "loaded_sites")
    assert spark.table("loaded_sites").count() == 400
    write(tmp_path / "part-9.csv", "id,kw\n" + "y,1\n" * 98)
    with pytest.raises(TooManyBadRecords):
        load_table(spark, f"{tmp_path}/part-*.csv", SCHEMA, "loaded_sites")
    assert spark.table("loaded_sites").count() == 400
    bad = load_table(spark, f"{tmp_path}/part-9.csv", SCHEMA, "loaded_sites", budget=98)
    assert spark.table("loaded_sites").count() == 0 and bad.count() == 98


def test_a_load_that_fails_half_way_leaves_the_table(spark):
    spark.sql("DROP TABLE IF EXISTS replaced_sites")
    first = replace_table(spark.range(400), "replaced_sites")
    versions = Path(first.removeprefix("file:")).parent
    begun = spark.table("replaced_sites")
    spoiled = F.when(F.col("id") == 900, F.raise_error(F.lit("no such site"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="no such site"):
        replace_table(spark.range(0, 1000, 1, 8).select(spoiled.cast("long").alias("id")), "replaced_sites")
    assert spark.table("replaced_sites").count() == 400
    assert [path.name for path in versions.iterdir()] == [Path(first).name], "what was written is gone"

    replace_table(spark.range(7), "replaced_sites")
    assert spark.table("replaced_sites").count() == 7
    assert begun.count() == 400, "a reader keeps the version it began with"
    replace_table(spark.range(8), "replaced_sites")
    assert spark.table("replaced_sites").count() == 8
    assert len(list(versions.iterdir())) == 2


def test_a_table_may_be_replaced_from_itself_and_with_other_columns(spark):
    spark.sql("DROP TABLE IF EXISTS replaced_sites")
    replace_table(spark.range(5), "replaced_sites")
    replace_table(spark.table("replaced_sites").where("id > 1"), "replaced_sites")
    assert sorted(row.id for row in spark.table("replaced_sites").collect()) == [2, 3, 4]
    replace_table(spark.table("replaced_sites").selectExpr("id", "'x' AS name"), "replaced_sites")
    assert spark.table("replaced_sites").columns == ["id", "name"]


FAILING_TASK = """
import os, sys
from pyspark.sql import SparkSession, functions as F
from plugsites.sinks.stage import write_stage

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
folder = sys.argv[1]

def once(batches):
    for batch in batches:
        yield batch
    if not os.path.exists(folder + "/failed"):
        open(folder + "/failed", "w").close()
        raise RuntimeError("lost after all its rows were handed on")

rows = spark.range(0, 1000, 1, 4).mapInArrow(once, "id long")
print("FOUND", write_stage(rows, folder + "/stage", {"rows": F.count(F.lit(1)), "odd": F.count_if(F.expr("id % 2 = 1"))}))
"""


def test_metrics_are_exact_when_a_task_fails_once(tmp_path):
    command = [sys.executable, "-c", FAILING_TASK, str(tmp_path)]
    done = subprocess.run(command, capture_output=True, text=True, timeout=180, check=False)
    assert (tmp_path / "failed").exists(), done.stderr[-2000:]
    assert "FOUND {'rows': 1000, 'odd': 500}" in done.stdout
