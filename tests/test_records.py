"""Records of several lines, read in splits and read whole."""

import random
import re

import pytest
from pyspark.sql import functions as F

from plugsites.sources import delimited
from plugsites.sources.delimited import Layout, UnreadableInput, scan_delimited, unclosed_lines
from plugsites.sources.records import line_patterns, numbered_records, stage_lines

PIECES = ["a", "b c", "ä", ",", ";", '\\"', "\n", "\n\n", ",\n", '\\"\n', "x" * 40]


def generated(seed, records):
    """CSV text with all kinds of quoted values; also bare ones with stray quotes."""
    rng = random.Random(seed)
    rows = ["id,text,note"]
    for i in range(records):
        quoted = '"' + "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 6))) + '"'
        bare = rng.choice(["plain", 'pipe 5" wide', 'tube 3"', "", "two words"])
        rows.append(f"{i},{quoted},{bare}" if rng.random() < 0.5 else f"{i},{bare},{rng.choice(['', bare])}")
    return "\n".join(rows) + "\n"


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0"}
    previous = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in previous.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_splits_give_the_records_of_the_whole_file(spark, tmp_path, small_splits, seed):
    for part in range(2):
        (tmp_path / f"{part}.csv").write_text(generated(seed * 10 + part, 600))
    layout = Layout()
    options = layout.csv_options()
    whole = spark.read.options(**options).csv(str(tmp_path), header=True, multiLine=True)
    stitched = scan_delimited(spark, str(tmp_path), layout)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    expected = sorted(str(tuple(row)) for row in whole.collect())
    assert len(expected) == 1200
    assert sorted(str(tuple(row)) for row in stitched.collect()) == expected


def test_one_value_may_cover_whole_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(2000))
    (tmp_path / "1.csv").write_text(f'﻿id,text\n1,"{long}"\n2,"b"\n3,"\nc"\n')
    stitched = scan_delimited(spark, str(tmp_path), Layout())
    assert stitched.columns == ["id", "text"]
    assert sorted(tuple(row) for row in stitched.collect()) == [("1", long), ("2", "b"), ("3", "\nc")]


def test_windows_line_ends(spark, tmp_path):
    (tmp_path / "1.csv").write_bytes(b'id;text\r\n1;"a\r\nb"\r\n2;c\r\n')
    stitched = scan_delimited(spark, str(tmp_path), Layout(sep=";", records="quoted"))
    assert sorted(tuple(row) for row in stitched.collect()) == [("1", "a\nb"), ("2", "c")]


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        ("1,2", True, False),
        ("", True, False),
        ('1,"a, b",2', True, True),
        ('1,"a', False, False),
        ('b",2', True, True),
        ('",2', False, True),
        ('"', False, True),
        ('""', True, True),
        ('1,"say \\"hi\\"', False, False),
        ('5" pipe,2', True, False),
        ('1,"a","', False, False),
        ('"a";"b', False, False),
    ],
)
def test_how_a_line_ends(spark, line, outside, inside):
    begun_outside, begun_inside = line_patterns(",", '"', "\\")
    row = spark.createDataFrame([(line,)], "v string").select(
        F.col("v").rlike(begun_outside), F.col("v").rlike(begun_inside)
    ).first()
    assert tuple(row) == (outside, inside)


def test_long_values_do_not_exhaust_the_stack(spark, tmp_path):
    text = '\\"x' * 50000
    (tmp_path / "1.csv").write_text(f'id,text\n1,"{text}\n"\n')
    stitched = scan_delimited(spark, str(tmp_path), Layout())
    assert stitched.select(F.length("text")).first()[0] == len(re.sub(r"\\", "", text)) + 1


def test_texts_are_shuffled_once(spark, tmp_path):
    (tmp_path / "1.csv").write_text(generated(5, 50))
    stitched = numbered_records(stage_lines(spark, [str(tmp_path / "1.csv")], Layout(records="quoted")))
    stitched.collect()
    text = stitched._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("Initial Plan")]
    by_split = re.findall(r"- Exchange hashpartitioning\(file#\d+, split#\d+", final)
    assert len(by_split) == 2, "the texts, and the states alone for the summary"
    assert len(re.findall(r"- ReusedExchange \[[^]]*value#", final)) == 1
    assert "FileScan text" not in final


def test_many_headers_are_numbered_and_parsed_in_one_pass(spark, tmp_path, monkeypatch):
    (tmp_path / "1.csv").write_text('id,text,note\n1,"a\nb",x\n2,c\n')
    (tmp_path / "2.csv").write_text('note,ID,text\ny,3,"d\ne",too many\n')
    (tmp_path / "3.csv").write_text('text,id,extra,text\n"f\n",4,z,g\n')
    made = []
    monkeypatch.setattr(delimited, "numbered_records", lambda lines: made.append(numbered_records(lines)) or made[-1])
    stitched = scan_delimited(spark, str(tmp_path), Layout())
    rows = stitched.collect()
    assert stitched.columns == ["id", "text", "note", "text0", "extra", "text3"]
    assert sorted(map(tuple, rows)) == [
        ("1", "a\nb", "x", None, None, None),
        ("2", "c", None, None, None, None),
        ("3", "d\ne", "y", None, None, None),
        ("4", None, None, "f\n", "z", "g"),
    ]
    text = stitched._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("Initial Plan")]
    assert len(made) == 1 and "Window" not in text and "Union" not in text
    assert final.count("from_csv") == 1 and final.count("FileScan parquet") == 1


@pytest.mark.parametrize("records", ["auto", "quoted"])
def test_a_value_that_is_never_closed_spoils_its_own_line_only(spark, tmp_path, small_splits, records):
    before = "".join(f'{i},"a\n{i}",x\n' for i in range(50))
    after = "".join(f"{i},plain {i},y\n" for i in range(100, 3000))
    (tmp_path / "1.csv").write_text(f'id,text,note\n{before}77,"never closed,z\n{after}')
    (tmp_path / "2.csv").write_text('id,text,note\n5000,"b\nc",z\n')
    layout = Layout(records=records)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    rows = {row.id: row for row in scan_delimited(spark, str(tmp_path), layout).collect()}
    assert len(rows) == 50 + 1 + 2900 + 1
    assert rows["7"].text == "a\n7" and rows["5000"].text == "b\nc" and rows["2999"].text == "plain 2999"
    assert rows["77"].text.startswith("never closed") or rows["77"].text.startswith('"never closed')

    bad = unclosed_lines(spark, str(tmp_path), layout).collect()
    assert len(bad) == 2901 and {row.file.rsplit("/", 1)[-1] for row in bad} == {"1.csv"}
    assert max(len(row.raw) for row in bad) < 30, "line by line, never put together"


def test_a_header_that_is_never_closed(spark, tmp_path):
    (tmp_path / "1.csv").write_text('id,"text\n1,a\n2,b\n')
    assert len(unclosed_lines(spark, str(tmp_path), Layout()).collect()) == 3
    with pytest.raises(UnreadableInput):
        scan_delimited(spark, str(tmp_path), Layout())
