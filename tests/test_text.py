import datetime as dt

import pytest
from pyspark.sql import functions as F

from plugsites.functions.plugs import pack, plausible_powers, plug_label, plug_text, powers_text
from plugsites.functions.text import (
    TextRule,
    clean_all_text,
    clean_text,
    coordinate_part,
    decimal_comma,
    is_missing,
    parse_date,
    postal_code,
    whole_number,
)
from plugsites.operators.missing import fill_count, fill_text, known
from plugsites.schema import PLUG_LABELS


def evaluate(spark, function, inputs):
    """Apply a column function to texts; results in input order."""
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, v string")
    result = rows.select("i", function(F.col("v")).alias("r")).collect()
    return [row.r for row in sorted(result, key=lambda row: row.i)]


@pytest.mark.parametrize(
    "function, cases",
    [
        (decimal_comma, {"52,5200": 52.52, "52.5": 52.5, " 7 ": 7.0, "k. A.": None, "": None, None: None, "1,2,3": None}),
        (whole_number, {"7": 7, " 7\n": 7, "-3": -3, "2.9": 2, "2.": 2, "1e3": None, "D-1": None, "": None, "99999999999": None}),
        (
            parse_date,
            {
                "2020-02-01": dt.date(2020, 2, 1),
                "2020-02-01T12:00:00Z": dt.date(2020, 2, 1),
                "2020-02-01 12:00": dt.date(2020, 2, 1),
                "01.02.2020": dt.date(2020, 2, 1),
                " 01.02.2020\n": dt.date(2020, 2, 1),
                "2020-02-30": None,
                "1.2.2020": None,
                "2020": None,
                "2020-02-011": None,
                None: None,
            },
        ),
        (lambda c: postal_code(c, True), {"01067": "01067", "1067": "01067", "D-1": None, "123456": "123456", "": None}),
        (lambda c: postal_code(c, False), {"1067": "01067", "D-1": "D-1", "55116": "55116"}),
        (lambda c: coordinate_part(c, 1), {"50.1, 8.2": 8.2, "50.1": None, "50.1,": None, "a, b": None}),
        (is_missing, {"N.A": True, "UNKNOWN": True, "UNKOWN": True, "": True, None: True, "n.a": False, " ": False}),
        (fill_text, {"N.A": "UNKNOWN", None: "UNKNOWN", "Hessen": "Hessen"}),
        (lambda c: fill_text(c, F.lit("B")), {"UNKOWN": "B", "Hessen": "Hessen"}),
        (fill_count, {None: 1, "": 1, "N.A": 1, "viele": None, "0": 0, "3": 3}),
        (lambda c: fill_count(c, True), {None: 1, "viele": 1, "0": 0}),
        (known, {"UNKNOWN": None, "": None, "Hessen": "Hessen"}),
        (plug_label, {"CHAdeMO": "CHAdeMO (DC)", "chademo": "chademo", " CHAdeMO": " CHAdeMO", None: None}),
        (
            plug_text,
            {
                "CHAdeMO; DC CHAdeMO ;X": "CHAdeMO (DC); X",
                " ;;\t": "",
                "": "",
                None: "",
                "X;CCS (Type 2);X": "X; CCS Combo 2 (DC)",
            },
        ),
        (lambda c: clean_text(c, TextRule(" ")), {"a\nb": "a b", "a\\\\ \\b": "a b", "a \t\n b": "a b", None: None}),
        (lambda c: clean_text(c, TextRule("")), {"a\nb": "ab", "a \n b": "a b", "\\": " "}),
        (lambda c: clean_text(c, TextRule("", False)), {"a\nb": "ab", "a  b\\": "a  b\\"}),
    ],
)
def test_column_function(spark, function, cases):
    assert evaluate(spark, function, list(cases)) == list(cases.values())


def test_no_common_label_is_a_known_label():
    assert not set(PLUG_LABELS) & set(PLUG_LABELS.values())


def test_powers_keep_the_open_range(spark):
    rows = spark.createDataFrame([("22,5", "1", "1000"), ("1.01", None, "999,9"), ("x", "22", "NaN")], "a string, b string, c string")
    result = rows.select(powers_text(plausible_powers(pack(["a", "b", "c"])))).collect()
    assert [row[0] for row in result] == ["22.5", "1.01,999.9", "22"]


def test_packing_nothing_is_an_empty_list(spark):
    assert spark.range(1).select(pack([])).first()[0] == []


def test_cleaning_is_idempotent_and_spares_other_types(spark):
    rows = spark.createDataFrame([(1, "a \n\\ b", ["x\ny"])], "n int, t string, l array<string>")
    once = clean_all_text(rows, TextRule(" "))
    assert once.collect() == clean_all_text(once, TextRule(" ")).collect()
    assert once.first().asDict() == {"n": 1, "t": "a b", "l": ["x y"]}
