"""Language identification: automata against substring search, held-out accuracy."""

import random
import zlib

from pyspark.sql import functions as F

from plugsites.llm.catalog import QUERIES
from plugsites.llm.languages import (
    SuffixAutomaton,
    count_phrases,
    learn_languages,
    linked_states,
    predict_languages,
    prepared,
)

import numpy as np


def linked(text):
    moves = SuffixAutomaton(text).moves
    edges = [(n, c, to) for n, out in enumerate(moves) for c, to in out.items()]
    s, c, t = zip(*edges) if edges else ((), "", ())
    return linked_states(len(moves), np.array(s, int), "".join(c), np.array(t, int))


def phrases_by_search(text, known):
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in known:
            size += 1
        at += size
        n += 1
    return n


def test_phrases_equal_substring_search():
    draw = random.Random(3)
    for _ in range(200):
        known = "".join(draw.choices("abcé ", k=draw.randrange(60)))
        text = "".join(draw.choices("abcdé ", k=draw.randrange(80)))
        assert count_phrases(text, linked(known)) == phrases_by_search(text, known)


def test_prepared_keeps_letters_only():
    assert prepared("Été 2024: l'Eau_vive!\n") == "été l eau vive "


def test_held_out_accuracy_and_shape(spark, folder):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_language"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


TAUGHT = [(n, "the house and the garden of the king", "en") for n in range(50)]
TAUGHT += [(n, "das haus und der garten des königs", "de") for n in range(3)]


def run(spark, taught, texts):
    automata = learn_languages(spark.createDataFrame(taught, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(*t, "x", 0.5) for t in texts], "doc_id long, text string, best_lang string, score double")
    found = predict_languages(asked, automata, carry={"mine": F.col("best_lang")})
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_awkward_texts(spark):
    texts = [(1, None), (2, ""), (3, "123 !?"), (None, "the king"), (4, "der könig"), (4, "der könig")]
    texts += [(5, "the garden " * 100_000)]
    found = {(r[0], r[2]) for r in run(spark, TAUGHT, texts)}
    assert found == {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (4, "de"), (5, "en")}
    assert len(run(spark, TAUGHT, texts)) == len(texts)


def test_rows_that_teach_nothing_and_empty_tables(spark):
    nothing = [(1, None, "en"), (2, "...", "de"), (3, "words", None)]
    assert [r[2:] for r in run(spark, nothing, [(1, "words")])] == [("und", 0.0)]
    assert run(spark, TAUGHT, []) == []


def test_one_language_has_score_one_and_ties_go_to_the_first(spark):
    assert run(spark, [(1, "abc", "xx")], [(1, "abc")]) == [(1, "x", "xx", 1.0)]
    tie = [(1, "abc", "yy"), (1, "abc", "xx")]
    assert run(spark, tie, [(1, "abc")]) == [(1, "x", "xx", 0.0)]


def test_languages_in_rounds(spark, monkeypatch):
    whole = run(spark, TAUGHT, [(1, "the garten"), (2, "der king")])
    monkeypatch.setattr("plugsites.llm.languages.ROUND_LANGUAGES", 1)
    assert run(spark, TAUGHT, [(1, "the garten"), (2, "der king")]) == whole
