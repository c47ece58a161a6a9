"""Fingerprints: algebra of the multiset, order of the documents, likeness."""

import random
from hashlib import sha256

import numpy as np
import pytest

from plugsites.llm import fingerprints
from plugsites.llm.fingerprints import (
    Multiset,
    edited_text,
    fingerprint_documents,
    likeness,
    multisets,
    paragraphs,
)


def same(a, b):
    return a.strings() == b.strings()


def test_paragraphs_are_summed_in_any_order():
    a, b = multisets(["one\ntwo\nthree\ntwo", "two\nthree\ntwo\none"]).strings()
    assert a == b
    assert a != multisets(["one\ntwo\nthree"]).strings()[0]


def test_insertion_and_deletion():
    whole, less, one = (multisets([t]) for t in ("a\nb\nb\nc", "a\nb\nc", "b"))
    assert same(less + one, whole) and same(whole - one, less)
    assert same(multisets([""]), whole - whole)
    assert same(Multiset.read(whole.strings()), whole)


def test_likeness_follows_what_is_shared():
    draw = random.Random(1)
    lines = [f"line {k} {draw.random()}" for k in range(400)]
    full = multisets(["\n".join(lines[:200])] * 5)
    others = multisets(["\n".join(lines[k : k + 200]) for k in (0, 50, 100, 150, 200)])
    near = likeness(full, others)
    assert near[0] == 1
    assert np.allclose(near, [1, 0.75, 0.5, 0.25, 0], atol=0.25)
    assert list(likeness(multisets(["", "a"]), multisets(["", ""]))) == [1, 0]


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [text or "" for _, text in ordered]
    after = texts[1:] + texts[:1]
    out = []
    for (key, _), text, following in zip(ordered, texts, after):
        edited = edited_text(text, following)
        assert len(edited) == len(text) - len(text) // 2 + min(len(text) // 2, len(following))
        own, changed, other = (multisets([t]) for t in (text, edited, following))
        out.append(
            (
                key,
                len(text),
                sha256(edited.encode()).hexdigest(),
                own.strings()[0],
                changed.strings()[0],
                float(likeness(own, changed)[0]),
                float(likeness(own, other)[0]),
            )
        )
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("buckets", [1, 2, 5, 40])
def test_small_table(spark, buckets):
    rows = [(k * k - 50, "\n".join(f"p{k} {j}" for j in range(k))) for k in range(20)]
    rows += [(7, None), (8, ""), (None, "no id"), (None, "a"), (7, "again 7"), (7, "again 7")]
    rows += [(1000, "日本語 🙂 " * 3000)]
    docs = spark.createDataFrame(
        [(k, t, 0) for k, t in rows], "doc_id long, text string, bucket int"
    ).repartition(3)
    got = fingerprint_documents(docs, buckets=buckets).collect()
    assert order(got) == order(expected(rows))


def test_one_row_none_and_no_ids(spark):
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    row = fingerprint_documents(one).collect()[0]
    assert row.edited_sha256 == sha256(b"abab").hexdigest() and row.near_next == 1
    assert fingerprint_documents(one.limit(0)).count() == 0
    rows = [(None, "b"), (None, "a")]
    nameless = spark.createDataFrame(rows, "doc_id long, text string")
    assert order(fingerprint_documents(nameless, buckets=3).collect()) == order(expected(rows))


def test_paragraph_ends():
    assert paragraphs("a. b? c\n\nd.e") == ["a.", "b?", "c", "d.e"]


def test_query_over_all_documents(spark, folder):
    from plugsites.llm.catalog import QUERIES

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = QUERIES["op8_fingerprints"](spark, folder).collect()
    assert order(got) == order(expected([tuple(r) for r in docs.collect()]))


def test_ten_thousand_buckets_do_not_grow_the_plan(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    sizes = []
    for buckets in (10, 10_000):
        rows, n = fingerprints.with_next(docs, buckets)
        sizes.append(len(rows._jdf.queryExecution().analyzed().toString()))
        guests = rows.where("guest").select("bucket").distinct().count()
        assert guests == n > 0.9 * buckets
    assert abs(sizes[1] - sizes[0]) < 100
