"""Near-duplicates against all pairs, on real rows and on awkward groups."""

import random
import re

import numpy as np
import pytest

from plugsites.llm import near_duplicates as nd
from plugsites.llm.components import UnionFind, connected_components
from plugsites.llm.shingles import shingle_sets
from plugsites.llm.super_minhash import signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text, words):
    found = WORD.findall((text or "").translate(UPPER))
    if 0 < len(found) < words:
        return {tuple(found)}
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def brute_force(rows, words, percent):
    sets = {}
    for key, text in rows:
        sets.setdefault(key, []).append(shingles(text, words))
    groups = UnionFind()
    keys = sorted(sets)
    for i, a in enumerate(keys):
        groups.find(a)
        for b in keys[:i]:
            for x in sets[a]:
                for y in sets[b]:
                    common = len(x & y)
                    if common and 100 * common >= percent * (len(x) + len(y) - common):
                        groups.union(a, b)
    return sorted(
        (key, len(shingles(text, words)), groups.find(key), groups.find(key) == key)
        for key, text in rows
    )


def run(spark, rows, words, percent):
    docs = spark.createDataFrame(
        [(k, t, "x", 0) for k, t in rows], "doc_id long, text string, key string, component_id int"
    )
    found = nd.near_duplicates(docs, words, percent).collect()
    return sorted(tuple(row) for row in found)


def words_of(draw, n):
    return [f"w{draw.randrange(10_000)}" for _ in range(n)]


def edited(draw, base, edits):
    out = list(base)
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"e{draw.randrange(10**9)}"
    return " ".join(out)


def awkward_rows():
    draw = random.Random(3)
    base = words_of(draw, 120)
    rows = [(k, edited(draw, base, draw.randrange(0, 6))) for k in range(100, 160)]
    passage = " ".join(words_of(draw, 60))
    rows += [(k, passage + " " + " ".join(words_of(draw, 40))) for k in range(200, 240)]
    rows += [(k, "Same text HERE") for k in range(300, 330)]
    rows += [(1, ""), (2, None), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "É é x")]
    rows += [(8, "word " * 5000), (9, "word\n" * 4000), (150, rows[3][1]), (4, "one")]
    return rows


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_awkward_rows_equal_all_pairs(spark, words, percent, monkeypatch):
    monkeypatch.setattr(nd, "CENTRES", 2)
    monkeypatch.setattr(nd, "COMPARISONS", 10)
    rows = awkward_rows()
    assert run(spark, rows, words, percent) == brute_force(rows, words, percent)


def test_rows_without_an_id_are_kept_apart(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    rows = nd.near_duplicates(docs, 3, 85).collect()
    assert [tuple(row) for row in rows] == [(None, 1, None, True)] * 2
    assert nd.near_duplicates(docs.limit(0), 3, 85).count() == 0


def test_query_equals_all_pairs(spark, folder):
    from plugsites.llm.catalog import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op4_near_duplicates"](spark, folder).collect()
    assert sorted(tuple(row) for row in got) == brute_force(rows, 3, 85)


def test_shingle_sets_do_not_depend_on_slices(monkeypatch):
    from plugsites.llm import shingles as sh

    texts = ["a b c d", "", "x" * 500, "É b\x0bc  d e", "a b c d " * 50]
    whole = shingle_sets(texts, 3)
    monkeypatch.setattr(sh, "SLICE", 16)
    assert all((a == b).all() for a, b in zip(whole, shingle_sets(texts, 3)))
    assert [len(one) for one in whole] == [len(shingles(t, 3)) for t in texts]


def test_signatures_estimate_similarity_with_little_variance():
    draw = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        common = draw.integers(0, 2**63, 400, dtype=np.uint64)
        a = np.concatenate([common, draw.integers(0, 2**63, 100, dtype=np.uint64)])
        b = np.concatenate([common, draw.integers(0, 2**63, 100, dtype=np.uint64)])
        rows = signatures([a, b], 216)
        errors.append((rows[0] == rows[1]).mean() - 400 / 600)
    assert abs(np.mean(errors)) < 0.015
    assert np.std(errors) < (2 / 9 / 216) ** 0.5  # independent hashes' deviation


def test_components_of_chains_stars_and_rings(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1400)]
    edges += [(2000, 2001), (2001, 2002), (2002, 2000), (5, 5), (None, 3)]
    links = spark.createDataFrame(edges, "a long, b long").repartition(7)
    found = dict(tuple(row) for row in connected_components(links).collect())
    assert found == (
        {k: 0 for k in range(1, 301)} | {k: 1000 for k in range(1001, 1400)} | {2001: 2000, 2002: 2000}
    )
    assert connected_components(links.limit(0)).count() == 0
