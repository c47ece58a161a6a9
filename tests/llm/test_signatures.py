"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest

from plugsites.llm import signatures
from plugsites.llm.catalog import ORACLE_SQL, QUERIES
from tests.oracle import connect, sorted_rows

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, k):
    counts = [(key, Counter(terms_of(text))) for key, text in docs]
    counts = [(key, c) for key, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    held = Counter(term for _, c in counts for term in c)
    out = []
    for item_id, text in {(i, t) for i, t in items if t is not None}:
        scored = []
        for key, c in counts:
            m = 25 + (75 * sum(c.values()) * n_docs) // total
            score = 0
            for term in terms_of(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[term] + 1)))
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0 and key is not None:
                scored.append((-score, key))
        out += [(item_id, n, key, -s) for n, (s, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, k=10, parts=3):
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item string, bits int")
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, doc_id int")
    index = signatures.build_index(table.repartition(parts))
    found = signatures.ranked_search(index, asked, k)
    return sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed, n):
    """Words of very different frequency, short and long documents."""
    draw = random.Random(seed)
    words = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(300)]
    weights = [1 / (1 + i) for i in range(300)]
    docs = [(i, ", ".join(draw.choices(words, weights, k=draw.choice([1, 5, 40, 400])))) for i in range(n)]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([1, 8, 30])))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_equals_scoring_every_document(spark, seed):
    docs, items = corpus(seed, 400)
    assert run(spark, docs, items) == by_hand(docs, items, 10)


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (3, "?!"), (None, "alpha beta"), (4, "Alpha alpha ALPHA"), (4, "alpha")]
    docs += [(10 + n, "gamma delta") for n in range(30)] + [(5, "epsilon " * 100_000 + "alpha Ünder ünder")]
    items = [(1, "alpha"), (2, "gamma delta gamma"), (3, None), (4, "..."), (5, "nowhere"), (6, "Ünder ünder")]
    items += [(1, "alpha"), (None, "epsilon beta")]
    assert run(spark, docs, items) == by_hand(docs, items, 10)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, None)], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []


def test_small_blocks_and_rounds(spark, monkeypatch):
    docs, items = corpus(9, 200)
    monkeypatch.setattr(signatures, "ROUND_BYTES", 300)
    assert run(spark, docs, items, k=4) == by_hand(docs, items, 4)


def test_bounds_exclude_documents_and_never_a_good_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    index = signatures.build_index(docs)
    texts = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    sums = index.selectExpr("sum(with_terms) AS n", "sum(total) AS total").first()
    search = signatures._Search(signatures._asked(index, texts, sums.n, sums.total), 10)
    for row in index.collect():
        search.block(row.asDict())
    assert search.scored < 0.3 * search.bounded


def test_query_equals_sql(spark, folder):
    found = QUERIES["op11_ranked_search"](spark, folder)
    expected = connect(folder).sql(ORACLE_SQL["op11_ranked_search"])
    rows = sorted_rows(found.collect(), found.columns)
    assert rows and rows == sorted_rows(expected.fetchall(), expected.columns)
