"""The sharded model against the same model in plain dictionaries, and held-out labels."""

import math
from collections import Counter, defaultdict

import pytest

from plugsites.llm import quality
from plugsites.llm.quality import Discounts


def plain_model(texts):
    counts = [Counter() for _ in range(5)]
    for text in texts:
        padded = "\x01\x01\x01" + text
        counts[4].update(padded[i : i + 4] for i in range(len(text)))
    for order in (3, 2, 1):
        counts[order].update(gram[1:] for gram in counts[order + 1])
    tables = {}
    for order in range(1, 5):
        n = Counter(counts[order].values())
        d = Discounts.of(n[1], n[2], n[3], n[4])
        cut = {1: d.one, 2: d.two}
        contexts = defaultdict(lambda: [0, 0.0])
        for gram, c in counts[order].items():
            contexts[gram[:-1]][0] += c
            contexts[gram[:-1]][1] += cut.get(c, d.more)
        tables[order] = (counts[order], cut, d.more, dict(contexts))

    def p(gram):
        order = len(gram)
        lower = p(gram[1:]) if order > 1 else 1 / (len(counts[1]) + 1)
        table, cut, more, contexts = tables[order]
        if gram[:-1] not in contexts:
            return lower
        total, freed = contexts[gram[:-1]]
        c = table.get(gram, 0)
        return (max(c - cut.get(c, more), 0) * (c > 0) + freed * lower) / total

    return lambda text: sum(math.log(p(("\x01\x01\x01" + text)[i : i + 4])) for i in range(len(text)))


def test_scores_equal_plain_model(spark):
    texts = {k: f"the cat {k % 5} sat on the mat number {k}. " * (k % 4 + 1) for k in range(60)}
    texts |= {60: "", 61: None, 62: "ZZZ!! qqq", 63: "é 日本 🙂", 64: "the " * 3000}
    docs = spark.createDataFrame(
        [(k, t, "en" if k % 2 else None) for k, t in texts.items()],
        "doc_id long, text string, lang string",
    )
    trusted = spark.createDataFrame([(k,) for k in range(40)] + [(3,), (999,)], "doc_id long")
    score = plain_model([texts[k] for k in range(40)])
    rows = quality.score_documents(docs, trusted, block_chars=500).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = (texts[row.doc_id] or "").replace("🙂", chr(0xE000 + (0x1F642 & 0xFFF)))
        assert row.n_grams == len(text)
        assert row.log_prob == pytest.approx(score(text), rel=1e-9, abs=1e-9)


def test_probabilities_of_a_context_sum_to_one():
    score = plain_model(["abcabcabd", "abd", "cab"])
    alphabet = "abcd"
    total = sum(math.exp(score("ab" + x) - score("ab")) for x in alphabet)
    unknown = math.exp(score("abZ") - score("ab"))
    assert total + unknown == pytest.approx(1)


def test_defined_results_of_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, 0), (2, "", "en", 0), (None, "text without id", "en", 0), (4, "x", "en", 0)]
        + [(4, "x", "en", 0)],
        "doc_id long, text string, lang string, threshold int",
    )
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 5 and all(row.kept for row in rows)  # too few labels to reject anything
    assert {row.log_perplexity for row in rows if row.doc_id in (1, 2)} == {None}
    assert quality.classify(docs, labels.limit(0)).count() == 5
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_query_against_labels(spark, folder):
    from plugsites.llm.catalog import QUERIES

    found = QUERIES["op2_quality"](spark, folder)
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    shares = {
        row.quality: row.share
        for row in found.join(labels, "doc_id")
        .groupBy("quality")
        .agg({"*": "count"})
        .join(
            found.join(labels, "doc_id").where("kept").groupBy("quality").count(), "quality", "left"
        )
        .selectExpr("quality", "coalesce(`count`, 0) / `count(1)` as share")
        .collect()
    }
    assert shares[1] > 0.99
    assert shares.get(0, 0) < 0.15


def test_held_out_documents_are_judged_alike(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen = labels.where("pmod(xxhash64(doc_id), 2) = 0")
    unseen = labels.where("pmod(xxhash64(doc_id), 2) = 1")
    rows = quality.classify(docs, seen).join(unseen, "doc_id").select("kept", "quality").collect()
    good = [row.kept for row in rows if row.quality == 1]
    bad = [row.kept for row in rows if row.quality == 0]
    assert sum(good) / len(good) > 0.97
    assert sum(bad) / len(bad) < 0.4  # from 85 trusted documents in four languages


def test_limits_of_few_documents_are_drawn_to_wider_groups(spark):
    rows = [("en", 3, 1 + n / 1000) for n in range(500)] + [("xx", 3, 3.0)] * 5 + [("xx", 1, 2.0)]
    good = spark.createDataFrame(rows, "lang string, class int, log_ppl double")
    limits, common = quality._shrunk_limits(good)
    found = {(r.lang, r["class"]): r.upper for r in limits.collect()}
    raw = {tuple(r)[:2]: r.upper for r in quality._limits(good, ["lang", "class"]).collect()}
    assert found[("xx", 3)] == pytest.approx((5 * raw[("xx", 3)] + 30 * common[3]) / 35)
    assert common[3] < found[("xx", 3)] < raw[("xx", 3)] and set(common) == {0, 1, 2, 3}
    assert abs(found[("en", 3)] - raw[("en", 3)]) < 0.1 * abs(common[3] - raw[("en", 3)]) + 1e-9
    empty, none = quality._shrunk_limits(good.limit(0))
    assert empty.count() == 0 and none == {}
