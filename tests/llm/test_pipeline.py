"""The pipeline's stages against their operators, and planted cases through all of it."""

import random

import corpus_pipeline
from tests.llm.test_near_duplicates import brute_force
from tests.llm.test_packing import check_packing
from tests.llm.test_pii import plain_spans

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "MinHash near-dedup",
        "PII",
        "best-fit packing",
    ]


def test_dedup_keeps_one_of_each_group(spark):
    draw = random.Random(4)
    base = [f"w{draw.randrange(9999)}" for _ in range(80)]
    near = [*base]
    near[40] = "edited"
    rows = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(base)), (9, " ".join(base))]
    rows += [(1, "quite another text of some words"), (None, "no id"), (2, ""), (4, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], DOCUMENTS)
    kept = corpus_pipeline.near_dedup_stage(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "None"]


def test_stages_of_a_folder(spark, folder):
    docs = corpus_pipeline.table(spark, folder, "documents")
    good = corpus_pipeline.staged(corpus_pipeline.quality_stage(spark, docs, folder), "t")
    assert good.columns == corpus_pipeline.COLUMNS
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    clean = labels.where("quality = 1")
    assert good.join(clean, "doc_id").count() > 0.99 * docs.join(clean, "doc_id").count()
    once = corpus_pipeline.staged(corpus_pipeline.near_dedup_stage(spark, good, folder), "t")
    groups = brute_force([(r.doc_id, r.text) for r in good.collect()], 5, 80)
    assert sorted(r.doc_id for r in once.collect()) == [row[0] for row in groups if row[3]]
    masked = corpus_pipeline.staged(corpus_pipeline.personal_data_stage(spark, once, folder), "t")
    texts = {r.doc_id: r for r in masked.collect()}
    for row in once.collect():
        new = texts[row.doc_id]
        assert (new.lang, new.source) == (row.lang, row.source)
        assert not plain_spans(new.text) and new.n_chars == len(new.text)
        if not plain_spans(row.text) and "@" not in row.text and not any(map(str.isdigit, row.text)):
            assert new.text == row.text
    packed = corpus_pipeline.packing_stage(spark, masked, folder).collect()
    check_packing(packed, {k: r.text for k, r in texts.items()}, corpus_pipeline.CAPACITY)
