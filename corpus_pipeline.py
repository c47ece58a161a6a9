"""Corpus pipeline: quality filter, near-dedup, masking of personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet below the shared folder and reads it again for the next one. All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plugsites.llm import near_duplicates, packing, pii, quality
from plugsites.llm.frames import staged, table
from plugsites.llm.vocabularies import default_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near-duplicates: shingles of so many words, of at least this similarity in percent.
SHINGLE_WORDS, PERCENT = 5, 80
#: Packing: tokens in a sequence.
CAPACITY = 2048


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is not among ``ids``; rows without an id stay."""
    return docs.join(ids, "doc_id", "left_anti").select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    judged = quality.classify(docs, table(spark, sf_dir, "labels"))
    return _without(docs, judged.where(~F.col("kept")).select("doc_id").distinct())


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id; of repeated rows, one."""
    grouped = near_duplicates.near_duplicates(docs, SHINGLE_WORDS, PERCENT)
    left = _without(docs, grouped.where(~F.col("kept")).select("doc_id").distinct())
    # Ids tell which rows are repeated; no other row is moved.
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    twice = staged(ids.where("n > 1").select("doc_id"), "repeated-ids")
    if twice.isEmpty():
        return left
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("text")))
    once = left.join(twice, "doc_id", "left_semi").withColumn("turn", turn).where("turn = 1")
    return once.select(*COLUMNS).unionByName(_without(left, twice))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows."""
    field = pii.train_field(pii.labelled_chains(docs))
    return pii.mask_documents(docs.select(*COLUMNS), field)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, packed into sequences."""
    return packing.pack_documents(docs, default_path("word_bpe_49k.json"), CAPACITY)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("PII", personal_data_stage),
    ("best-fit packing", packing_stage),
]
#: Neither perplexities, chain fields nor vocabularies can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
