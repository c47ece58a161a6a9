"""Registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugsites.llm import chat, fingerprints, kd_search, languages, merkle, near_duplicates
from plugsites.llm import oracle_sql, packing, pii, quality, signatures, token_counts, token_files, tree_bpe
from plugsites.llm.pii_rules import KINDS
from plugsites.llm.frames import table
from plugsites.llm.vocabularies import default_path
from plugsites.sinks.stage import shared_folder


#: A conversation whose texts are control strings of a chat template.
CONTROL_CONVERSATION = [
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = pii.train_field(pii.labelled_chains(docs))
    found = pii.find_personal_data(docs, field)
    return found.select(
        "doc_id",
        *(pii.count_of("base", kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(pii.joined("base"), 256).alias("base_sha256"),
        pii.joined("spans").alias("spans"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), default_path("word_bpe_49k.json"), capacity=2048
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates.near_duplicates(docs, words=3, percent=85)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "conv_id long, turn long, role string, text string"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(CONTROL_CONVERSATION, columns))
    body = F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    records = rows.select(
        F.col("conv_id").alias("key"),
        F.col("turn").alias("position"),
        F.to_json(body).alias("record"),
    )
    return chat.read_back(chat.formatted_turns(chat.turns_of(records)))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tree_bpe.encode_and_decode(
        table(spark, sf_dir, "documents"),
        default_path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), limit=512
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, path, default_path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path)


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = kd_search.quantised(table(spark, sf_dir, "embeddings"), scale=64)
    return kd_search.exact_top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = signatures.build_index(table(spark, sf_dir, "documents"))
    return signatures.ranked_search(index, table(spark, sf_dir, "benchmark"), k=10)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(table(spark, sf_dir, "documents"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    held_out = F.coalesce(fold == 2, F.lit(False))
    automata = languages.learn_languages(docs.where(~held_out))
    return languages.predict_languages(docs, automata, carry={"held_out": held_out})


QUERIES = {
    "op1_personal_data": op1_personal_data,
    "op2_quality": op2_quality,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_chat_format": op5_chat_format,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_fingerprints": op8_fingerprints,
    "op9_token_files": op9_token_files,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_ranked_search": op11_ranked_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_language": op13_language,
}
ORACLE_SQL = {
    "op5_chat_format": oracle_sql.CHAT_FORMAT,
    "op10_exact_top_k": """
with quantised as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_inner_product(q.v, c.v) as bigint) as score
  from quantised q join quantised c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 20 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
  from scored
) where rank <= 20
""",
    "op11_ranked_search": oracle_sql.RANKED_SEARCH,
    "op12_merkle_manifest": oracle_sql.MERKLE,
}
