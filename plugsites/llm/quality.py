"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model counts characters in contexts of up to three, over all trusted texts. Neither
its counts nor the probabilities are ever in one place: they are tables that grow with
the corpus, sharded by n-gram. Documents are dealt into blocks; a block asks for each of
its distinct n-grams once, the answers are joined from the sharded counts, order by order,
and return to the block, where every character of every text is scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plugsites.llm.char_grams import ORDER, UNIT, GramCounts, gram_keys
from plugsites.llm.frames import of_checked_size, release_memory, staged

#: Characters in a block of documents.
BLOCK_CHARS = 24_000_000
#: Documents are compared with trusted ones of their language and about their length.
LENGTH_CLASSES = (60, 200, 1000)
#: A document is rejected above this quantile of the trusted documents' log perplexity,
#: widened by a share of its distance from their median.
QUANTILE, WIDENING = 0.99, 0.5
LEAST_DISCOUNT = 0.05
#: One in so many trusted documents is not counted, and sets the thresholds instead: the
#: model knows the texts it is made from too well to judge others by them.
HELD_OUT = 3
#: A threshold from n held-out documents counts n / (n + PRIOR), the rest is that of the
#: wider group: a language's class in its length class, this one in all.
PRIOR = 30
#: Log perplexities are told apart in steps of this size.
STEP = 0.001
#: Characters scored at once within a block.
PORTION = 500_000

GRAMS = "block int, key long, trusted long"
SCORES = "doc_id long, lang string, n_grams long, log_prob double"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files of writes in here, which hold all texts, are deleted as they end."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def _dealt(docs: DataFrame, blocks: int) -> DataFrame:
    key = F.coalesce(F.xxhash64("doc_id"), F.xxhash64("text"))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(key)
    return docs.withColumn("block", F.pmod(key, F.lit(blocks)).cast("int"))


def _counted(docs: DataFrame, trusted: DataFrame, blocks: int) -> DataFrame:
    """Distinct n-grams of each block, with their number in its trusted documents."""
    marks = trusted.select("doc_id", F.lit("").alias("text"), F.lit(True).alias("mark"))
    rows = docs.select("doc_id", "text", F.lit(False).alias("mark")).unionByName(marks)
    dealt = _dealt(rows, blocks).repartition(blocks, "block")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended() -> pa.RecordBatch:
            keys, counts = grams.total()
            columns = [np.full(len(keys), block, np.int32), keys.view(np.int64), counts]
            return pa.RecordBatch.from_arrays(
                [pa.array(column) for column in columns], ["block", "key", "trusted"]
            )

        block, grams, marked = None, GramCounts(), set()
        for batch in batches:
            names = ("block", "mark", "doc_id", "text")
            for at, mark, key, text in zip(*(batch.column(name).to_pylist() for name in names)):
                if at != block:
                    if block is not None:
                        yield ended()
                    block, grams, marked = at, GramCounts(), set()
                if mark:
                    marked.add(key)
                elif text:
                    grams.add(gram_keys(text), key in marked)
        if block is not None:
            yield ended()
        release_memory()

    ordered = dealt.sortWithinPartitions("block", F.desc("mark"))
    return ordered.select("block", "mark", "doc_id", "text").mapInArrow(count, GRAMS)


def _low_bits(key: Column, units: int) -> Column:
    return key.bitwiseAND(F.lit((1 << (UNIT * units)) - 1).cast("long"))


def _model(grams: DataFrame) -> DataFrame:
    """(order, key, c): counts of the highest order, continuation counts of the others."""
    counts = grams.where("trusted > 0").groupBy("key").agg(F.sum("trusted").alias("c"))
    levels = [counts.select(F.lit(ORDER).alias("order"), "key", "c")]
    for order in range(ORDER - 1, 0, -1):
        shorter = _low_bits(F.col("key"), order).alias("key")
        counts = counts.select(shorter).groupBy("key").agg(F.count("*").alias("c"))
        levels.append(counts.select(F.lit(order).alias("order"), "key", "c"))
    model = levels[0]
    for level in levels[1:]:
        model = model.unionByName(level)
    return model


@dataclass(frozen=True)
class Discounts:
    """One order's absolute discounts for counts of 1, 2, and 3 or more."""

    one: float = 0.0
    two: float = 0.0
    more: float = 0.0

    @staticmethod
    def of(n1: int, n2: int, n3: int, n4: int) -> Discounts:
        """Estimates from how many n-grams occur once to four times.

        Never 0, even where a small corpus gives no estimate: some probability is always
        left for what was not seen.
        """
        share = n1 / (n1 + 2 * n2) if n1 else 0.0
        pairs = ((1, n1, n2), (2, n2, n3), (3, n3, n4))
        values = (k - (k + 1) * share * b / a if a else 0.0 for k, a, b in pairs)
        return Discounts(*(min(max(v, LEAST_DISCOUNT), k) for k, v in enumerate(values, 1)))

    def column(self, c: Column) -> Column:
        return F.when(c == 1, self.one).when(c == 2, self.two).otherwise(self.more)


def _probabilities(grams: DataFrame, model: DataFrame) -> DataFrame:
    """(key, log_p) of every distinct n-gram that any block asks for."""
    c = F.col("c")
    stats = model.groupBy("order").agg(
        *(F.sum((c == n).cast("long")).alias(f"n{n}") for n in (1, 2, 3, 4)),
        F.sum("c").alias("total"),
        F.count("*").alias("types"),
    )
    by_order = {row["order"]: row for row in stats.collect()}  # a row per order
    discounts = {
        order: Discounts.of(row.n1, row.n2, row.n3, row.n4) for order, row in by_order.items()
    }
    asked = {ORDER: grams.select("key").distinct()}
    for order in range(ORDER - 1, 0, -1):
        shorter = _low_bits(F.col("key"), order).alias("key")
        asked[order] = asked[order + 1].select(shorter).distinct()
    if not by_order:
        return asked[ORDER].select("key", F.lit(0.0).alias("log_p"))

    row, d = by_order[1], discounts[1]
    freed = d.one * row.n1 + d.two * row.n2 + d.more * (row.types - row.n1 - row.n2)
    seen = F.coalesce(F.greatest(c - d.column(c), F.lit(0.0)), F.lit(0.0))
    lowest = (seen + F.lit(freed / (row.types + 1))) / F.lit(float(row.total))
    p = asked[1].join(model.where("order = 1"), "key", "left").select("key", lowest.alias("p"))
    for order in range(2, ORDER + 1):
        d, level = discounts[order], model.where(F.col("order") == order).select("key", "c")
        context = F.shiftrightunsigned("key", UNIT).alias("context")
        contexts = level.groupBy(context).agg(
            F.sum("c").alias("total"), F.sum(d.column(c)).alias("freed")
        )
        lower = p.select(F.col("key").alias("low"), F.col("p").alias("below"))
        joined = (
            asked[order]
            .select("key", context, _low_bits(F.col("key"), order - 1).alias("low"))
            .join(level, "key", "left")
            .join(contexts, "context", "left")
            .join(lower, "low")
        )
        seen = F.coalesce(F.greatest(c - d.column(c), F.lit(0.0)), F.lit(0.0))
        mixed = (seen + F.col("freed") * F.col("below")) / F.col("total")
        p = joined.select("key", F.coalesce(mixed, "below").alias("p"))
    return p.select("key", F.ln("p").alias("log_p"))


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums over all characters of each text of one block.

    The block stays in Arrow; only a portion of its texts is in Python at a time.
    """
    keys = answers.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, values = keys[order], answers.column("log_p").to_numpy()[order]
    del order
    texts = docs.column("text")
    sizes = pc.utf8_length(texts).to_numpy().astype(np.int64)
    sums = np.zeros(len(sizes))
    first = 0
    while first < len(sizes):
        last, held = first, 0
        while last < len(sizes) and (last == first or held + sizes[last] <= PORTION):
            held += sizes[last]
            last += 1
        if held:
            portion = texts.slice(first, last - first).to_pylist()
            grams = np.concatenate([gram_keys(text) for text in portion])
            scores = values[np.searchsorted(keys, grams)]
            some = np.flatnonzero(sizes[first:last])
            starts = (np.cumsum(sizes[first:last]) - sizes[first:last])[some]
            sums[first + some] = np.add.reduceat(scores, starts)
        first = last
    release_memory()
    columns = [docs.column("doc_id"), docs.column("lang"), pa.array(sizes), pa.array(sums)]
    return pa.table(columns, names=["doc_id", "lang", "n_grams", "log_prob"])


def score_documents(
    docs: DataFrame, trusted: DataFrame, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, lang, n_grams, log_prob) per row of docs (doc_id, text, lang).

    ``trusted`` (doc_id) names the documents whose texts the model is made from. Without
    any, every character has log probability 0. Null texts are empty.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("lang", F.lit("")).alias("lang"),
    )
    trusted = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    chars = texts.agg(F.sum(F.length("text"))).head()[0] or 0
    blocks = max(1, math.ceil(chars / block_chars))
    with _shuffles_dropped(spark):
        grams = staged(_counted(texts, trusted, blocks), "grams")
        model = staged(_model(grams), "model")
        answers = grams.select("block", "key").join(_probabilities(grams, model), "key")
        dealt = _dealt(texts, blocks).repartition(blocks, "block")
        pairs = dealt.groupBy("block").cogroup(answers.groupBy("block"))
        return staged(pairs.applyInArrow(_score, SCORES), "scores")


def _length_class() -> Column:
    return sum(((F.col("n_grams") >= n).cast("int") for n in LENGTH_CLASSES), F.lit(0))


def _limits(scored: DataFrame, groups: list[str]) -> DataFrame:
    """Upper limit of log perplexity per group, from exact counts of its steps."""
    steps = scored.groupBy(*groups, F.round(F.col("log_ppl") / STEP).cast("long").alias("step"))
    steps = steps.agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*groups)
    up_to = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    ranked = steps.select(
        *groups, "step", F.sum("n").over(up_to).alias("below"), F.sum("n").over(whole).alias("all")
    )

    def quantile(share: float) -> Column:
        return F.min(F.when(F.col("below") >= share * F.col("all"), F.col("step"))) * STEP

    return ranked.groupBy(*groups).agg(
        F.max("all").alias("n"),
        (quantile(QUANTILE) + WIDENING * (quantile(QUANTILE) - quantile(0.5))).alias("upper"),
    )


def _shrunk_limits(good: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """Limits by language and length class, and by length class alone, for any of them."""
    rows = {row["class"]: row for row in _limits(good, ["class"]).collect()}  # a few classes
    all_ = _limits(good.withColumn("corpus", F.lit(0)), ["corpus"]).first()
    common = {}
    if all_ is not None:
        for one in range(len(LENGTH_CLASSES) + 1):
            n, upper = (rows[one]["n"], rows[one]["upper"]) if one in rows else (0, 0.0)
            common[one] = (n * upper + PRIOR * all_["upper"]) / (n + PRIOR)
    wider = F.coalesce(*[F.when(F.col("class") == one, upper) for one, upper in common.items()], F.lit(None).cast("double"))
    upper = (F.col("n") * F.col("upper") + PRIOR * wider) / (F.col("n") + PRIOR)
    return _limits(good, ["lang", "class"]).select("lang", "class", upper.alias("upper")), common


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per input row: doc_id, lang, n_grams, log_perplexity, threshold, kept.

    ``labels`` (doc_id, quality) names trusted texts: those with quality 1. Two thirds of
    them make the model, one third the thresholds. A document's threshold is that of its
    language among documents of about its length, drawn to that of this length in all
    languages, and this to that of all, the more the fewer documents set it (``PRIOR``).
    Without any held-out document there is no threshold, and everything is kept.

    A null or empty text has a null perplexity and is kept: nothing speaks against it. A
    null language is one of its own (an empty string). Rows without an id are scored and
    never trusted; repeated rows count each time. An empty table gives no rows.
    """
    texts = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
        F.col(lang_column).alias("lang"),
    )
    trusted = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    per_char = F.when(F.col("n_grams") > 0, -F.col("log_prob") / F.col("n_grams"))
    held_out = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(HELD_OUT)) == 0
    scored = score_documents(texts, trusted.where(~held_out), block_chars).select(
        "doc_id", "lang", "n_grams", per_char.alias("log_ppl"), _length_class().alias("class")
    )
    good = scored.where("log_ppl is not null").join(trusted.where(held_out), "doc_id")
    limits, common = _shrunk_limits(good)
    limited = scored.join(of_checked_size(limits), ["lang", "class"], "left")
    wider = [F.when(F.col("class") == one, upper) for one, upper in common.items()]
    limit = F.coalesce("upper", *wider)
    return limited.select(
        "doc_id",
        "lang",
        "n_grams",
        F.col("log_ppl").alias("log_perplexity"),
        limit.alias("threshold"),
        F.coalesce(F.col("log_ppl") <= limit, F.lit(True)).alias("kept"),
    )
