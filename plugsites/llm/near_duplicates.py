"""Near-duplicates by SuperMinHash: bands propose, full sets decide, stars group.

Texts with equal shingle sets are one class from the start, so a text of thousands of
copies is compared once. Classes that share a band key are candidates, but the pairs of a
key are not listed: each class is compared with the key's smallest. Where the classes of a
key are then of several components, they are asked for a second meeting, at one of their
rarest shingles, which any two linked sets share, early enough in both to leave room for
the rest of what they must share. There each is compared with the most
central class, and what is still apart with every class of another component, a bounded
number of centres a round. Nothing is capped: in the end any two classes that meet twice
are in one component or have been compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plugsites.llm.components import connected_components
from plugsites.llm.frames import id_and_text, portions, staged
from plugsites.llm.shingles import set_digest, shingle_sets
from plugsites.llm.super_minhash import band_keys, signatures

#: 36 bands of 6: a pair of similarity 0.85 shares no key with probability 4e-8, one of
#: 0.8 with 2e-5; pairs that share a passage alone seldom meet.
BANDS, BAND_ROWS = 36, 6
#: Texts are hashed in portions of about this many characters.
PORTION = 1_000_000
#: Centres of a key in one round: at least this many, more while comparisons stay few.
CENTRES, COMPARISONS = 64, 1_000_000
#: The classes of a key are ranked in so many parts first.
RANKED_APART = 64

SIGNED = "doc_id long, n_shingles long, d0 long, d1 long, bands array<long>"


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """Set sizes, digests (null for empty sets) and band keys of every text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in portions(batch, PORTION):
                sets = shingle_sets(texts, words)
                keys = band_keys(signatures(sets, BANDS * BAND_ROWS), BANDS).view("int64")
                digests = [set_digest(one) if len(one) else (None, None) for one in sets]
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array([len(one) for one in sets], pa.int64()),
                    pa.array([one for one, _ in digests], pa.int64()),
                    pa.array([one for _, one in digests], pa.int64()),
                    pa.array(list(keys), pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "n_shingles", "d0", "d1", "bands"]
                )

    return docs.mapInArrow(sign, SIGNED)


def _hashed_sets(docs: DataFrame, words: int) -> DataFrame:
    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in portions(batch, PORTION):
                sets = [one.view("int64") for one in shingle_sets(texts, words)]
                columns = [pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["rid", "hashes"])

    return docs.mapInArrow(hash_, "rid long, hashes array<long>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * |A and B| >= percent * |A or B|."""
    a = sets.select(F.col("rid").alias("a"), F.col("hashes").alias("left"))
    b = sets.select(F.col("rid").alias("b"), F.col("hashes").alias("right"))
    met = F.size(F.array_intersect("left", "right"))
    common = pairs.join(b, "b").join(a, "a").select(
        "a", "b", met.alias("met"), (F.size("left") + F.size("right")).alias("both")
    )
    return common.where(F.col("met") * (100 + percent) >= percent * F.col("both")).select("a", "b")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |A and B| >= percent * |A or B| for their sets of
    ``words``-word shingles; component_id is the smallest id reachable over links, kept
    tells whether that is the document itself. A text with fewer words is one shingle.

    A null or empty text, or one without words, has no shingles and is linked with nothing.
    A row without an id is linked with nothing either: its component is null, it is kept.
    Rows of one id are one document, linked by any of their texts. An empty table gives no
    rows.
    """
    texts = id_and_text(docs, id_column, text_column)
    signed = staged(_signed(texts, words), "signed")
    named = signed.where("doc_id is not null and d0 is not null")
    classes = staged(
        named.groupBy("d0", "d1").agg(F.min("doc_id").alias("rid"), F.count("*").alias("n")), "classes"
    )
    found = _components(texts, named, classes.drop("n"), words, percent)
    labels = classes.join(found, F.col("rid") == F.col("node"), "left").select(
        "d0",
        "d1",
        "n",
        F.coalesce("component", "rid").alias("component"),
        F.col("component").isNotNull().alias("linked"),
    )
    # A text without copies and links is its own component; only the others are looked up.
    labels = staged(labels.where("n > 1 OR linked"), "labels")
    labelled = _with_labels(named, labels).unionByName(
        signed.where("doc_id is null or d0 is null").withColumn("component", F.lit(None).cast("long"))
    )
    component = F.coalesce("component", "doc_id")
    return labelled.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"),
    )


def _with_labels(named: DataFrame, labels: DataFrame) -> DataFrame:
    """``named`` with the component of its class; a class with very many copies is dealt
    over as many tasks as a shuffle has."""
    key = ["d0", "d1"]
    salts = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Classes with more than a task's share of all copies: fewer than there are tasks.
    share = (labels.agg(F.sum("n")).first()[0] or 0) // salts
    hot = F.broadcast(labels.where(F.col("n") > share).select(*key, F.lit(salts - 1).alias("last")))
    last = F.coalesce("last", F.lit(0))
    salt = F.pmod(F.xxhash64("doc_id"), last + 1).cast("int")
    rows = named.join(hot, key, "left").withColumn("salt", salt).drop("last")
    every = F.explode(F.sequence(F.lit(0), last)).alias("salt")
    copies = labels.join(hot, key, "left").select(*key, "component", every)
    return rows.join(copies, [*key, "salt"], "left").select(*named.columns, "component")


def _close(one: str, other: str, percent: int) -> F.Column:
    """No link is possible between sets of too different sizes."""
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def _may_meet(place: str, n: str, other_place: str, other_n: str, percent: int) -> F.Column:
    """Whether two sets can be linked if the shingle at these places is their first common one.

    All they share then stands at these places or after, in either order of rarity.
    """
    left = F.least(F.col(n) - F.col(place), F.col(other_n) - F.col(other_place))
    return left * (100 + percent) >= percent * (F.col(n) + F.col(other_n))


def _parts(met: DataFrame, found: DataFrame) -> DataFrame:
    """``met`` with each class's component so far."""
    joined = met.join(found, F.col("rid") == F.col("node"), "left").drop("node")
    return joined.withColumn("part", F.coalesce("component", "rid")).drop("component")


def _still_apart(parts: DataFrame) -> DataFrame:
    """(key, main) of the keys whose classes are of several components, and the largest."""
    return (
        parts.groupBy("key", "part")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(F.max(F.struct("n", "part")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select("key", F.col("main.part").alias("main"))
    )


def _components(
    texts: DataFrame, named: DataFrame, classes: DataFrame, words: int, percent: int
) -> DataFrame:
    """(node, component) of the classes that are linked to another one."""
    smallest = classes.withColumnRenamed("rid", "doc_id")
    keys = named.join(smallest, ["d0", "d1", "doc_id"]).select(
        F.explode("bands").alias("key"), F.col("doc_id").alias("rid"), "n_shingles"
    )
    shared = (
        keys.groupBy("key")
        .agg(F.count("*").alias("size"), F.min(F.struct("rid", "n_shingles")).alias("head"))
        .where("size > 1")
    )
    met = staged(keys.join(shared, "key"), "buckets")
    ids = met.select("rid").distinct()
    wanted = texts.join(ids, texts["doc_id"] == ids["rid"], "left_semi")
    sets = staged(_hashed_sets(wanted, words), "sets")

    apart = F.col("rid") != F.col("head.rid")
    pairs = met.where(apart & _close("n_shingles", "head.n_shingles", percent))
    links = _linked(pairs.select(*_ordered("rid", "head.rid")).distinct(), sets, percent)
    found = connected_components(links)
    parts = _parts(met.select("key", "rid"), found)
    unsettled = staged(parts.join(_still_apart(parts), "key").select("rid").distinct(), "unsettled")
    if unsettled.isEmpty():
        return found
    return _settled(_rare_shingles(sets.join(unsettled, "rid"), percent), found, sets, percent)


def _rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(key, rid, n_shingles, place, size, head): the rarest shingles of sets that meet in one.

    Two sets that are linked share one of their rarest n * (100 - percent) / 100 + 1
    shingles, whatever the order of rarity, as long as all sets use the same one. Edits make
    shingles of their own, so far variants of a text meet hardly anyone here, and texts that
    share a common passage do not meet in it. ``head`` is the class whose shingles are the
    most frequent: of the variants of a text, the one nearest to all.
    """
    rows = sets.select("rid", F.explode("hashes").alias("key"))
    often = rows.groupBy("key").agg(F.count("*").alias("often"))
    of_set = Window.partitionBy("rid")
    ranked = rows.join(often, "key").select(
        "key",
        "rid",
        F.count("*").over(of_set).alias("n_shingles"),
        F.sum("often").over(of_set).alias("total"),
        (F.row_number().over(of_set.orderBy("often", "key")) - 1).alias("place"),
    )
    some = F.floor(F.col("n_shingles") * (100 - percent) / 100)
    rare = staged(ranked.where(F.col("place") <= some), "rare")
    nearest = F.struct(
        (F.col("total") / F.col("n_shingles")).alias("often"), "rid", "n_shingles", "place"
    )
    meeting = rare.groupBy("key").agg(
        F.count("*").alias("size"),
        F.min("n_shingles").alias("least"),
        F.max(nearest).alias("head"),
    )
    met = rare.drop("total").join(meeting.where("size > 1"), "key")
    # A row too late in its own order for even the smallest set here meets nobody.
    room = (F.col("n_shingles") - F.col("place")) * (100 + percent)
    return staged(met.where(room >= percent * (F.col("n_shingles") + F.col("least"))), "meetings")


def _settled(met: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Compare until every two classes that share a key are in one component or no link."""
    pairs = _parts(met, found).withColumnRenamed("part", "own")
    heads = found.withColumnRenamed("node", "head_node").withColumnRenamed("component", "other")
    pairs = pairs.join(heads, F.col("head.rid") == F.col("head_node"), "left").where(
        (F.col("own") != F.coalesce("other", "head.rid"))
        & _may_meet("place", "n_shingles", "head.place", "head.n_shingles", percent)
    )
    more = _linked(pairs.select(*_ordered("rid", "head.rid")).distinct(), sets, percent)
    done = None
    while True:
        stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = connected_components(stars.unionByName(more))
        parts = _parts(met.drop("head"), found)
        open_ = staged(parts.join(_still_apart(parts), "key"), "open")
        aside = open_.where("part <> main")
        if done is not None:
            aside = aside.join(done, ["key", "rid"], "left_anti")
        # The first of each key, found among the first of its parts.
        part = F.pmod(F.xxhash64("rid"), F.lit(RANKED_APART))
        early = F.row_number().over(Window.partitionBy("key", "deal").orderBy("rid"))
        turn = F.row_number().over(Window.partitionBy("key").orderBy("rid"))
        quota = F.greatest(F.lit(CENTRES), F.floor(F.lit(COMPARISONS) / F.col("size")))
        centres = staged(
            aside.withColumn("deal", part)
            .withColumn("early", early)
            .where(F.col("early") <= quota)
            .withColumn("turn", turn)
            .where(F.col("turn") <= quota)
            .select(
                "key",
                F.col("rid").alias("centre"),
                F.col("part").alias("own"),
                F.col("n_shingles").alias("n_centre"),
                F.col("place").alias("place_centre"),
            ),
            "centres",
        )
        if centres.isEmpty():
            return found
        across = open_.join(centres, "key").where(
            (F.col("part") != F.col("own"))
            & _may_meet("place", "n_shingles", "place_centre", "n_centre", percent)
        )
        pairs = across.select(*_ordered("rid", "centre")).distinct()
        more = staged(_linked(pairs, sets, percent), "links")
        now = centres.select("key", F.col("centre").alias("rid"))
        done = now if done is None else done.unionByName(now)
