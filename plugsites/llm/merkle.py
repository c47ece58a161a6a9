"""Merkle manifest of a table: lag and lead windows, level by level.

The rows of a group (a source, say) are the leaves of its tree, in the order of a key;
the trees' own roots are the leaves of one tree above them. Every ``FANOUT`` consecutive
nodes make a run. Within a run, lag and lead columns of fixed offsets, masked by a node's
slot and the run's length, are its siblings, and the row of the first child hashes them
all into the parent. Going up, each level is a table a sixteenth as large as the one
below; going down, a node's path to the root is its own siblings and its parent's path.

Work never gathers by group, only by run, so a group with a third of all rows is dealt as
evenly as any other. Places in a group come from a range partitioning and one count per
group and partition. The driver holds the root and the number of levels, nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plugsites.llm.frames import staged

FANOUT = 16
#: Row numbers within a task are the low bits of a monotonic id.
WITHIN_TASK = (1 << 33) - 1
#: Counts by tree and range are broadcast up to so many rows, of under 100 bytes and a key.
BROADCAST_ROWS = 100_000
PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A value as text that cannot be confused with its neighbours: length, colon, value."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(text.isNull(), "-").otherwise(sized)


def row_digest(*values: Column) -> Column:
    """SHA-256 of a row's values, null told apart from empty."""
    return F.sha2(F.concat(*map(field, values)), 256)


@dataclass(frozen=True)
class Manifest:
    rows: DataFrame
    """The given rows with ``digest`` (their leaf), ``subroot`` and ``path``: for each level
    up to the root, the digests of the siblings before and after, joined to two texts."""
    subroots: DataFrame
    """``group`` and ``subroot``, one row per tree."""
    root: str | None
    """None for an empty table."""


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(
        path, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256)
    )


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, from the leaf's level up, left to right."""
    texts = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(texts, ""), 256)


def _numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Adds ``place`` (from 0, by ``order``) within its ``tree`` and ``members``, the tree's
    size; returns the largest size too."""
    ranges = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    seated = staged(
        ranges.withColumns(
            {
                "range": F.spark_partition_id(),
                "seat": F.monotonically_increasing_id().bitwiseAND(F.lit(WITHIN_TASK)),
            }
        ),
        "manifest-order",
    )
    counts = seated.groupBy("tree", "range").agg(
        F.min("seat").alias("first"), F.count("*").alias("n")
    )
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    # At most one row for each range and one more for each tree.
    starts = staged(
        counts.select(
            "tree",
            "range",
            (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("n").over(tree).alias("members"),
        ),
        "manifest-starts",
    )
    measured = starts.agg(F.count("*").alias("n"), F.max("members").alias("most")).first()
    small = F.broadcast(starts) if measured["n"] <= BROADCAST_ROWS else starts
    placed = seated.join(small, ["tree", "range"])
    return (
        placed.withColumn("place", F.col("seat") + F.col("shift")).drop("range", "seat", "shift"),
        int(measured["most"] or 0),
    )


def _linked(nodes: DataFrame) -> DataFrame:
    """Adds ``run`` and the siblings ``before`` and ``after`` a node, each as one text."""
    nodes = nodes.withColumn("run", F.expr(f"place div {FANOUT}"))
    slot = F.col("place") - F.col("run") * FANOUT
    length = F.least(F.lit(FANOUT), F.col("members") - F.col("run") * FANOUT)
    run = Window.partitionBy("tree", "run").orderBy("place")
    lags = [
        F.when(slot >= k, F.lag("digest", k).over(run)) for k in range(FANOUT - 1, 0, -1)
    ]
    leads = [F.when(slot + k < length, F.lead("digest", k).over(run)) for k in range(1, FANOUT)]
    return nodes.withColumns({"before": F.concat_ws("", *lags), "after": F.concat_ws("", *leads)})


def _levels(leaves: DataFrame, most: int) -> list[DataFrame]:
    """``tree, place, members, digest`` of every level; a tree ends at its single node."""
    levels = [leaves]
    while most > 1:
        parents = (
            _linked(levels[-1].select("tree", "place", "members", "digest").where("members > 1"))
            .where(F.col("place") == F.col("run") * FANOUT)
            .select(
                "tree",
                F.col("run").alias("place"),
                F.expr(f"(members + {FANOUT - 1}) div {FANOUT}").alias("members"),
                F.sha2(F.concat("digest", "after"), 256).alias("digest"),
            )
        )
        levels.append(staged(parents, "manifest-level"))
        most = -(-most // FANOUT)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """``tree, digest`` of the trees' last nodes."""
    last = [nodes.where("members = 1").select("tree", "digest") for nodes in levels]
    out = last[0]
    for more in last[1:]:
        out = out.unionByName(more)
    return out


def _with_paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Leaves with ``subroot`` and ``path``; ``above`` has each tree's path beyond its root."""
    known = None
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth]
        ends = nodes.where("members = 1").withColumn("subroot", F.col("digest"))
        found = ends.join(above, "tree")
        if known is not None:
            parents = known.select("tree", F.col("place").alias("run"), "subroot", F.col("path").alias("rest"))
            step = F.array(F.struct("before", "after"))
            inner = (
                _linked(nodes.where("members > 1"))
                .join(parents, ["tree", "run"])
                .withColumn("path", F.concat(step, "rest"))
            )
            found = found.unionByName(inner.select(*found.columns))
        if depth:
            found = found.select("tree", "place", "subroot", "path")
            known = staged(found, "manifest-paths")
        else:
            known = found
    return known


def build_manifest(rows: DataFrame, group: Column, order: Column, digest: Column) -> Manifest:
    """Trees over the rows of each group, ordered by ``order``, and one tree over these.

    ``group`` is text (null is a group of its own, the first), ``order`` ascends with nulls
    first. Rows equal in both are ordered by digest; repeated rows are leaves of their own
    each. A group of one row is its own subroot, a table of one group has its subroot as
    root. Columns of ``rows`` are carried along under any name but those of ``Manifest``.
    An empty table has no rows and no root.
    """
    kept = list(rows.columns)
    carried = F.struct(*(F.col(f"`{name}`") for name in kept)) if kept else F.lit(None)
    # Texts are read and hashed here, once; the ranges are then cut from small rows.
    leaves = staged(
        rows.select(
            carried.alias("row"),
            F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("tree"),
            order.alias("key"),
            digest.alias("digest"),
            F.monotonically_increasing_id().alias("nth"),
        ),
        "manifest-leaves",
    )
    placed, most = _numbered(leaves, ["key", "digest", "nth"])
    levels = _levels(placed.drop("key", "nth"), most)

    subroots = staged(_roots(levels), "manifest-subroots")
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest")
    top_placed, top_most = _numbered(tops, ["key"])
    top_levels = _levels(top_placed, top_most)
    root = _roots(top_levels).first()
    no_path = subroots.sparkSession.createDataFrame([("", [])], f"tree string, path {PATH}")
    above = _with_paths(top_levels, no_path).select(F.col("key").alias("tree"), "path")

    found = _with_paths(levels, staged(above, "manifest-above"))
    columns = ["digest", "subroot", "path"]
    return Manifest(
        found.select(*(F.col("row")[name].alias(name) for name in kept), *columns),
        subroots.select(
            F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("group"),
            F.col("digest").alias("subroot"),
        ),
        root["digest"] if root else None,
    )


def lower_latin(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def verified_documents(docs: DataFrame) -> DataFrame:
    """Manifest of documents and its test against a copy with changed texts.

    Leaves are doc_id, source, lang, n_chars and text; groups are sources. In the copy, the
    text's A-Z are lower-cased where 5 divides the CRC-32 of the decimal doc_id. Every leaf
    of the copy is folded with the original path; it is verified if that gives the root.

    One row per input row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    Null values of any column are told apart from empty ones; a null doc_id is never
    changed. Other columns take no part. An empty table gives no rows.
    """
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    columns = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    leaf, changed = (row_digest(*columns, text) for text in (F.col("text"), lower_latin(F.col("text"))))
    rows = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        leaf.alias("leaf"),
        F.when(tampered, changed).otherwise(leaf).alias("found"),
    )
    manifest = build_manifest(rows, F.col("source"), F.col("doc_id"), F.col("leaf"))
    root = F.lit(manifest.root).cast("string")
    return manifest.rows.select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("found"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
