"""Connected components of a link table, by union-find in parts and stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugsites.sinks.stage import shared_folder, write_stage

EDGES = "u long, v long"


class UnionFind:
    """Sets of integers; a set is named by its smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (above := self.parent.setdefault(root, root)) != root:
            root = above
        while x != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: each member with its set's smallest."""
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            sets.union(a, b)
    pairs = [(x, root) for x in list(sets.parent) if (root := sets.find(x)) != x]
    if pairs:
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in zip(*pairs)], ["u", "v"]
        )


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a long, b long).

    The component is its smallest node. Tasks first reduce their own links by union-find
    to stars, no more rows than nodes. Then rounds link each node's larger neighbours, and
    next its smaller ones, to the smallest it knows, until nothing changes; every round
    is a few aggregations and joins and is written to the shared folder. Nothing is
    gathered, and a hub's neighbours are spread like any other rows. Links with a null
    end and links of a node to itself are without effect.
    """
    spark = links.sparkSession
    clean = links.where("a <> b").select("a", "b")
    edges = clean.mapInArrow(_forest, EDGES)
    seen = None
    while True:
        path = shared_folder(spark, "stars")
        metrics = {"n": F.count("*"), "mark": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
        state = write_stage(edges, path, metrics)
        edges = spark.read.schema(EDGES).parquet(path)
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
        edges = _small_star(_large_star(edges))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m")
    moved = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()
