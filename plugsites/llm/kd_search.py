"""Exact top-k inner products: a KD-tree per shard, searched best box first.

Candidates are dealt by KD cuts of a bounded sample, so a shard is a region with a box of
its own; regions that hold more than a shard's rows (copies of one vector, say) are dealt
further by hash. Each shard's tree is built and stored once. A query first searches the
shard whose box promises most. The kth score found there travels with it into a second
pass, and only to shards whose boxes reach it; within a shard, boxes that cannot reach it
are never opened.

Trees and the queries sent to them meet in a sorted stream: a task holds one tree and one
batch of queries at a time, however many queries a shard has.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plugsites.llm.frames import of_checked_size, staged

SHARD_ROWS = 8192
LEAF_ROWS = 128
#: The cuts come from a sample of about so many vectors and so many of their values.
SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 2_000_000
#: So many sides of boxes are held at once where queries choose their shards.
BOX_VALUES = 4_000_000
#: A shard that more queries come to is stored for several tasks.
QUERIES_PER_TASK = 50_000
#: Integers up to here are exact as doubles.
EXACT = 2**53
HITS = "query_id long, vec_id long, score long"
TREES = "region long, part int, size int, low array<long>, high array<long>, tree binary"
VISITS = "region long, part int, vec_id long, vector array<long>, kth long, bound double"
LOWEST = -(2**63)


def quantised(
    vectors: DataFrame, scale: float, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """vec_id and the vector as integers, floor(scale * x) with x as double.

    Vectors that are null or hold null or non-finite components are left out, and so are
    rows without an id and exact repetitions of a row.
    """
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return (
        vectors.select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.col(vector_column).cast("array<double>").alias("vector"),
        )
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
        .select("vec_id", F.transform("vector", lambda v: F.floor(scale * v)).alias("vector"))
        .dropDuplicates(["vec_id", "vector"])
    )


class KDTree:
    """Median splits along the widest side, down to leaves; every node has a tight box."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.points = points
        self.order = np.arange(len(points))
        self.bounds: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        low, high = [], []
        todo = [(0, len(points), None, 0)]
        while todo:
            first, last, parent, side = todo.pop()
            node = len(self.bounds)
            if parent is not None:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (pair[0], node) if side else (node, pair[1])
            rows = points[self.order[first:last]]
            low.append(rows.min(axis=0))
            high.append(rows.max(axis=0))
            self.bounds.append((first, last))
            self.children.append(None)
            sides = high[-1] - low[-1]
            if last - first > leaf_rows and sides.size and sides.max() > 0:
                middle = (last - first) // 2
                split = np.argpartition(rows[:, int(sides.argmax())], middle)
                self.order[first:last] = self.order[first:last][split]
                self.children[node] = (0, 0)
                todo.append((first, first + middle, node, 0))
                todo.append((first + middle, last, node, 1))
        self.low, self.high = np.array(low), np.array(high)

    def box_bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product any point of each node's box can have with each query."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.high.T + down @ self.low.T

    def search(
        self, query: np.ndarray, bounds: np.ndarray, own: int, ids: np.ndarray, k: int, kth: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, ties to smaller ids; none below ``kth``."""
        best_ids, best = np.empty(0, np.int64), np.empty(0, bounds.dtype)
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < kth:
                break
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= kth:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            first, last = self.bounds[node]
            rows = self.order[first:last]
            scores = self.points[rows] @ query
            keep = (scores >= kth) & (ids[rows] != own)
            if not keep.any():
                continue
            best = np.concatenate([best, scores[keep]])
            best_ids = np.concatenate([best_ids, ids[rows[keep]]])
            if len(best) > k:
                top = np.lexsort((best_ids, -best))[:k]
                best, best_ids = best[top], best_ids[top]
            if len(best) == k:
                kth = max(kth, best.min())
        return best_ids, best


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), dtype=np.int64).reshape(len(rows), -1)


def _exactly(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As doubles where no sum can lose a unit, else as Python integers."""
    largest = float(np.abs(points).max(initial=0)) * float(np.abs(queries).max(initial=0))
    kind = np.float64 if largest * max(points.shape[1], 1) < EXACT else object
    return points.astype(kind), queries.astype(kind)


@dataclass(frozen=True)
class _Cuts:
    """KD cuts of the vectors of each length: inner nodes (axis, cut, below, above); a child
    below 0 is region ``-1 - child``."""

    nodes: dict[int, list[tuple[int, int, int, int]]]

    def regions(self, vectors: pd.Series) -> np.ndarray:
        out = np.empty(len(vectors), np.int64)
        sizes = vectors.map(len).to_numpy()
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            nodes = self.nodes.get(int(size))
            if not nodes:  # a length that the sample has not, or one region for all of it
                out[rows] = -1 - size
                continue
            points = _matrix(vectors.iloc[rows])
            todo = [(0, np.arange(len(rows)))]
            while todo:
                node, held = todo.pop()
                if node < 0:
                    out[rows[held]] = (int(size) << 32) - 1 - node
                    continue
                axis, cut, below, above = nodes[node]
                low = points[held, axis] < cut
                todo += [(below, held[low]), (above, held[~low])]
        return out


def _cut(points: np.ndarray, region_rows: float) -> list[tuple[int, int, int, int]]:
    """Median cuts along the widest side until regions have so many of the points."""
    nodes: list[list[int]] = []
    regions = 0
    todo = [(points, -1, 0)]
    while todo:
        held, parent, place = todo.pop()
        sides = held.max(axis=0) - held.min(axis=0) if held.size else np.zeros(1, np.int64)
        if len(held) <= region_rows or sides.max() <= 0:
            regions += 1
            child = -regions
        else:
            axis = int(sides.argmax())
            cut = int(np.partition(held[:, axis], len(held) // 2)[len(held) // 2])
            if cut == held[:, axis].min():
                cut += 1  # more than half of the points are the least
            low = held[:, axis] < cut
            child = len(nodes)
            nodes.append([axis, cut, 0, 0])
            todo += [(held[low], child, 2), (held[~low], child, 3)]
        if parent >= 0:
            nodes[parent][place] = child
    return [tuple(node) for node in nodes]


def _sampled_cuts(vectors: DataFrame, rows: int, values: int, shard_rows: int) -> _Cuts:
    """Cuts from a sample of bounded size, drawn by the hash of the id."""
    share = min(1.0, SAMPLE_ROWS / max(rows, 1), SAMPLE_VALUES / max(values, 1))
    drawn = F.pmod(F.xxhash64("vec_id", F.lit("cuts")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = pd.Series([row.vector for row in vectors.where(drawn).select("vector").collect()])
    if sample.empty:
        return _Cuts({})
    sizes = sample.map(len)
    return _Cuts({int(size): _cut(_matrix(sample[sizes == size]), shard_rows * share) for size in sizes.unique()})


def _smallest(values: np.ndarray) -> np.ndarray:
    """Integers in the narrowest type that holds them."""
    return values.astype(np.result_type(np.int8, *map(np.min_scalar_type, (values.min(initial=0), values.max(initial=0)))))


def build_trees(vectors: DataFrame, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row per shard: its box and its tree, stored. Every vector is in one of them."""
    sizes = vectors.agg(F.count("*").alias("rows"), F.sum(F.size("vector")).alias("values")).first()
    cuts = _sampled_cuts(vectors, sizes["rows"], sizes["values"] or 0, shard_rows)

    @F.pandas_udf("long")
    def region_of(rows: pd.Series) -> pd.Series:
        return pd.Series(cuts.regions(rows))

    dealt = vectors.withColumn("region", region_of("vector"))
    counts = dealt.groupBy("region").agg(F.ceil(F.count("*") / shard_rows).alias("parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    dealt = dealt.join(of_checked_size(counts), "region").select("region", part.alias("part"), "vec_id", "vector")

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        points = _matrix(rows["vector"])
        tree = KDTree(points, leaf_rows)
        stored = (rows["vec_id"].to_numpy(np.int64), _smallest(points), tree.order, tree.bounds, tree.children, tree.low, tree.high)
        row = (*map(int, key), points.shape[1], tree.low[0].tolist(), tree.high[0].tolist(), pickle.dumps(stored))
        return pd.DataFrame([row], columns=["region", "part", "size", "low", "high", "tree"])

    return staged(dealt.groupBy("region", "part").applyInPandas(build, TREES), "trees")


def _box_rounds(trees: DataFrame) -> Iterator[list]:
    """Boxes of all shards, in rounds of bounded size."""
    sides = trees.agg(F.sum(2 * F.col("size") + 1)).first()[0] or 0
    rounds = max(1, math.ceil(sides / BOX_VALUES))
    boxes = trees.select("region", "part", "size", "low", "high")
    deal = F.pmod(F.xxhash64("region", "part"), F.lit(rounds))
    for one in range(rounds):
        yield [tuple(row) for row in boxes.where(deal == one).collect()]


def _visits(asked: DataFrame, boxes: list, best_only: bool) -> DataFrame:
    """The shards whose boxes reach a query's kth score, or only the one that promises most.

    ``asked``: vec_id, vector, kth and home, the shard that was searched before.
    """
    shared = asked.sparkSession.sparkContext.broadcast(boxes)
    names = [part.split()[0] for part in VISITS.split(", ")]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, list] = {}
        for region, part, size, low, high in shared.value:
            by_size.setdefault(size, []).append(((region, part), low, high))
        held = {
            size: ([one[0] for one in rows], *(np.array([one[n] for one in rows], float).T for n in (1, 2)))
            for size, rows in by_size.items()
        }
        for batch in batches:
            rows = []
            for vec_id, vector, kth, home in zip(*(batch.column(n).to_pylist() for n in ("vec_id", "vector", "kth", "home"))):
                if len(vector) not in held:
                    continue
                shards, low, high = held[len(vector)]
                query = np.array(vector, float)
                up, down = np.maximum(query, 0), np.minimum(query, 0)
                bounds = up @ high + down @ low
                # Sums of doubles can lose a little; a bound must not.
                bounds = bounds + 1 + 1e-12 * (up @ np.abs(high) - down @ np.abs(low))
                if best_only:
                    chosen = [int(bounds.argmax())]
                else:
                    chosen = np.flatnonzero(bounds >= kth).tolist()
                home = (home["region"], home["part"]) if home else None
                rows += [(*shards[n], vec_id, vector, kth, bounds[n]) for n in chosen if shards[n] != home]
                if len(rows) >= 10_000:
                    yield _batch(rows, names)
                    rows = []
            if rows:
                yield _batch(rows, names)

    return asked.mapInArrow(choose, VISITS)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)


def _searched(trees: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Hits of each visit. Trees come before their queries in one sorted stream."""
    shard = ["region", "part"]
    copies = visits.groupBy(*shard).agg(F.ceil(F.count("*") / QUERIES_PER_TASK).alias("copies"))
    copies = of_checked_size(copies)
    copy = F.pmod(F.xxhash64("vec_id"), F.col("copies"))
    asked = visits.join(copies, shard).select(*shard, copy.alias("copy"), F.lit(1).alias("turn"), "vec_id", "vector", "kth")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    held = trees.join(copies, shard).select(*shard, every.alias("copy"), F.lit(0).alias("turn"), "tree")
    both = held.unionByName(asked, allowMissingColumns=True)
    key = [*shard, "copy"]
    stream = both.repartition(*key).sortWithinPartitions(*key, "turn")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            turns = batch.column("turn").to_pylist()
            at = 0
            while at < len(turns):
                if turns[at] == 0:
                    tree = _Stored(*pickle.loads(batch.column("tree")[at].as_py()))
                    at += 1
                    continue
                end = at
                while end < len(turns) and turns[end]:
                    end += 1
                hits = tree.hits(batch.slice(at, min(end - at, QUERIES_AT_ONCE)), k)
                at = min(end, at + QUERIES_AT_ONCE)
                if hits:
                    arrays = [pa.array(column, pa.int64()) for column in zip(*hits)]
                    yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    return stream.select("turn", "tree", "vec_id", "vector", "kth").mapInArrow(search, HITS)


#: Bounds of all boxes of a tree are computed for so many queries at once.
QUERIES_AT_ONCE = 512


class _Stored:
    """A tree as it was stored, ready to be searched."""

    def __init__(self, ids, points, order, bounds, children, low, high):
        self.ids, self.points = ids, points.astype(np.int64)
        self.tree = KDTree.__new__(KDTree)
        self.tree.order, self.tree.bounds, self.tree.children = order, bounds, children
        self.low, self.high = low, high

    def hits(self, asked: pa.RecordBatch, k: int) -> list[tuple[int, int, int]]:
        own = asked.column("vec_id").to_pylist()
        kths = asked.column("kth").to_pylist()
        queries = np.array(asked.column("vector").to_pylist(), np.int64).reshape(len(own), -1)
        tree = self.tree
        tree.points, queries = _exactly(self.points, queries)
        tree.low, tree.high = (box.astype(queries.dtype) for box in (self.low, self.high))
        bounds = tree.box_bounds(queries)
        found = []
        for row, (query_id, kth) in enumerate(zip(own, kths)):
            ids, scores = tree.search(queries[row], bounds[row], query_id, self.ids, k, kth)
            found += [(query_id, vec_id, int(score)) for vec_id, score in zip(ids.tolist(), scores)]
        return found


def best_of(hits: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best per query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The k highest integer inner products of each query with all vectors but its own.

    Both inputs hold vec_id long and vector array<long>. Vectors of another length than
    the query's are no candidates. All are returned if there are fewer than k; ties go to
    the smaller vec_id. Empty tables give no rows; null vectors and rows without an id take
    no part. A score must fit a long.
    """
    usable = "vec_id IS NOT NULL AND vector IS NOT NULL"
    vectors, queries = (staged(df.where(usable), name) for df, name in ((vectors, "vectors"), (queries, "queries")))
    trees = build_trees(vectors, shard_rows, leaf_rows)

    def visits(asked: DataFrame, best_only: bool) -> DataFrame:
        parts = [_visits(asked, boxes, best_only) for boxes in _box_rounds(trees)]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out

    lowest = F.lit(LOWEST).cast("long").alias("kth")
    nowhere = F.lit(None).cast("struct<region:bigint,part:int>").alias("home")
    promising = visits(queries.select("vec_id", "vector", lowest, nowhere), True)
    home = F.struct("region", "part")
    best = F.max_by(home, F.struct("bound", "region", "part")).alias("home")
    homes = staged(promising.groupBy("vec_id", "vector").agg(best), "homes")
    first = staged(_searched(trees, homes.select("home.*", "vec_id", "vector", lowest), k), "hits")
    full = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    reached = full.where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), "kth")
    asked = homes.join(reached, "vec_id", "left").withColumn("kth", F.coalesce("kth", lowest))
    others = visits(staged(asked.select("vec_id", "vector", "kth", "home"), "asked"), False)
    return best_of(first.unionByName(_searched(trees, others, k)), k)
