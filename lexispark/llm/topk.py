"""Exact top-k inner products with a KD-tree per shard."""

from __future__ import annotations

import functools
import heapq
import io
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._tables import lean, materialise

#: Vectors in a shard (about; a tree is one row), in a leaf, and queries in a block.
SHARD, LEAF, BLOCK = 16_384, 256, 512
#: Blocks that search one copy of a tree.
VISITS = 64
#: Whole numbers up to here are exact in the matrix products.
EXACT = 1 << 53

ANSWER = "query_id bigint, vec_id bigint, score bigint"


class KDTree:
    """Median splits of the widest side; every node keeps its tight bounding box and its smallest id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray | None = None, nodes: np.ndarray | None = None, boxes: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        if nodes is None:
            self._build()
        else:
            self.nodes, self.boxes = nodes, boxes

    def _build(self) -> None:
        order, nodes, low, high = np.arange(len(self.ids)), [], [], []
        todo = [(0, len(order), -1)]
        while todo:
            begin, end, parent = todo.pop()
            here = self.vectors[order[begin:end]]
            low.append(here.min(0))
            high.append(here.max(0))
            me = len(nodes)
            nodes.append([begin, end, -1, -1, int(self.ids[order[begin:end]].min())])
            if parent >= 0:
                nodes[parent][3 if nodes[parent][2] >= 0 else 2] = me
            wide = high[-1] - low[-1]
            if end - begin > LEAF and wide.max() > 0:
                axis, half = int(wide.argmax()), (end - begin) // 2
                order[begin:end] = order[begin:end][np.argpartition(here[:, axis], half)]
                todo += [(begin, begin + half, me), (begin + half, end, me)]
        self.ids, self.vectors = self.ids[order], self.vectors[order]
        self.nodes, self.boxes = np.array(nodes, np.int64), np.stack([low, high])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, vectors=self.vectors, nodes=self.nodes, boxes=self.boxes)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> KDTree:
        with np.load(io.BytesIO(raw)) as x:
            return cls(x["ids"], x["vectors"], None, x["nodes"], x["boxes"])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product that any point of each node's box can have with each query."""
        low, high = self.boxes
        return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T

    def search(self, query: np.ndarray, own: int, bound: np.ndarray, k: int, best: list[tuple[float, int]]) -> list[tuple[float, int]]:
        """Best-first traversal. best holds up to k (score, -id) from elsewhere, smallest first: its first one is the
        propagated kth; a box below it, or level with it and without a smaller id, is not opened."""
        heap = heapq.nlargest(k, best)
        heapq.heapify(heap)
        bound = bound.tolist()
        queue = [(-bound[0], 0)]
        while queue:
            top, node = heapq.heappop(queue)
            begin, end, left, right, least = self.nodes[node].tolist()
            if len(heap) == k and (-top, -least) < heap[0]:
                if -top < heap[0][0]:
                    break
                continue
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(queue, (-bound[child], child))
                continue
            scores = self.vectors[begin:end] @ query
            ids = self.ids[begin:end]
            if len(heap) == k:
                some = np.flatnonzero(scores >= heap[0][0])
            else:
                some = np.arange(len(ids))
            some = some[ids[some] != own]
            if len(some) > 8 * k:  # the k best of a leaf are enough
                some = some[np.lexsort((ids[some], -scores[some]))[:k]]
            for s, i in zip(scores[some].tolist(), ids[some].tolist(), strict=True):
                if len(heap) < k:
                    heapq.heappush(heap, (s, -i))
                elif (s, -i) > heap[0]:
                    heapq.heapreplace(heap, (s, -i))
        return heap


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, _query): floor(256 * x) of each component; rows whose vector is null or has a null or non-finite one are gone."""
    v = F.col(vector_col)
    fine = F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.where(fine).select(F.col(id_col).cast("bigint").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("v"), F.coalesce("_query", F.lit(False)).alias("_query"))


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Rows of equal or smaller width; missing components are 0."""
    lens = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), kind)
    out[np.arange(width)[None, :] < lens[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _plant(key, table, width, kind):  # no hints: Spark would read them
    tree = KDTree(table["vec_id"].to_numpy(), _matrix(table["v"].combine_chunks(), width, kind))
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "tree": pa.array([tree.dump()], pa.binary())})


def _block(key, table, width, kind):  # no hints: Spark would read them
    table = table.sort_by("vec_id")
    out = io.BytesIO()
    np.savez(out, ids=table["vec_id"].to_numpy(), vectors=_matrix(table["v"].combine_chunks(), width, kind))
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "queries": pa.array([out.getvalue()], pa.binary())})


@lean
def _search(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows by (shard, salt): a tree (queries null), then the blocks of queries that search it."""
    tree = None
    for batch in batches:
        for row in range(batch.num_rows):
            if (raw := batch.column(0)[row].as_py()) is not None:
                tree = KDTree.load(raw)
                continue
            with np.load(io.BytesIO(batch.column(1)[row].as_py())) as x:
                ids, queries = x["ids"], x["vectors"]
            start: dict[int, list[tuple[float, int]]] = {}
            for r in batch.column(2)[row].as_py() or []:
                start.setdefault(r["query_id"], []).append((r["score"], -r["vec_id"]))
            bound, out = tree.bounds(queries), []
            for q, own, b in zip(queries, ids.tolist(), bound, strict=True):
                before = start.get(own, [])
                # what is known from elsewhere only raises the bar and isn't answered again
                out += [(own, -i, int(s)) for s, i in tree.search(q, own, b, k, before) if (s, i) not in before]
            cols = list(zip(*out, strict=True)) if out else ((), (), ())
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id with rows where is_query holds the k rows of other vec_ids with the
    largest integer inner products, ties to the smaller vec_id.

    Vectors are dealt to shards by a hash, and each shard is a tree; queries are dealt to blocks. Each block first
    searches one shard; its kth scores then go along to all other shards, so that their boxes are pruned from the
    start. Blocks travel to trees, and a tree once for each VISITS of them. Memory follows shard and block, the work the
    number of their pairs. Vectors null or with null or non-finite components take no part; shorter vectors count as
    padded with zeros; every row is a candidate, also one of several with equal vec_id, which share their shard; equal
    rows are one query; null ids
    take no part; an empty table gives no rows; columns other than the two named and those in is_query are not read.
    Products beyond 2 ** 53 are made of whole numbers; beyond 2 ** 63, which no score can hold, they are an error.
    """
    every = materialise(quantised(vectors.select(id_col, vector_col, is_query.alias("_query")), id_col, vector_col), "vectors")
    n, width, largest, asked = every.agg(F.count("*"), F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))), F.count_if("_query")).first()
    width, most = max(width or 0, 1), (width or 0) * int(largest or 0) ** 2
    if most >= 1 << 63:
        raise ValueError("the inner products do not fit in 64 bits")
    kind = np.int64 if most >= EXACT else np.float64
    queries = every.where("_query").select("vec_id", "v").distinct()
    shards, blocks = max(1, math.ceil(n / shard)), max(1, math.ceil(asked / block))
    pick = lambda count, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(count)).cast("int")
    trees = materialise(every.select("vec_id", "v", pick(shards, 1).alias("shard")).groupBy("shard").applyInArrow(functools.partial(_plant, width=width, kind=kind), "shard int, tree binary"), "trees")
    packed = materialise(queries.select("vec_id", "v", pick(blocks, 2).alias("block")).groupBy("block").applyInArrow(functools.partial(_block, width=width, kind=kind), "block int, queries binary"), "queries")
    home = F.pmod(F.col("block"), F.lit(shards)).cast("int")
    salts = math.ceil(blocks / VISITS)
    array = "array<struct<query_id:bigint,vec_id:bigint,score:bigint>>"
    planted = trees.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "tree", F.lit(None).cast("binary").alias("queries"), F.lit(None).cast(array).alias("known"))

    def search(visits: DataFrame) -> DataFrame:
        rows = visits.select("shard", (F.col("block") % salts).alias("salt"), F.lit(None).cast("binary").alias("tree"), "queries", "known").unionByName(planted)
        return rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("tree").isNull()).select("tree", "queries", "known").mapInArrow(functools.partial(_search, k=k), ANSWER)

    first = materialise(search(packed.withColumn("shard", home).withColumn("known", F.lit(None).cast(array)).join(trees.select("shard"), "shard", "left_semi")), "first")
    known = first.join(queries.select(F.col("vec_id").alias("query_id"), pick(blocks, 2).alias("block")).distinct(), "query_id").groupBy("block").agg(F.collect_list(F.struct("query_id", "vec_id", "score")).alias("known"))
    others = packed.join(known, "block", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(F.col("shard") != home)
    found = first.unionByName(search(others.join(trees.select("shard"), "shard", "left_semi"))) if shards > 1 else first
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
