"""Exact top-k search by inner product in M-trees.

Adding one coordinate, the square root of what a vector's squared length lacks
to the longest one, makes the largest inner product the smallest distance.

Vectors go to the nearest of a bounded set of pivots and, inside a pivot's
cell, by hash to trees of bounded size.  A tree's nodes are pages of entries
with covering radius and distance to their parent; the search opens nodes in
the order of their lower bound and skips computing a distance where the stored
ones already rule an entry out.  A query is first answered in one tree near
it, then in every cell that its k-th score does not exclude.
"""
from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertlens.llm.common import id_hash, materialize

PAGE = 64
TREE_ROWS = 4096
#: bound of the sample of vectors that become pivots
MAX_PIVOTS = 256
ROWS_PER_PIVOT = 2048
QUERY_BLOCK = 4096
NO_ID = np.iinfo(np.int64).max


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v, norm2) of the usable rows: v = floor(scale * x); null and non-finite components exclude a row."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    v = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e).cast("long"))
    return (rows.filter(F.col("embedding").isNotNull() & fine).select("vec_id", v.alias("v"))
            .withColumn("norm2", F.aggregate("v", F.lit(0).cast("long"), lambda a, e: a + e * e)))


def matrix(vectors, dims: int) -> np.ndarray:
    """Rows of integers, missing components 0."""
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def lifted(v: np.ndarray, longest: int, query: bool = False) -> np.ndarray:
    """The vectors in the space where distance orders by inner product; queries stay in the plane."""
    norm2 = (v * v).sum(axis=1)
    last = np.zeros(len(v)) if query else np.sqrt(np.maximum(longest - norm2, 0).astype(float))
    return np.concatenate((v.astype(float), last[:, None]), axis=1)


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to) ** 2).sum(axis=-1))


class Node:
    """A page: routing entries (center, radius, distance to this node's center) or rows with that distance."""

    def __init__(self, center: int):
        self.center = center
        self.children: list[Node] = []
        self.rows = self.centers = self.radius = self.to_parent = None


class MTree:
    def __init__(self, points: np.ndarray):
        self.points = points
        self.root, self.radius = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> tuple[Node, float]:
        """Bulk load: spread centers, each row to the nearest, until a page holds the rest."""
        points = self.points[rows]
        middle = int(rows[np.argmin(distances(points, points.mean(axis=0)))])
        node = Node(middle)
        to_center = distances(points, self.points[middle])
        parts = []
        if len(rows) > PAGE:
            picks = rows[np.linspace(0, len(rows) - 1, min(PAGE, -(-len(rows) // (PAGE // 2)))).astype(int)]
            nearest = np.argmin(np.stack([distances(points, self.points[p]) for p in picks]), axis=0)
            parts = [rows[nearest == k] for k in range(len(picks)) if (nearest == k).any()]
            if len(parts) == 1:  # equal vectors: cut by number
                parts = np.array_split(rows, -(-len(rows) // PAGE))
        if parts:
            built = [self._build(p) for p in parts]
            node.children = [b[0] for b in built]
            node.centers = np.array([b[0].center for b in built])
            node.radius = np.array([b[1] for b in built])
            node.to_parent = distances(self.points[node.centers], self.points[middle])
        else:
            node.rows, node.to_parent = rows, to_center
        return node, float(to_center.max())

    def search(self, query: np.ndarray, scores, worst: float, k: int, distance_of) -> list[tuple[int, int]]:
        """Best-first search: the k best (score, -place) among rows whose distance may still be within `worst`.

        scores(rows) are the exact scores; distance_of(score) is the distance
        of the k-th best, beyond which nothing can enter.
        """
        best: list[tuple[int, int]] = []
        first = float(distances(self.points[self.root.center], query))
        queue = [(max(0.0, first - self.radius), 0, first, self.root)]
        made = 1
        slack = lambda d: d + 1e-9 * (1.0 + d)
        while queue and queue[0][0] <= slack(worst):
            _, _, to_center, node = heapq.heappop(queue)
            gap = np.abs(to_center - node.to_parent)
            if node.rows is not None:
                left = node.rows[gap <= slack(worst)]
                if len(left):
                    for s, r in zip(scores(left).tolist(), left.tolist()):
                        entry = (s, -r)
                        if len(best) < k:
                            heapq.heappush(best, entry)
                        elif entry > best[0]:
                            heapq.heapreplace(best, entry)
                    if len(best) == k:
                        worst = min(worst, distance_of(best[0][0]))
                continue
            near = np.flatnonzero(gap - node.radius <= slack(worst))
            if len(near):
                to_child = distances(self.points[node.centers[near]], query)
                low = np.maximum(0.0, to_child - node.radius[near])
                for i, d, b in zip(near.tolist(), to_child.tolist(), low.tolist()):
                    if b <= slack(worst):
                        heapq.heappush(queue, (b, made, d, node.children[i]))
                        made += 1
        return best


_FOUND = "query long, q_key long, vec_id long, score long"


def _search_tree(longest: int, dims: int, k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            ids = rows["vec_id"].fillna(NO_ID).astype(np.int64).to_numpy() if rows["vec_id"].isna().any() else rows["vec_id"].to_numpy(np.int64)
            order = np.argsort(ids, kind="stable")  # place orders ties by id
            ids, v = ids[order], matrix(rows["v"].to_numpy()[order], dims)
            tree = MTree(lifted(v, longest))
            q = matrix(queries["v"].to_numpy(), dims)
            points = lifted(q, longest, query=True)
            for i, (own, key, known) in enumerate(zip(queries["query"].tolist(), queries["q_key"].tolist(), queries["kth"].tolist())):
                length2 = float((q[i] * q[i]).sum()) + longest
                distance_of = lambda s, c=length2: float(np.sqrt(max(0.0, c - 2.0 * s)))
                worst = np.inf if known is None or np.isnan(known) else distance_of(known)
                # one more, as the query's own row is left out
                best = tree.search(points[i], lambda r, x=q[i]: v[r] @ x, worst, k + int((ids == own).sum()), distance_of)
                found += [(own, key, int(ids[-p]), s) for s, p in best if ids[-p] != own]
        return pd.DataFrame(found, columns=["query", "q_key", "vec_id", "score"])
    return run


def _visits(pivots: np.ndarray, radius: np.ndarray, longest: int, dims: int):
    """The cells of each query that its k-th score does not exclude."""
    def run(batches):
        for batch in batches:
            q = matrix(batch.column(1).to_pylist(), dims)
            points = lifted(q, longest, query=True)
            worst = np.array([np.inf if s is None else np.sqrt(max(0.0, float((x * x).sum()) + longest - 2.0 * s))
                              for x, s in zip(q, batch.column(2).to_pylist())])
            low = np.stack([distances(points, p) for p in pivots], axis=1) - radius
            row, cell = np.nonzero((low <= (worst + 1e-9 * (1.0 + worst))[:, None]) & (radius >= 0))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                                              batch.column(2).take(pa.array(row)), batch.column(3).take(pa.array(row)), pa.array(cell)],
                                             names=["query", "v", "kth", "q_key", "cell"])
    return run


def top_k(rows: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows by inner product for the rows whose id is divisible by `every`.

    Ties go to the smaller vec_id; a query's own id is no candidate.  Fewer
    than k candidates: all of them.  Rows with one id and different vectors are
    queries of their own, each with its ranks under that id, and no candidates of each other.  Vectors that are null or hold null or
    non-finite components take no part; missing components of shorter vectors
    count as 0.  Null ids are no queries and come last among ties.  Rows that
    repeat an id and vector are one query and as many candidates.  Empty
    input: no rows.  Other input columns are not read.
    """
    data = materialize(integer_vectors(rows, scale))
    spark = rows.sparkSession
    got = data.agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("longest"), F.max(F.size("v")).alias("dims")).first()
    n, longest, dims = got["n"], got["longest"] or 0, max(1, got["dims"] or 0)
    wanted = max(1, min(MAX_PIVOTS, -(-n // ROWS_PER_PIVOT)))
    sample = data.orderBy(id_hash(F.col("vec_id")), "vec_id", "v").limit(wanted).select("v").collect()  # MAX_PIVOTS at most
    pivots = lifted(matrix([r["v"] for r in sample], dims), longest)
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def assign(query: bool):
        def run(batches):
            for batch in batches:
                points = lifted(matrix(batch.column(1).to_pylist(), dims), longest, query)
                to = np.stack([distances(points, p) for p in pivots], axis=1) if batch.num_rows else np.zeros((0, 1))
                cell = to.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell), pa.array(to.min(axis=1) if len(to) else np.zeros(0))],
                                                 names=["vec_id", "v", "cell", "to_pivot"])
        return run

    kind = "vec_id long, v array<long>, cell long, to_pivot double"
    ids = data.select(F.col("vec_id").cast("long"), "v")
    placed = materialize(ids.mapInArrow(assign(False), kind))
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("to_pivot").alias("r")).collect()}  # one row a pivot
    trees = F.create_map(*[F.lit(x) for c in cells for x in (c, -(-cells[c]["n"] // TREE_ROWS))])
    radius = np.array([cells[c]["r"] if c in cells else -np.inf for c in range(len(pivots))])

    queries = ids.filter(F.col("vec_id") % every == 0).distinct()
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks))
    candidates = (placed.withColumn("tree", F.pmod(F.xxhash64("vec_id", "v"), trees[F.col("cell")]))
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
                  .select("cell", "tree", "block", "vec_id", "v"))

    def searched(asked: DataFrame) -> DataFrame:
        keys = ["cell", "tree", "block"]
        return asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(_search_tree(longest, dims, k), _FOUND)

    q_key = F.xxhash64("vec_id", "v").alias("q_key")  # tells queries of one id apart
    near = queries.mapInArrow(assign(True), kind).filter(F.col("cell").isin(*cells))
    start = (near.select(F.col("vec_id").alias("query"), "v", F.lit(None).cast("long").alias("kth"), q_key, "cell")
             .withColumn("tree", F.pmod(F.xxhash64("query"), trees[F.col("cell")])).withColumn("block", block))
    bound = (searched(start).withColumn("place", F.row_number().over(Window.partitionBy("query", "q_key").orderBy(F.desc("score"))))
             .filter(F.col("place") == k).select(F.col("query").alias("b_query"), F.col("q_key").alias("b_key"), F.col("score").alias("kth")))
    asked = (queries.select("vec_id", "v", q_key).join(bound, (F.col("vec_id") == F.col("b_query")) & (F.col("q_key") == F.col("b_key")), "left")
             .select(F.col("vec_id").alias("query"), "v", "kth", "q_key")
             .mapInArrow(_visits(pivots, radius, longest, dims), "query long, v array<long>, kth long, q_key long, cell long")
             .withColumn("tree", F.explode(F.sequence(F.lit(0).cast("long"), trees[F.col("cell")].cast("long") - 1))).withColumn("block", block))
    order = Window.partitionBy("query", "q_key").orderBy(F.desc("score"), F.col("vec_id"))
    return (searched(asked).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score"))


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 5
"""
