"""Exact top-k inner products with an M-tree.

Vectors get one more component that makes all lengths equal, so the largest inner product is the nearest neighbour. The tree
has four levels: routing pivots at the root (a bounded sample), nodes of bounded size below them, leaf pages and vectors. Every
node and page has a routing object, a covering radius and its distance to the routing object above it; every vector has its
distance to its page's. The triangle inequality on the stored distances tells of most entries, before any distance to them is
computed, that they can't hold one of the query's k best; the computed distance and the radius tell it of others. Nodes, and
pages within a node, are visited best first within each task. What is left is scored exactly in integers, so the result
equals brute force. Queries are a table; a round takes BLOCK of them, scans the tree once and writes what it found.

Components become floor(256 x). Null vectors and those with null or non-finite components take no part; shorter vectors
count as padded with zeros. Ties go to the smaller vec_id; repeated rows are candidates of their own and one query; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.common import stored
from gridframe.sources.shared import new_path

K = 5
PIVOTS = 64
NODE_ROWS = 2048
PAGE_ROWS = 128
BLOCK = 8192
_NODE = "pivot int, away double, radius double, routing binary, page_sizes binary, page_away binary, page_radius binary, page_routing binary, ids binary, vectors binary, far binary"


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and v (array of long) of every row that takes part."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select("vec_id", whole.cast("array<long>").alias("v"))


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _lifted(x: np.ndarray, lift: float) -> np.ndarray:
    """Vectors with the component that brings their squared length to `lift`."""
    f = x.astype(np.float64)
    rest = np.sqrt(np.maximum(lift - np.einsum("ij,ij->i", f, f), 0))
    return np.hstack([f, rest[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def build_tree(vectors: DataFrame, pivots: int = PIVOTS, node_rows: int = NODE_ROWS, page_rows: int = PAGE_ROWS) -> tuple[DataFrame, dict]:
    """Leaf pages of the tree, and its root: dim, lift and the pivots (at most `pivots` vectors)."""
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    shape = vectors.agg(F.max(F.size("v")), F.max(norm)).first()
    dim, lift = int(shape[0] or 0), float(shape[1] or 0.0)
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()  # bounded by `pivots`
    root = {"dim": dim, "lift": lift, "ids": [r["vec_id"] for r in chosen], "vectors": _matrix([r["v"] for r in chosen], dim)}
    lifted = _lifted(root["vectors"], lift)

    @F.pandas_udf("int")
    def nearest(part: pd.Series) -> pd.Series:
        return pd.Series(np.argmin(_distances(_lifted(_matrix(part, dim), lift), lifted), 1).astype(np.int32))

    dealt = stored(vectors.withColumn("pivot", nearest("v")), "dealt")
    counts = {r["pivot"]: r["count"] for r in dealt.groupBy("pivot").count().collect()}  # a row a pivot
    parts = F.lit(1)
    for p, c in counts.items():
        parts = F.when(F.col("pivot") == p, F.lit(-(-c // node_rows))).otherwise(parts) if c > node_rows else parts
    dealt = dealt.withColumn("node", F.pmod(F.xxhash64("vec_id"), parts))

    def pages(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(part["v"], dim)
        f, ids = _lifted(x, lift), part["vec_id"].to_numpy()
        n = -(-len(ids) // page_rows)
        seeds = f[np.linspace(0, len(ids) - 1, n).astype(int)]
        own = np.argmin(_distances(f, seeds), 1)
        order = np.argsort(own, kind="stable")
        node = f.mean(0)
        rows: list[np.ndarray] = []
        for group in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
            rows += [group[at : at + page_rows] for at in range(0, len(group), page_rows)]
        routing = np.stack([f[r].mean(0) for r in rows])
        far = [_distances(f[r], c[None])[:, 0] for r, c in zip(rows, routing, strict=True)]
        radius = np.array([d.max() for d in far])
        away = _distances(routing, node[None])[:, 0]
        order = np.concatenate(rows)
        one = (
            int(key[0]), float(_distances(node[None], lifted[int(key[0])][None])[0, 0]), float(_distances(f, node[None]).max()), node.tobytes(),
            np.array([len(r) for r in rows], np.int64).tobytes(), away.tobytes(), radius.tobytes(), routing.tobytes(), ids[order].tobytes(), x[order].tobytes(), np.concatenate(far).tobytes(),
        )
        return pd.DataFrame([one], columns=[c.split()[0] for c in _NODE.split(", ")])

    return stored(dealt.groupBy("pivot", "node").applyInPandas(pages, _NODE), "mtree"), root


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search(tree: DataFrame, root: dict, queries: list, k: int = K) -> DataFrame:
    """query_id, vec_id, score of what each task found best for a block of queries (vec_id, v): a superset of the top k."""
    dim, lift = root["dim"], root["lift"]
    ids = np.array([q[0] for q in queries], np.int64)
    x = _matrix([q[1] for q in queries], dim)
    f = x.astype(np.float64)
    norms = np.einsum("ij,ij->i", f, f)
    # Any k vectors bound the k-th best score from below: those that route at the root are some.
    start = np.full(len(ids), np.iinfo(np.int64).min)
    if len(root["ids"]):
        pivot_scores = np.where(np.array(root["ids"])[None, :] == ids[:, None], np.iinfo(np.int64).min, x @ root["vectors"].T)
        if pivot_scores.shape[1] > k:
            start = np.sort(pivot_scores, 1)[:, -k]
    block = tree.sparkSession.sparkContext.broadcast((ids, x, np.hstack([f, np.zeros((len(ids), 1))]), norms, start, _lifted(root["vectors"], lift)))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x, q, norms, start, pivots = block.value
        floor = start.copy()
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
        to_pivot = _distances(q, pivots)

        def reach(rows: np.ndarray) -> np.ndarray:
            # A score s means a squared distance of lift + |q|^2 - 2 s; the margin covers rounding.
            return np.sqrt(np.maximum(lift + norms[rows] - 2.0 * floor[rows], 0)) * (1 + 1e-9) + 1e-3

        def page(near: np.ndarray, away: np.ndarray, far: np.ndarray, own: np.ndarray, vectors: np.ndarray) -> None:
            """Score the members that the stored distances leave for some query."""
            members = np.flatnonzero((np.abs(away[:, None] - far[None, :]) <= reach(near)[:, None]).any(0))
            if not len(members):
                return
            scores = x[near] @ vectors[members].T
            for i, row in zip(near.tolist(), scores, strict=True):
                good = np.flatnonzero((row >= floor[i]) & (own[members] != ids[i]))
                if len(good):
                    s, v = np.concatenate((best[i][0], row[good])), np.concatenate((best[i][1], own[members][good]))
                    top = _best(s, v, k)
                    best[i] = (s[top], v[top])
                    if len(top) == k:
                        floor[i] = max(floor[i], s[top[-1]])

        for batch in batches:
            rows = batch.to_pylist()
            least = np.stack([np.abs(to_pivot[:, r["pivot"]] - r["away"]) - r["radius"] for r in rows], 1)
            for p in np.argsort(least.min(0)):
                r = rows[p]
                every = np.flatnonzero(least[:, p] <= reach(np.arange(len(ids))))
                away = _distances(q[every], np.frombuffer(r["routing"])[None])[:, 0]
                near = away - r["radius"] <= reach(every)
                every, away = every[near], away[near]
                if not len(every):
                    continue
                sizes, page_away, page_radius = np.frombuffer(r["page_sizes"], np.int64), np.frombuffer(r["page_away"]), np.frombuffer(r["page_radius"])
                routing = np.frombuffer(r["page_routing"]).reshape(len(sizes), -1)
                own, vectors, far = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["vectors"], np.int64).reshape(int(sizes.sum()), -1), np.frombuffer(r["far"])
                ends = np.cumsum(sizes)
                bound = np.abs(away[:, None] - page_away[None, :]) - page_radius[None, :]
                for j in np.argsort(bound.min(0)):
                    left = np.flatnonzero(bound[:, j] <= reach(every))
                    if not len(left):
                        continue
                    at = _distances(q[every[left]], routing[j][None])[:, 0]
                    fits = at - page_radius[j] <= reach(every[left])
                    if fits.any():
                        part = slice(ends[j] - sizes[j], ends[j])
                        page(every[left][fits], at[fits], far[part], own[part], vectors[part])
        found = [(np.full(len(s), i), v, s) for i, (s, v) in zip(ids, best, strict=True) if len(s)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

    return tree.mapInArrow(visit, "query_id long, vec_id long, score long")


def top_k(rows: DataFrame, every: int = 50, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by `every`, against all others."""
    vectors = stored(integer_vectors(rows), "vectors")
    tree, root = build_tree(vectors)
    asked = vectors.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    rounds = max(1, -(-asked.count() // block))
    dealt = stored(asked.withColumn("round", F.pmod(F.xxhash64("vec_id"), F.lit(rounds)).cast("int")), "queries")
    path = new_path(rows.sparkSession, "found")
    for r in range(rounds):  # a round is bounded, so its queries may pass through the driver; what it found is written
        asked = [(row["vec_id"], row["v"]) for row in dealt.where(F.col("round") == r).collect()]
        search(tree, root, asked, k).write.mode("append").parquet(path)
    out = rows.sparkSession.read.schema("query_id long, vec_id long, score long").parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_top_inner_products(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
   FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""
