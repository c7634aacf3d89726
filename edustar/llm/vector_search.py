"""Nearest neighbours by a block matrix join of int8 tiles with error bounds.

Queries and candidates are dealt into blocks of bounded rows; every pair of blocks is a tile. A vector x is
kept as sx * qx with int8 qx; with the norms of what rounding leaves, ex = x - sx * qx, the inner product
lies within |sx qx| |ey| + |ex| |sy qy| + |ex| |ey| of sx sy <qx, qy>. A tile multiplies the int8 matrices (exactly: the
integers are summed in float32 in slices of dimensions that can't overflow its mantissa), drops every pair
whose upper bound is below the query's k-th best lower bound, recomputes the others in double precision on
the original vectors, and keeps the k best of each query. A second step merges each query's tile lists by heaps.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows without a vec_id. Vectors of different length aren't compared. A query's own row is any row of its
vec_id; repeated rows are candidates each; of several query rows of one vec_id the smallest vector searches.
Ties go to the smaller vec_id. With fewer candidates than k all are returned; an empty table gives an empty
result. Extra columns have no effect.
"""

from __future__ import annotations

import heapq
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

NEAREST = 20
QUERY_ROWS, CANDIDATE_ROWS = 1024, 8192
MERGE_ROWS = 500_000  # rows of tile lists that one merge group holds on average, however many tiles there are
TILE_SCHEMA = "query_id long, vec_id long, score double"
DIMS_AT_ONCE = 1024  # 1024 * 127 * 127 < 2**24: sums of int8 products are exact in float32


def usable(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale, norm of the rounded vector and norm of the rounding error of each row."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1) * (1 + 1e-9)


def int8_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], DIMS_AT_ONCE):
        out += a[:, k:k + DIMS_AT_ONCE].astype(np.float32) @ b[:, k:k + DIMS_AT_ONCE].astype(np.float32).T
    return out


def best_of_tile(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int):
    """The k nearest candidates of each query in one tile: (query_id, vec_id, score), best first."""
    q8, qs, qn, qe = quantised(q)
    c8, cs, cn, ce = quantised(c)
    for at in range(0, len(q), 256):
        part = slice(at, at + 256)
        near = int8_product(q8[part], c8) * qs[part, None] * cs[None, :]
        slack = qn[part, None] * ce[None, :] + qe[part, None] * cn[None, :] + qe[part, None] * ce[None, :]
        slack += 1e-9 * (qn[part, None] + qe[part, None]) * (cn + ce)[None, :]  # rounding of the sums themselves
        low = near - slack
        low[qid[part, None] == cid[None, :]] = -np.inf
        top = min(k, len(c))
        floor = np.partition(low, len(c) - top, axis=1)[:, len(c) - top]
        i, j = np.nonzero((near + slack >= floor[:, None]) & (qid[part, None] != cid[None, :]))
        exact = np.cumsum(q[part][i] * c[j], axis=1)[:, -1] if len(i) else np.zeros(0)  # summed in the order of the components
        own = qid[part][i]
        order = np.lexsort((cid[j], -exact, i))
        i, j, exact, own = i[order], j[order], exact[order], own[order]
        first = np.searchsorted(i, i)
        keep = np.arange(len(i)) - first < k
        yield own[keep], cid[j[keep]], exact[keep]


def _tile(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and candidates.num_rows:
            qd, cd = (np.array(t.column("d").to_numpy()) for t in (queries, candidates))
            for d in np.intersect1d(qd, cd):
                a, b = (t.filter(pa.array(x == d)) for t, x in ((queries, qd), (candidates, cd)))
                out += best_of_tile(a.column("vec_id").to_numpy(), matrix(a.column("embedding")),
                                    b.column("vec_id").to_numpy(), matrix(b.column("embedding")), k)
        z = [np.zeros(0, np.int64)]
        cols = [np.concatenate([*(o[x] for o in out), *z]) for x in (0, 1, 2)]
        return pa.table({"query_id": cols[0].astype(np.int64), "vec_id": cols[1].astype(np.int64), "score": cols[2].astype(np.float64)})
    return run


def _merge(k: int):
    def run(lists: pa.Table) -> pa.Table:
        """The k best of each query from its tiles' lists, by a heap over the lists."""
        tile, q, v, s = (lists.column(n).to_numpy() for n in ("tile", "query_id", "vec_id", "score"))
        order = np.lexsort((v, -s, tile, q))
        rows = zip(q[order].tolist(), tile[order].tolist(), (-s[order]).tolist(), v[order].tolist())
        out = []
        for qid, own in groupby(rows, key=lambda r: r[0]):
            runs = [[(r[2], r[3]) for r in g] for _, g in groupby(own, key=lambda r: r[1])]
            out += [(qid, n + 1, vec, -neg) for n, (neg, vec) in enumerate(islice(heapq.merge(*runs), k))]
        c = list(zip(*out)) if out else [[], [], [], []]
        return pa.table({"query_id": pa.array(c[0], pa.int64()), "rank": pa.array(c[1], pa.int32()),
                         "vec_id": pa.array(c[2], pa.int64()), "score": pa.array(c[3], pa.float64())})
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """Each query's k nearest other rows by inner product: query_id, rank, vec_id, score."""
    rows = usable(vectors).withColumn("d", F.size("embedding"))
    queries = rows.where(is_query).groupBy("vec_id", "d").agg(F.min("embedding").alias("embedding")) \
        .groupBy("vec_id").agg(F.min(F.struct("embedding", "d")).alias("x")).select("vec_id", "x.embedding", "x.d")
    n = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    down, across = max(1, -(-n["q"] // query_rows)), max(1, -(-n["n"] // candidate_rows))
    spread = F.xxhash64("vec_id")
    left = queries.select("*", F.pmod(spread, F.lit(down)).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("j"))
    place = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(across))  # by place, so that repeated ids spread
    right = rows.select("*", place.cast("int").alias("j"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("i"))
    tiles = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(_with_place(_tile(k)), "tile int, " + TILE_SCHEMA)
    lists = written(tiles, "vector-tiles")
    groups = max(1, -(-n["q"] * across * k // MERGE_ROWS))  # a query has at most k rows of each of ``across`` tiles
    return lists.withColumn("g", F.pmod(F.xxhash64("query_id"), F.lit(groups))).groupBy("g").applyInArrow(
        _merge(k), "query_id long, rank int, vec_id long, score double")


def _with_place(work):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        t = work(queries, candidates)
        j = candidates.column("j")[0].as_py() if candidates.num_rows else 0
        return t.add_column(0, "tile", pa.array(np.full(t.num_rows, j, np.int32)))
    return run


def op2_block_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda a, b: a + b) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
