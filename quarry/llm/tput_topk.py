"""Exact top-k inner products by a three-phase uniform threshold.

The components of a vector are cut into ``lists`` slices; a slice's partial inner product
is an object's entry in that score list. For a block of queries:

1. every task computes its objects' entries, gathers the local top k of each list and resolves
   the whole scores of those objects alone; the k-th best whole score of a query over all
   tasks is a safe cutoff: at least k objects reach it;
2. the cutoffs are broadcast. An object can only reach cutoff T if one of its list
   entries is at least T / lists, so each task collects its entries from that value on
   (partial scores may be negative; the sum argument does not need a sign);
3. the collected objects' remaining entries are resolved exactly and each task passes on
   its best k that reach the cutoff; a rank inside (query, task group) and then over the
   query's survivors ends the search.

Queries come in blocks of ``block_queries`` rows, so what is broadcast is bounded
(block_queries x dimensions integers and as many cutoffs); candidates are never shuffled.

Defined results: each component is floor(1024 * x) of x as double. Vectors that are null,
or hold a null or a non-finite component, take no part. Vectors of different lengths are
compared on their common components. Ties go to the smaller id; equal rows are separate
candidates; a row is no candidate of a query with its own id. An empty table gives an
empty frame.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """(vec_id, q array<double>): whole-number components of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.where(good & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("q")))


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column padded with zeros (or cut) to ``dims`` columns."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    lens = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    if len(lens) and (lens == dims).all():
        return flat.reshape(len(lens), dims)
    out = np.zeros((len(lens), dims))
    at = 0
    for i, n in enumerate(lens):
        out[i, :min(n, dims)] = flat[at:at + min(n, dims)]
        at += n
    return out


def _dot(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products (queries x rows): int64, or Python integers where they may outgrow 53 bits."""
    if q.size == 0 or x.size == 0:
        return np.zeros((len(q), len(x)), dtype=np.int64)
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < 2.0 ** 53:
        return (q @ x.T).astype(np.int64)
    qi = np.array([[int(v) for v in r] for r in q], dtype=object)
    xi = np.array([[int(v) for v in r] for r in x], dtype=object)
    return qi @ xi.T


TOP = (1 << 63) - 1


def resolved(parts: list[np.ndarray], i: int, at: np.ndarray) -> np.ndarray:
    """Whole scores of query ``i`` for the rows ``at``: the list entries are added before anything is cut to 64 bits."""
    total = sum(p[i][at].astype(object) if p.dtype == object else p[i][at] for p in parts)
    return np.array([max(-TOP - 1, min(TOP, int(v))) for v in total], dtype=np.int64) if total.dtype == object else total


def _slices(dims: int, lists: int) -> list[slice]:
    edges = [dims * k // lists for k in range(lists + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False) if a < b]


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of one query, ties to the smaller id."""
    if score.dtype == object:
        return np.array(sorted(range(len(score)), key=lambda j: (-score[j], ids[j]))[:k], dtype=np.int64)
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out, strict=True) if out else ((), (), ()))]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])


def _top_of(found: DataFrame, k: int, *extra: Column) -> DataFrame:
    w = Window.partitionBy("query_id", *extra).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search_block(data: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, lists: int) -> DataFrame:
    """The top k of one bounded block of queries against all rows of ``data``."""
    spark, dims = data.sparkSession, queries.shape[1]
    cuts = _slices(dims, lists)
    block = spark.sparkContext.broadcast((ids, queries))

    def local_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q = block.value
        for b in batches:
            vid, x = b.column(0).to_numpy(), _matrix(b.column(1), dims)
            parts = [_dot(q[:, s], x[:, s]) for s in cuts]
            out = []
            for i in range(len(qid)):  # whole scores of the lists' heads only
                near = {int(j) for p in parts for j in _best(p[i], vid, k + 1)}
                at = np.array([j for j in sorted(near) if vid[j] != qid[i]], dtype=np.int64)
                score = resolved(parts, i, at)
                best = _best(score, vid[at], k)
                out.append((np.full(len(best), qid[i]), vid[at][best], score[best]))
            yield _rows(out)

    found = _top_of(data.mapInArrow(local_lists, "query_id long, vec_id long, score long"), k)
    cutoffs = found.groupBy("query_id").agg(F.min("score").alias("t"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    low = {r["query_id"]: r["t"] for r in cutoffs.collect()}  # one row per query of the block
    sent = spark.sparkContext.broadcast(np.array([low.get(int(i), np.iinfo(np.int64).min) for i in ids], dtype=np.int64))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (qid, q), least = block.value, sent.value
        for b in batches:
            vid, x = b.column(0).to_numpy(), _matrix(b.column(1), dims)
            parts = [_dot(q[:, s], x[:, s]) for s in cuts]
            out = []
            for i in range(len(qid)):
                seen = np.zeros(len(vid), dtype=bool)
                for p in parts:  # p >= T / lists, in whole numbers
                    seen |= (p[i] >= -((-int(least[i])) // len(cuts))).astype(bool)
                at = np.flatnonzero(seen & (vid != qid[i]))
                score = resolved(parts, i, at)  # of the collected objects only
                at, score = at[score >= least[i]], score[score >= least[i]]
                best = _best(score, vid[at], k)
                out.append((np.full(len(best), qid[i]), vid[at][best], score[best]))
            yield _rows(out)

    survivors = data.mapInArrow(entries, "query_id long, vec_id long, score long")
    return _top_of(survivors, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, lists: int = 4, id_col: str = "vec_id",
          vector_col: str = "embedding", block_queries: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of every query row.

    Equal ids among the queries count as one query each id and vector; rows of the same
    id are ranked together.
    """
    spark = vectors.sparkSession
    data = quantised(vectors, id_col, vector_col)
    asked = quantised(vectors.where(is_query), id_col, vector_col).distinct()
    out, ids, rows = None, [], []

    def search():
        nonlocal out, ids, rows
        dims = max(len(r) for r in rows)
        q = np.zeros((len(rows), max(1, dims)))
        for i, r in enumerate(rows):
            q[i, :len(r)] = r
        part = search_block(data, np.array(ids, dtype=np.int64), q, k, lists)
        out = part if out is None else out.unionByName(part)
        ids, rows = [], []

    for r in asked.toLocalIterator():  # a block of queries at a time
        ids.append(r["vec_id"])
        rows.append(r["q"])
        if len(rows) >= block_queries:
            search()
    if rows:
        search()
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
