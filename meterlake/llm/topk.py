"""Exact top-k search by inner product with a three-phase uniform threshold.

A score is the sum of the scores on two parts of the vector.  The first part's is computed for all pairs of a query and a row; the
second part's only where it can matter.  For a block of queries:

1. every task takes, for each query, the k best rows by the first part of each step of rows, resolves their whole scores, and
   reports the k best (a local score list); the k-th best over all tasks is a safe cutoff, since k rows reach it;
2. the cutoffs are broadcast; the second part adds at most the product of the lengths of both vectors there, so the entries that
   reach the cutoff with that added are sufficient, and every other row is done with its first part;
3. the second parts of the sufficient entries are added exactly, and the best k per query are merged.

Queries come in blocks of bounded size against all rows; scores are not emitted but for the best k of a task and query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.sources.staging import stage

QUERY_BLOCK = 4096
ROW_STEP = 4096
PAIRS_AT_ONCE = 100_000  # second parts gathered and multiplied together
DENSE = 8  # from one in so many pairs on, second parts are computed as a whole matrix
_EXACT = float(1 << 53)
_LARGEST = float(1 << 63)


def quantised(vector: str = "embedding", scale: int = 256) -> Column:
    """floor(scale * x) of each component as bigint; null if the vector is null, empty, or has a null or non-finite component."""
    x = F.col(vector).cast("array<double>")
    fine = F.expr(f"forall(CAST({vector} AS array<double>), v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) <= 1.7976931348623157E308D)")
    return F.when(fine & (F.size(x) > 0), F.transform(x, lambda v: F.floor(v * scale)))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros, longer ones are cut, which no product with a query can notice."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < width
    out[row[inside], place[inside]] = flat[inside]
    return out


def _most(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products: in floating point where every sum is exact, else in 64 bits; raises where those might not do."""
    if (most := _most(a, b)) >= _LARGEST:
        raise ValueError("components too large: scores may leave 64 bits")
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if most < _EXACT else a @ b.T


def _rest(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Scores of the second parts of the pairs (q, r)."""
    if len(q) * DENSE >= len(queries) * len(rows):
        return _product(queries, rows)[q, r]
    if _most(queries, rows) >= _LARGEST:
        raise ValueError("components too large: scores may leave 64 bits")
    out = np.empty(len(q), np.int64)
    for lo in range(0, len(q), PAIRS_AT_ONCE):
        some = slice(lo, lo + PAIRS_AT_ONCE)
        out[some] = np.einsum("ij,ij->i", queries[q[some]], rows[r[some]])
    return out


def _lengths(part: np.ndarray) -> np.ndarray:
    """Euclidean lengths, rounded up."""
    return np.sqrt((part.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)


_NEVER = np.iinfo(np.int64).min


def _steps(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROW_STEP):
            part = batch.slice(lo, ROW_STEP)
            yield part.column(0).to_numpy(), _matrix(part.column(1), width)


def _local_lists(shared, k: int):
    """Phase 1: (query, score), the k best whole scores among the rows that lead the first part."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        half = queries.shape[1] // 2
        best = np.full((len(ids), k), _NEVER)
        for names, rows in _steps(batches, queries.shape[1]):
            part = np.where(ids[:, None] == names[None, :], _NEVER, _product(queries[:, :half], rows[:, :half]))
            lead = np.argpartition(part, max(0, len(names) - k), axis=1)[:, -k:]
            q, r = np.repeat(np.arange(len(ids)), lead.shape[1]), lead.reshape(-1)
            own = ids[q] == names[r]
            found = np.full(len(q), _NEVER)
            found[~own] = part[q[~own], r[~own]] + _rest(queries[:, half:], rows[:, half:], q[~own], r[~own])
            best = np.sort(np.concatenate([best, found.reshape(lead.shape)], axis=1), axis=1)[:, -k:]
        q, j = np.nonzero(best > _NEVER)
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(best[q, j])], ["q", "score"])

    return gather


def _sufficient(shared, cutoffs, k: int):
    """Phases 2 and 3 in a task: entries that may reach the cutoff by their first part, their whole scores, the best k per query."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        cutoff, half = cutoffs.value, queries.shape[1] // 2
        reach = _lengths(queries[:, half:])
        held = [np.zeros(0, np.int64) for _ in range(3)]
        for names, rows in _steps(batches, queries.shape[1]):
            part = _product(queries[:, :half], rows[:, :half])
            enough = part + np.multiply.outer(reach, _lengths(rows[:, half:])) + 1 >= cutoff[:, None]
            q, r = np.nonzero(enough & (ids[:, None] != names[None, :]))
            score = part[q, r] + _rest(queries[:, half:], rows[:, half:], q, r)
            fine = score >= cutoff[q]
            held = [np.concatenate(x) for x in zip(held, (q[fine], score[fine], names[r[fine]]))]
            order = np.lexsort((held[2], -held[1], held[0]))
            held = [x[order] for x in held]
            first = np.searchsorted(held[0], held[0])
            held = [x[np.arange(len(first)) - first < k] for x in held]
        yield pa.RecordBatch.from_arrays([pa.array(ids[held[0]]), pa.array(held[2]), pa.array(held[1])], ["query_id", "vec_id", "score"])

    return collect


def top_k(rows: DataFrame, is_query: str, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k highest scores (all, if fewer), ties to the smaller vec_id.

    is_query: SQL condition on vec_id.  Candidates are all rows with another vec_id than the query's.  Rows with a null id, or a
    null vector or component, or one that is not finite, take no part; scores are 64-bit, and components so large that a score
    might not fit raise.  A query id that repeats asks once, with
    the smallest of its vectors; as candidates all repeats count.  Vectors of unequal length multiply over their common part.
    """
    spark = rows.sparkSession
    usable = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), quantised(vector).alias("v")).dropna()
    usable = stage(usable, "vectors")
    asked = usable.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() * 5 // (4 * query_block)))
    out = None
    for b in range(blocks):
        table = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow().combine_chunks()
        if not table.num_rows:
            continue
        lists = table.column("v").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        width = int(np.diff(lists.offsets.to_numpy()).max())
        queries = table.column("vec_id").to_numpy(), _matrix(lists, width)
        shared = spark.sparkContext.broadcast(queries)
        lists = usable.mapInArrow(_local_lists(shared, k), "q int, score bigint")
        ranked = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
        kth = lists.withColumn("rank", ranked).where(F.col("rank") <= k).groupBy("q").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
        cutoff = np.full(len(queries[0]), -(1 << 62), np.int64)
        for r in kth.where(F.col("n") == k).collect():  # one number per query of the block
            cutoff[r.q] = r.score
        found = usable.mapInArrow(_sufficient(shared, spark.sparkContext.broadcast(cutoff), k), "query_id bigint, vec_id bigint, score bigint")
        best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        found = stage(found.withColumn("rank", best).where(F.col("rank") <= k), "found")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "query_id bigint, vec_id bigint, score bigint, rank int")
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
