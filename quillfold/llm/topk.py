"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Queries are sparse rows of (term, weight); candidates are cut into blocks, and each block's postings are its columns:
the candidates and weights of one term. For a block, every query takes its terms one at a time and adds
weight times posting into a dense array of scores (by slice where a posting names every candidate, by scatter where
it does not). The best k of the array are picked by partition and only they leave the block; a final ranking a query
merges blocks x k rows. Queries and candidates meet by block numbers: query blocks of QUERY_BLOCK against candidate
blocks of ROW_BLOCK, so a task holds one of each at a time, however many there are.

Cases: vectors that are null, empty or hold a null or non-finite component take no part; vectors of unlike length
meet on the terms that both have; ties go to the smaller vec_id; repeated rows of a vec_id are candidates each, and
none is a candidate of a query of the same vec_id; a null vec_id takes no part; components beyond 2^31 after
quantising are no valid input; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048
ROW_BLOCK = 8192
#: Postings under this share of a block's rows are scattered.
SPARSE = 0.3


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = np.asarray(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(n), int(n.max()) if len(n) else 0), np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def accumulate(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of each query (a dense int64 array of rows each), term by term."""
    out = np.zeros((len(queries), len(rows)), np.int64)
    for t in range(min(queries.shape[1], rows.shape[1])):
        posting = np.flatnonzero(rows[:, t])
        asked = np.flatnonzero(queries[:, t])
        weights = np.ascontiguousarray(rows[:, t])
        if len(posting) >= SPARSE * len(rows):
            for q in asked.tolist():
                out[q] += queries[q, t] * weights
        elif len(posting):
            weights = weights[posting]
            for q in asked.tolist():
                out[q, posting] += queries[q, t] * weights
    return out


def _best(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    ids, own = right["id"].to_numpy(), left["id"].to_numpy()
    parts = [[], [], []]
    if len(ids) and len(own):
        order = np.argsort(ids, kind="stable")
        ids, rows, queries = ids[order], _matrix(right["v"])[order], _matrix(left["v"])
        for at in range(0, len(own), 128):
            scores = accumulate(queries[at : at + 128], rows)
            for q, s in zip(own[at : at + 128], scores, strict=True):
                s[ids == q] = np.iinfo(np.int64).min
                cut = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else np.iinfo(np.int64).min
                pick = np.flatnonzero((s >= cut) & (ids != q))
                pick = pick[np.lexsort((ids[pick], -s[pick]))[:k]]
                for p, x in zip(parts, (np.full(len(pick), q), ids[pick], s[pick]), strict=True):
                    p.append(x)
    made = [pa.array(np.concatenate(p) if p else np.zeros(0, np.int64), pa.int64()) for p in parts]
    return pa.table(made, names=["query_id", "vec_id", "score"])


def search(rows: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of rows (id, v) for each of queries (id, v), not itself. v: array of long."""
    nq, n = queries.count(), rows.count()
    qb, rb = max(1, -(-nq // QUERY_BLOCK)), max(1, -(-n // ROW_BLOCK))

    def block(column: Column, many: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(many)).cast("int")

    asked = queries.select(block(F.col("id"), qb).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(rb - 1))).alias("rb"), "id", "v")
    held = rows.select(F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("qb"), F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(rb)).cast("int").alias("rb"), "id", "v")
    best = asked.groupBy("qb", "rb").cogroup(held.groupBy("qb", "rb")).applyInArrow(partial(_best, k=k), "query_id long, vec_id long, score long")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """id and v: floor(scale * x) of each component of the valid vectors."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    valid = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad)
    return valid.select(F.col("vec_id").cast("long").alias("id"), F.transform(x, lambda e: F.floor(e * scale).cast("long")).alias("v"))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Queries: the distinct rows whose vec_id is divisible by every; candidates: all rows."""
    rows = quantised(vectors)
    return search(rows, rows.where(F.col("id") % every == 0).dropDuplicates(["id"]), k)
