"""Exact top-k search by inner product, with bounds from segment statistics at several resolutions.

A vector is cut into segments; of each segment the mean and the deviation are kept. For one segment of
length n the inner product of two vectors is n m m' plus that of their remainders, which by Cauchy and
Schwarz is at most n s s'. Summed over the segments this bounds the inner product from above, and with
the lengths of the vectors the distance from below. One segment is coarse and cheap, many are fine:
candidates fall level by level where the bound cannot reach the query's k-th best score so far, and
exact scores are computed for what survives all levels.

Queries and candidates go in blocks of bounded size; a task meets one block of queries with one block
of candidates and gives out at most k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP = 5
QUERY_BLOCK = 1024
BLOCK = 4096
LEVELS = (1, 4, 16)
#: Bounds are sums of doubles; this share of their size is added so that rounding never hides a match.
SLACK = 1e-9


def quantized(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector: each component x becomes floor(scale * x). Vectors that are null, empty, have no
    id, or hold a null or non-finite component take no part."""
    values = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    limit = F.lit(float("inf"))
    whole = F.forall("values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), values.alias("values"))
        .filter(F.col("vec_id").isNotNull() & F.col("values").isNotNull() & (F.size("values") > 0) & whole)
        .select("vec_id", F.transform("values", lambda x: F.floor(x * scale)).alias("vector"))
    )


def _packed(vectors: DataFrame, block: int) -> DataFrame:
    """One row per block: size (of its vectors), part, ids and the vectors as one list, in order of id.

    Blocks are dealt by a hash of the id, so a source or a group of equal vectors spreads over all.
    """
    total = vectors.count()
    parts = max(-(-total // block), 1)
    dealt = vectors.select(
        F.size("vector").alias("size"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("part"), "vec_id", "vector"
    )
    rows = F.sort_array(F.collect_list(F.struct("vec_id", "vector")))
    return dealt.groupBy("size", "part").agg(rows.alias("rows"))


def _matrix(rows: pa.StructArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    vectors = rows.field("vector")
    first, last = vectors.offsets[0].as_py(), vectors.offsets[len(vectors)].as_py()
    return rows.field("vec_id").to_numpy(), vectors.values.slice(first, last - first).to_numpy().reshape(-1, size)


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, weighted so that a dot product is the bound."""
    edges = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    parts = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        piece = vectors[:, low:high]
        parts += [piece.mean(axis=1) * (high - low) ** 0.5, piece.std(axis=1) * (high - low) ** 0.5]
    return np.stack(parts, axis=1)


def best_in_block(queries, query_ids, vectors, ids, k: int, levels=LEVELS):
    """(query row, candidate row, score) of the k best candidates of each query, itself excluded."""
    small = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0))
    exact = float(small) ** 2 * max(vectors.shape[1], 1) < 2.0**53  # products and sums are whole doubles
    q, v = queries.astype(np.float64), vectors.astype(np.float64)
    found = []
    stats = [(_statistics(q, level), _statistics(v, level)) for level in levels]
    lengths = np.sqrt((v * v).sum(axis=1))

    def scores(row: int, at: np.ndarray) -> np.ndarray:
        if exact:
            return (v[at] @ q[row]).astype(np.int64)
        return vectors[at] @ queries[row]

    for row in range(len(queries)):
        slack = SLACK * (1 + np.sqrt((q[row] ** 2).sum()) * lengths)
        alive = np.flatnonzero(ids != query_ids[row])
        floor = -np.inf
        for mine, theirs in stats:
            bound = theirs[alive] @ mine[row]
            if floor == -np.inf and len(alive) > k:  # exact scores of the most promising set the floor
                likely = alive[np.argpartition(-bound, k)[: 4 * k]]
                floor = np.sort(scores(row, likely))[-k]
            alive = alive[bound + slack[alive] >= floor]
        score = scores(row, alive)
        order = np.lexsort((ids[alive], -score))[:k]
        found.append((np.full(len(order), row), alive[order], score[order]))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _search(k: int, levels: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                size = batch.column("size")[i].as_py()
                query_ids, queries = _matrix(batch.column("queries")[i].values, size)
                ids, vectors = _matrix(batch.column("rows")[i].values, size)
                row, at, score = best_in_block(queries, query_ids, vectors, ids, k, levels)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[row]), pa.array(ids[at]), pa.array(score)], ["query_id", "vec_id", "score"]
                )

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, block: int = BLOCK, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k candidates with the largest inner product.

    Both inputs are (vec_id, vector of long), as ``quantized`` gives them. Candidates are all rows but
    those with the query's id, of the query's length; fewer than k give all. Ties go to the smaller
    vec_id. Rows that repeat an id are candidates each; a query id that repeats is asked once, by its
    smallest vector. Scores beyond a long wrap around. No rows give no rows.
    """
    asked = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = _packed(asked, QUERY_BLOCK).select("size", F.col("part").alias("asked"), F.col("rows").alias("queries"))
    # every block of candidates meets every block of queries: one row per pair of blocks, not of rows
    pairs = _packed(vectors, block).join(blocks, "size").repartition("size", "part", "asked")
    best = pairs.select("size", "queries", "rows").mapInArrow(_search(k, levels), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
