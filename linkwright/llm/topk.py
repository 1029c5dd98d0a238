"""Exact top-k inner products by columnar branch and bound (operator 8).

Vectors are turned into integers, so scores are exact.  Queries go out in blocks of a
fixed size; each task holds its candidates in vertical layout, dimension by dimension,
and adds up partial products one block of dimensions after the other, largest query
components first.  What the rest of the dimensions can still add is at most the product
of the remaining norms (Cauchy-Schwarz), so after each block the candidates whose bound
is below the k-th best score known for the query are dropped and the others compacted.
The first candidates of a task are scored whole to have such a score at all.  Tasks
send their k best for each query, and a second step keeps the k best of all.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkwright.llm.common import stage, table

K = 5
SCALE = 256
QUERY_BLOCK = 2048
#: Candidates in one vertical block.
CANDIDATES = 16_384
DIMENSIONS = 16
SEEDS = 256
#: Sums below this are exact in doubles.
EXACT = 1 << 53


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the array of floor(scale * x) as doubles, which hold it exactly at any size; vectors that can't take part are left out."""

    def whole(e):
        y = e.cast("double") * float(scale)
        return F.when(F.abs(y) < float(EXACT), F.floor(y).cast("double")).otherwise(y)  # larger ones are whole

    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double") * float(scale)) < float("inf")))
    return vectors.where(x.isNotNull() & F.col("vec_id").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, whole).alias("v"),
    )


def _matrix(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of this length as rows, and which rows of the batch they are."""
    sizes = np.diff(column.offsets.to_numpy())
    which = np.flatnonzero(sizes == dimensions)
    flat = column.filter(pa.array(sizes == dimensions)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dimensions).astype(np.float64), which


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray):
    """(query, id, score) of what can be among the k best; floor: a k-th best score known so far, or -inf.

    rows are candidates.  Scores are sums of whole numbers; if any partial sum could leave the
    range in which doubles are exact, they are counted in unbounded integers instead.
    """
    n, d = rows.shape
    if n and len(queries) and float(np.abs(rows).max()) * float(np.abs(queries).max()) * d >= EXACT:
        return _best_of_large(queries, query_ids, rows, ids, k)
    columns = np.ascontiguousarray(rows.T)
    squares = columns**2
    norms = squares.sum(axis=0)
    out_q, out_i, out_s = [], [], []
    seeds = min(n, SEEDS)
    whole = queries @ columns[:, :seeds]  # exact scores of the first candidates
    order_q = np.argsort(-np.abs(queries), axis=1, kind="stable")
    for q in range(len(queries)):
        known = whole[q][ids[:seeds] != query_ids[q]]
        least = floor[q]
        if len(known) >= k:
            least = max(least, np.partition(known, len(known) - k)[len(known) - k])
        dims = order_q[q]
        partial = np.zeros(n)
        left = norms
        alive = np.arange(n)
        for at in range(0, d, DIMENSIONS):
            use = dims[at : at + DIMENSIONS]
            if len(alive) == n:
                partial = partial + queries[q, use] @ columns[use]
                left = left - squares[use].sum(axis=0)
            else:
                part = columns[np.ix_(use, alive)]
                partial = partial + queries[q, use] @ part
                left = left - (part**2).sum(axis=0)
            rest = float((queries[q, dims[at + DIMENSIONS :]] ** 2).sum())
            if at + DIMENSIONS < d and least > -np.inf:
                # a hair is added, as the roots are rounded
                stay = partial + np.sqrt(rest * np.maximum(left, 0)) * (1 + 1e-9) + 1e-6 >= least
                if not stay.all():
                    alive, partial, left = alive[stay], partial[stay], left[stay]
        other = ids[alive] != query_ids[q]
        alive, partial = alive[other], partial[other]
        if len(alive) > k:
            cut = np.partition(partial, len(partial) - k)[len(partial) - k]
            good = np.flatnonzero(partial >= cut)
            alive, partial = alive[good], partial[good]
            rank = np.lexsort((ids[alive], -partial))[:k]
            alive, partial = alive[rank], partial[rank]
        if len(partial) >= k:
            floor[q] = max(floor[q], partial.min())
        out_q += [int(query_ids[q])] * len(alive)
        out_i += ids[alive].tolist()
        out_s += partial.astype(np.int64).tolist()
    return out_q, out_i, out_s


def _best_of_large(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """best() with unbounded integers; a score beyond 64 bits counts as the nearest that 64 bits hold."""
    columns = [[int(x) for x in r] for r in rows.tolist()]
    out_q, out_i, out_s = [], [], []
    for q, v in zip(query_ids.tolist(), queries.tolist()):
        v = [int(x) for x in v]
        scored = [(-sum(a * b for a, b in zip(v, c)), i) for c, i in zip(columns, ids.tolist()) if i != q]
        scored = [(max(1 - (1 << 63), min((1 << 63) - 1, s)), i) for s, i in scored]
        for s, i in heapq.nsmallest(k, scored):
            out_q.append(q)
            out_i.append(i)
            out_s.append(-s)
    return out_q, out_i, out_s


def _search(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sent.value  # by number of dimensions: ids, matrix
        floors = {d: np.full(len(ids), -np.inf) for d, (ids, _) in blocks.items()}

        def found(d, ids, rows):
            q_ids, queries = blocks[d]
            out = best(queries, q_ids, rows, ids, k, floors[d])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

        held: dict[int, list] = {d: [] for d in blocks}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for d in blocks:
                rows, which = _matrix(batch.column(1), d)
                if len(rows):
                    held[d].append((ids[which], rows))
                if sum(len(i) for i, _ in held[d]) >= CANDIDATES:
                    yield found(d, np.concatenate([i for i, _ in held[d]]), np.concatenate([r for _, r in held[d]]))
                    held[d] = []
        for d, parts in held.items():
            if parts:
                yield found(d, np.concatenate([i for i, _ in parts]), np.concatenate([r for _, r in parts]))

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k highest inner products.

    vectors: vec_id, embedding; is_query: a condition on vec_id.  Every row but the
    query's own id is a candidate; ties go to the smaller vec_id.  Vectors that are null,
    or hold a null or non-finite component, or have no vec_id take no part; vectors of
    another length are no candidates of a query.  Rows that repeat a vec_id count as one
    candidate or query each, but a repeated query is answered once, by its
    best scores.  Without queries or candidates the result is empty.  Scores beyond 64 bits
    count as the nearest number that 64 bits hold.

    Queries go out `block` at a time.  If there are more, the best of each block are written
    to the shared folder and its broadcast is destroyed before the next goes out.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, scale)
    asked = rows.where(is_query)
    blocks = -(-asked.count() // block)
    parts = []
    for part in range(blocks):
        by_size: dict[int, list] = {}
        for r in asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == part).collect():  # about `block` queries
            by_size.setdefault(len(r["v"]), []).append((r["vec_id"], r["v"]))
        sent = spark.sparkContext.broadcast(
            {d: (np.array([i for i, _ in q], dtype=np.int64), np.array([v for _, v in q], dtype=np.float64).reshape(-1, d)) for d, q in by_size.items()}
        )
        found = rows.mapInArrow(_search(sent, k), "query_id long, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if blocks == 1:
            return found
        parts.append(stage(found, "best"))
        sent.destroy()
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, parts)


def op8_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The five best of each query; see top_k() for vectors that take no part, repeated rows and an empty table."""
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


OP8_SQL = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), dims AS (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM q
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM dims a JOIN dims b ON a.d = b.d AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
  GROUP BY 1, 2
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
