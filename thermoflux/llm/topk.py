"""Exact top-k by inner product: columnar branch and bound (operator 5).

Vectors are dealt into bounded groups of candidates and bounded blocks of queries; every
(query block, candidate group) pair is one task's work.  In it the candidates lie in vertical
layout, one array per dimension.  Scores accumulate dimension block by dimension block; after
each block a candidate's score is bounded by the lengths of what remains of both vectors
(Cauchy-Schwarz), candidates whose upper bound is below the k-th best lower bound go, and the
survivors are compacted.  Each task gives at most k rows for a query; the last step keeps the
best k of them.  No vector set is broadcast; the number of groups follows the row counts.

Defined cases: vectors that are null, or hold null or non-finite components, take no part,
nor do those whose length differs from the query's; a null ``vec_id`` is never a query, and
as a candidate comes after all others at equal score; ties go to the smaller ``vec_id``;
every row but the query's own row is a candidate, those that repeat its id or vector included;
each query row is answered by itself, so a repeated id has an answer for each of its rows; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermoflux.llm.common import written

#: Rows in a candidate group, queries in a query block, dimensions in a block.
GROUP_ROWS, BLOCK_QUERIES, DIM_BLOCK = 16_384, 1_024, 8


def quantised(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v array<bigint>): floor(scale * x) of the usable vectors."""
    x = vectors[column].cast("array<double>")
    usable = vectors[column].isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(usable).select(vectors[id_col].cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))


def best_of(queries: np.ndarray, own: np.ndarray, columns: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, block: int = DIM_BLOCK):
    """Yield (query number, candidate places) of each query's best ``k`` in one group.

    ``columns`` is dims x candidates; ``own`` and ``rows`` are row numbers of queries and
    candidates.  Products of integers below 2**26 in up to 2**26 sum are exact in doubles;
    bounds carry a small slack, so pruning never loses a tie."""
    dims, n = columns.shape
    edges = [*range(0, dims, block), dims]
    squares = columns.astype(np.float64) ** 2
    left = [np.sqrt(squares[a:].sum(axis=0)) for a in edges]  # length of each candidate from this dimension on
    for number, (q, q_row) in enumerate(zip(queries, own, strict=True)):
        alive = np.flatnonzero(rows != q_row)
        score = np.zeros(len(alive))
        for step, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            part = columns[a:b] if len(alive) == n else columns[a:b, alive]
            score = score + q[a:b] @ part
            if b < dims and len(alive) > k:
                slack = np.sqrt((q[b:] ** 2).sum()) * left[step + 1][alive] * (1 + 1e-9) + 1e-6
                floor = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                keep = score + slack >= floor
                if keep.sum() < 0.8 * len(alive):
                    alive, score = alive[keep], score[keep]
        order = np.lexsort((ids[alive], -score))[:k]
        yield number, alive[order], score[order]


def top_k(vectors: DataFrame, asked: Column, k: int = 5, group_rows: int = GROUP_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the best ``k`` rows of ``vectors`` (vec_id long,
    v array<bigint>) for each of its rows that ``asked`` picks."""
    number = F.monotonically_increasing_id()
    held = written(vectors.select("vec_id", "v", number.alias("row")), "vectors")
    queries = written(held.where(F.col("vec_id").isNotNull() & asked), "queries")
    groups = max(1, -(-held.count() // group_rows))
    blocks = max(1, -(-queries.count() // block_queries))
    # A row number inside its partition deals rows evenly whatever their values are.
    left = (queries.select("vec_id", "v", "row", F.pmod(number, F.lit(blocks)).alias("b"))
            .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    right = (held.select("vec_id", "v", "row", F.pmod(number, F.lit(groups)).cast("int").alias("g"))
             .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))))

    def work(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_row", "query_id", "vec_id", "score"]
        out = [pd.DataFrame({name: pd.array([], "Int64") for name in columns})]
        for dims, qs in q.groupby(q.v.map(len)):
            cs = c[c.v.map(len) == dims]
            if not len(cs):
                continue
            missing = cs.vec_id.isna().to_numpy()
            last = np.iinfo(np.int64).max
            ids = cs.vec_id.astype("Int64").fillna(last).to_numpy(np.int64)
            layout = np.ascontiguousarray(np.stack(cs.v.to_list()).astype(np.float64).T).reshape(dims, len(cs))
            own, own_id = qs.row.to_numpy(), qs.vec_id.to_numpy()
            for i, places, score in best_of(np.stack(qs.v.to_list()).astype(np.float64).reshape(len(qs), dims), own, layout, ids, cs.row.to_numpy(), k):
                found = pd.array(ids[places], "Int64")
                found[missing[places]] = pd.NA
                out.append(pd.DataFrame({"query_row": own[i], "query_id": own_id[i], "vec_id": found, "score": score.astype(np.int64)}))
        return pd.concat(out)[columns]

    found = left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInPandas(work, "query_row long, query_id long, vec_id long, score long")
    rank = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
