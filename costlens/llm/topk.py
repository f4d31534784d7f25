"""Operator 5: exact top-k search by exhaustive term-at-a-time accumulation.

A vector's component x becomes floor(64 * x); queries are the rows whose vec_id
is divisible by 20, candidates all rows but the query's own; the score is the
integer inner product.  The 20 highest scores of each query are returned, ties
to the smaller vec_id.

Queries and candidates are dealt to blocks of bounded size by a hash of the id,
and every (query block, candidate block) pair is one cell, computed in one task.
In a cell each dimension is a term: its posting list holds the candidates whose
component is not zero, with their weights.  Term by term the postings are
scattered, times the queries' weights for the term, into a dense array of
scores (one column per query of a slice).  A partition selection then leaves 20
rows per query and cell, and a window over those merges the cells.  So a cell
sends at most 20 rows per query, and memory is bounded by the block sizes.

Scores are accumulated in 32 or 64 bits if the largest possible sum fits, else
in exact Python integers, clipped to the range of a long at the end.

Defined results: vectors that are null or hold null or non-finite components
take no part; vectors of different lengths meet in their common dimensions
(missing components are zero), empty vectors score 0; rows sharing a vec_id are
one vector, the smallest in array order; null ids take no part; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.common import Workspace

K = 20
SCALE = 64
QUERY_EVERY = 20
CANDIDATE_ROWS = 8192  # per block
QUERY_ROWS = 4096
SUB_ROWS = 1024  # candidates and queries whose scores are held at once in a cell
SLICE = 256

CELL_SCHEMA = "query_id long, vec_id long, score long"


def quantized(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): integer vectors of the rows that take part; floor stops at a long's ends."""
    x = embeddings["embedding"].cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = embeddings.select(
        embeddings["vec_id"].cast("long").alias("vec_id"), x.alias("x"), bad.alias("bad")
    )
    rows = rows.filter("vec_id is not null and x is not null and not bad")
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids in rising order and their vectors, zero-filled to one length."""
    ids = table["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    rows = table["v"].combine_chunks()
    sizes = np.diff(rows.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    out = np.zeros((len(ids), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = rows.flatten().to_numpy()
    return ids[order], out[order]


def _accumulate(postings: list, queries: np.ndarray, n: int, kind) -> np.ndarray:
    """Scores (candidate, query): every term's postings times the queries' weights."""
    scores = np.zeros((n, len(queries)), kind)
    for (places, weights), term in zip(postings, queries.T):
        if not len(places) or not term.any():
            continue
        if len(places) == n:  # a posting list without gaps needs no scatter
            scores += weights[:, None] * term
        else:
            scores[places] += weights[:, None] * term
    return scores


def _select(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) per row of ``scores`` (query, candidate); ids are rising."""
    n = scores.shape[1]
    if scores.dtype == object or n <= k:
        rank = np.arange(n)
        order = np.array([sorted(rank, key=lambda i, r=r: (-r[i], i))[:k] for r in scores])
        order = order.reshape(len(scores), -1).astype(np.int64)
    else:
        key = scores.astype(np.int64) * n + np.arange(n - 1, -1, -1)  # ties to smaller ids
        order = np.argpartition(-key, k - 1, axis=1)[:, :k]
    return np.take_along_axis(scores, order, axis=1), ids[order]


def _cell(queries: pa.Table, candidates: pa.Table) -> pa.Table:
    q_ids, q = _matrix(queries)
    c_ids, c = _matrix(candidates)
    width = min(q.shape[1], c.shape[1])
    q, c = q[:, :width], c[:, :width]
    largest = float(np.abs(q.astype(float)).max(initial=0)) * np.abs(c.astype(float)).max(initial=0)
    bound = largest * max(width, 1)
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**48 else object
    q, c = q.astype(kind), c.astype(kind)
    k = K + 1  # the query's own row may be among them
    blocks = []
    for at in range(0, len(c), SUB_ROWS):
        part = c[at : at + SUB_ROWS]
        postings = []
        for column in part.T:
            places = np.flatnonzero(column)
            if 2 * len(places) > len(part):  # mostly filled: keep the zeros too
                places = np.arange(len(part))
            postings.append((places, column[places]))
        blocks.append((c_ids[at : at + SUB_ROWS], postings))
    out = [[], [], []]
    for at in range(0, len(q), SLICE):
        some = q[at : at + SLICE]
        best = []
        for ids, postings in blocks:
            scores = np.ascontiguousarray(_accumulate(postings, some, len(ids), kind).T)
            if kind is object:  # exact sums, stopped at a long's ends before they are ranked
                scores = np.clip(scores, -(2**63), 2**63 - 1)
            best.append(_select(scores, ids, k))
        score = np.concatenate([s for s, _ in best], axis=1)
        ids = np.concatenate([i for _, i in best], axis=1)
        if kind is object:
            rank = range(score.shape[1])
            order = np.array(
                [sorted(rank, key=lambda i, r=r, x=x: (-r[i], x[i])) for r, x in zip(score, ids)]
            )
        else:
            order = np.lexsort((ids, -score.astype(np.int64)), axis=1)
        order = order[:, :k]
        score, ids = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)
        own = np.repeat(q_ids[at : at + SLICE], ids.shape[1]).reshape(ids.shape)
        keep = ids != own
        for column, values in zip(out, (own, ids, score)):
            column.append(values[keep].astype(np.int64))
    columns = [np.concatenate(x) for x in out]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))


def search(embeddings: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``K`` best candidates."""
    ws = Workspace(embeddings.sparkSession, "topk")
    vectors = ws.keep(quantized(embeddings), "vectors")
    is_query = F.col("vec_id") % QUERY_EVERY == 0
    total = vectors.agg(
        F.count("*").alias("rows"),
        F.count_distinct("vec_id").alias("ids"),
        F.count_if(is_query).alias("queries"),
    ).first()
    if total["ids"] < total["rows"]:  # rows sharing an id are one vector
        vectors = ws.keep(vectors.groupBy("vec_id").agg(F.min("v").alias("v")), "one-per-id")
    c_blocks = max(1, -(-total["rows"] // CANDIDATE_ROWS))
    q_blocks = max(1, -(-total["queries"] // QUERY_ROWS))

    def dealt(df, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias(own)
        return df.select(
            "vec_id", "v", block, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        )

    queries = dealt(vectors.filter(is_query), "qb", q_blocks, "cb", c_blocks)
    candidates = dealt(vectors, "cb", c_blocks, "qb", q_blocks)
    cells = (
        queries.groupBy("qb", "cb")
        .cogroup(candidates.groupBy("qb", "cb"))
        .applyInArrow(_guarded, CELL_SCHEMA)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = cells.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= K)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _guarded(queries: pa.Table, candidates: pa.Table) -> pa.Table:
    if not queries.num_rows or not candidates.num_rows:
        none = pa.array([], pa.int64())
        return pa.table({"query_id": none, "vec_id": none, "score": none})
    return _cell(queries, candidates)
