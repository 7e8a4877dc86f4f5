"""Exact top-k inner products of query rows with all rows.

Rows are dealt into blocks by descending length.  A block of candidates meets a part of the
queries in one task, which goes through the candidates from the longest: where the product of
lengths cannot reach a query's k-th best score so far, the query is done with the block.
Otherwise products are summed over the first coordinates of a rotation by singular vectors,
and the rest is bounded by the lengths of the residuals (Cauchy-Schwarz).  What may still
reach the k-th best is scored exactly on whole numbers.

The first block, of the longest rows, gives every query its first bar; other blocks are met
only by queries whose length times the block's greatest could pass it.  Each query returns at
most k rows from a block.

Vectors that are null or hold null or non-finite components take no part; vectors of different
length have no product.  A row is never its own candidate, rows of equal key are each others'.
Ties go to the smaller key, null keys last; scores beyond 64 bits are cut to the nearest.  An
empty table gives an empty result.  Only the key and the vector are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hash_below, share, shared
from tidemark.sources.scratch import materialise

SCALE = 256
BLOCK = 4096
CHUNK = 256
HEAD = 16  # coordinates summed before the residual bound
SAMPLE = 20_000  # rows that the rotation is learned from
EXACT = float(1 << 53)


def rotation(rows: np.ndarray) -> np.ndarray:
    """Right singular vectors, the strongest first."""
    if not rows.size:
        return np.eye(rows.shape[1])
    rows = rows / max(float(np.abs(rows).max()), 1.0)  # products of very large values overflow
    return np.linalg.eigh(rows.T @ rows)[1][:, ::-1]


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole-number products, exact also where doubles are not."""
    most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1]
    if most < EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    out = whole(queries) @ whole(rows).T
    bound = np.iinfo(np.int64)
    return np.clip(out, int(bound.min), int(bound.max)).astype(np.int64)


def search(queries: np.ndarray, query_rows: np.ndarray, bars: np.ndarray, rows: np.ndarray,
           row_ids: np.ndarray, order: np.ndarray, turn: np.ndarray, k: int,
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and rows, and scores, of each query's best k; ``order`` ranks ties."""
    with np.errstate(all="ignore"):
        return _search(queries, query_rows, bars, rows, row_ids, order, turn, k)


def _search(queries, query_rows, bars, rows, row_ids, order, turn, k):
    lengths = np.linalg.norm(rows, axis=1)
    queue = np.argsort(-lengths, kind="stable")
    q_lengths = np.linalg.norm(queries, axis=1)
    q_turned, r_turned = queries @ turn, rows @ turn
    head = min(HEAD, turn.shape[1])
    q_rest = np.linalg.norm(q_turned[:, head:], axis=1)
    r_rest = np.linalg.norm(r_turned[:, head:], axis=1)
    bars = bars.astype(np.float64).copy()
    best = np.full((len(queries), k), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(queue), CHUNK):
        part = queue[at:at + CHUNK]
        slack = 1e-9 * q_lengths * lengths[part[0]] + 1e-3
        # Beyond what doubles hold a bound is not a number, and rules nothing out.
        live = np.flatnonzero(~(q_lengths * lengths[part[0]] + slack < bars))
        if not len(live):
            break  # the rest is shorter still
        bound = (q_turned[live, :head] @ r_turned[part, :head].T
                 + q_rest[live, None] * r_rest[None, part] + slack[live, None])
        may = ~(bound < bars[live, None])
        live, may = live[may.any(axis=1)], may[may.any(axis=1)]
        part, may = part[may.any(axis=0)], may[:, may.any(axis=0)]
        if not len(live):
            continue
        scores = _scores(queries[live], rows[part])
        may &= (scores >= bars[live, None]) & (query_rows[live, None] != row_ids[None, part])
        x, y = np.nonzero(may)
        found.append((live[x], part[y], scores[x, y]))
        kept = np.where(may, scores.astype(np.float64), -np.inf)
        both = np.concatenate([best[live], kept], axis=1)
        best[live] = -np.partition(-both, k - 1, axis=1)[:, :k]
        bars[live] = np.maximum(bars[live], best[live].min(axis=1))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    x, y, scores = (np.concatenate(c) for c in zip(*found, strict=True))
    ranked = np.lexsort((order[y], -scores.astype(object) if (scores == np.iinfo(
        np.int64).min).any() else -scores, x))
    x, y, scores = x[ranked], y[ranked], scores[ranked]
    starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    place = np.arange(len(x)) - np.repeat(starts, np.diff([*starts, len(x)]))
    return x[place < k], y[place < k], scores[place < k]


def _prepared(df: DataFrame) -> DataFrame:
    """Whole-number vectors with their length; unusable ones are left out."""
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            made = [np.floor(SCALE * np.array(v, np.float64)) if v is not None
                    and None not in v else None for v in table["vector"].to_pylist()]
            good = [i for i, v in enumerate(made) if v is not None and np.isfinite(v).all()]
            table = table.select(["row", "key", "query"]).take(pa.array(good, pa.int64()))
            yield from (table
                        .append_column("dim", pa.array([len(made[i]) for i in good], pa.int32()))
                        .append_column("vector", pa.array([made[i] for i in good],
                                                          pa.list_(pa.float64())))
                        .append_column("length", pa.array(
                            [float(np.linalg.norm(made[i])) for i in good], pa.float64()))
                        .to_batches())

    return df.mapInArrow(run, f"row long, key {dict(df.dtypes)['key']}, query boolean, "
                              "dim int, vector array<double>, length double")


def _meet(queries: DataFrame, rows: DataFrame, sent, k: int) -> DataFrame:
    """Each query's best k of each block it is sent to."""
    names = ["dim", "block", "part", "side", "row", "key", "vector", "bar"]
    key_type = rows.select("key").limit(0).toArrow().schema.field(0).type

    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        dim = table["dim"][0].as_py()
        vectors = np.asarray(table["vector"].combine_chunks().flatten(), np.float64).reshape(
            len(side), dim)
        ids = table["row"].to_numpy()
        mine, theirs = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        keys = table["key"]
        order = np.empty(len(side), np.int64)
        order[pc.sort_indices(keys, null_placement="at_end").to_numpy()] = np.arange(
            len(side))
        x, y, scores = search(vectors[mine], ids[mine], table["bar"].to_numpy()[mine],
                              vectors[theirs], ids[theirs], order[theirs], sent()[dim], k)
        return pa.table({
            "query_row": pa.array(ids[mine[x]], pa.int64()),
            "query_id": keys.take(pa.array(mine[x])).combine_chunks().cast(key_type),
            "vec_id": keys.take(pa.array(theirs[y])).combine_chunks().cast(key_type),
            "score": pa.array(scores, pa.int64())})

    kind = dict(rows.dtypes)["key"]
    return (queries.withColumn("side", F.lit(0)).select(*names)
            .union(rows.withColumn("side", F.lit(1)).withColumn("bar", F.lit(float("-inf")))
                   .select(*names))
            .groupBy("dim", "block", "part")
            .applyInArrow(run, f"query_row long, query_id {kind}, vec_id {kind}, score long"))


def _best(found: DataFrame, k: int) -> DataFrame:
    """Rows with equal scores and keys are alike, so any of them may be left out."""
    ranks = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)


def top_k(df: DataFrame, is_query: Column, k: int, key: str = "vec_id",
          vector: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``."""
    rows = _prepared(df.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        F.coalesce(is_query, F.lit(False)).alias("query"), F.col(vector).alias("vector")))
    rows = materialise(rows, "topk-rows")
    sizes = rows.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("query").alias("queries")).collect()
    turns = {}
    for dim, n, _ in sizes:
        chosen = rows.where((F.col("dim") == dim) & hash_below(share(sample, n), "row"))
        found = [v.as_py() for v in chosen.select("vector").limit(2 * sample).toArrow().column(0)]
        turns[dim] = rotation(np.array(found, np.float64).reshape(len(found), dim))
    blocks = max(1, -(-sum(s["n"] for s in sizes) // BLOCK))
    parts = max(1, -(-sum(s["queries"] for s in sizes) // BLOCK))
    sent = shared(df.sparkSession, turns)
    placed = materialise(
        rows.repartitionByRange(blocks, "dim", F.desc("length"), "row")
        .withColumn("block", F.spark_partition_id()), "topk-blocks")
    spans = placed.groupBy("dim", "block").agg(F.max("length").alias("longest"))
    first = spans.groupBy("dim").agg(F.min("block").alias("first"))
    spans = spans.join(first, "dim")  # a row for each block
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    dealt = placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    queries = placed.where("query").withColumn("part", part).drop("block")

    # Queries of a dimension that starts within a block begin with that block alone.
    opening = queries.join(first, "dim").select(
        "*", F.col("first").alias("block"), F.lit(float("-inf")).alias("bar"))
    begun = materialise(
        _meet(opening, dealt.join(first, "dim").where(F.col("block") == F.col("first")), sent, k),
        "topk-first")
    bars = _best(begun, k).where(F.col("rank") == k).select(
        F.col("query_row").alias("row"), F.col("score").cast("double").alias("bar"))
    later = (queries.join(bars, "row", "left").join(spans.where("block != first"), "dim")
             .withColumn("bar", F.coalesce("bar", F.lit(float("-inf"))))
             .where(F.col("length") * F.col("longest") * (1 + 1e-9) + 1e-3 >= F.col("bar")))
    found = begun.union(_meet(later, dealt.join(first, "dim").where("block != first"), sent, k))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
