"""Hard negatives: rows of another label that score just below a row of the anchor's own.

Pairs of an anchor and another row get a key of (anchor, descending score, side, id).  They are
repartitioned by anchor and sorted within partitions by the whole key, in one shuffle; a task
then reads them as a stream.  A row of the anchor's label opens a window that reaches from its
score down to a share of it, rows of other labels are emitted into every window still open, and
a window closes when it is full or the scores have fallen below it.  No anchor's pairs are ever
held together: the state is the open windows, of which there are no more than positives.

Not every pair is shuffled.  Anchors meet all rows block by block, as products of matrices, in
two rounds.  The first returns each anchor's best rows of its own label in each block, from which
the stream takes its positives.  The second knows their scores, and so returns from a block only
the best rows that fall into each window; what it leaves out cannot be among the first of any.
So a block returns no more pairs for an anchor than the result may hold, however many rows tie
or repeat, and none is lost.

The anchors are a stated set of queries.  Rows whose label or vector is null, whose vector is
empty, or that hold null or non-finite components take no part; vectors of different length have
no product.  A row is never its own partner; rows that share a key are different rows, each an
anchor of its own.  Ties go to the smaller key, null keys last.  Scores are whole numbers, beyond
62 bits the nearest.  An empty table gives an empty result.  Only key, label and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialise

SCALE = 256
BLOCK_VALUES = 1 << 20  # components of a block of rows, and of a part of the anchors
MATRIX = 1 << 20  # scores computed at a time
EXACT = float(1 << 53)
MOST = 1 << 62
LEAST = np.iinfo(np.int64).min

POSITIVE, NEGATIVE = 0, 1


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exact also where doubles are not."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b).T, -MOST, MOST).astype(np.int64)


def firsts(scores: np.ndarray, able: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` best able scores; ties to the smaller column."""
    held = np.where(able, scores, LEAST)
    if k < held.shape[1]:
        able = able & (held >= np.partition(held, -k, axis=1)[:, -k][:, None])
    x, y = np.nonzero(able)
    order = np.lexsort((y, -held[x, y], x))
    x, y = x[order], y[order]
    starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    place = np.arange(len(x)) - np.repeat(starts, np.diff([*starts, len(x)]))
    return x[place < k], y[place < k]


def lowest(score: int, percent: int) -> int:
    """The least whole score of at least ``percent`` hundredths of a positive's."""
    return -(-percent * int(score) // 100)


def _prepared(df: DataFrame) -> DataFrame:
    """Rows that take part, with whole-number vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("vector").to_pylist()
            with np.errstate(all="ignore"):
                made = [np.floor(SCALE * np.array(v, np.float64)) if v and None not in v else None
                        for v in given]
            good = [i for i, v in enumerate(made) if v is not None and np.isfinite(v).all()]
            kept = batch.select(["row", "key", "label", "anchor"]).take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array([len(made[i]) for i in good], pa.int32()),
                 pa.array([made[i] for i in good], pa.list_(pa.float64()))],
                names=[*kept.schema.names, "dim", "vector"])

    return df.mapInArrow(run, f"row long, key {dict(df.dtypes)['key']}, label string, "
                              "anchor boolean, dim int, vector array<double>")


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["vector"].combine_chunks().flatten()
    return np.asarray(flat, np.float64).reshape(table.num_rows, -1)


def _meet(anchors: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of each anchor and block: the best positives or, for an anchor that brings the
    scores of its positives as ``windows``, the best negatives of each window."""
    second = "windows" in anchors.columns

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        theirs = theirs.take(pc.sort_indices(theirs["key"], null_placement="at_end"))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if mine.num_rows and theirs.num_rows:
            a, b = _matrix(mine), _matrix(theirs)
            both = pa.chunked_array([*mine["label"].chunks, *theirs["label"].chunks])
            labels = both.combine_chunks().dictionary_encode().indices.to_numpy()
            own, other = labels[:len(a)], labels[len(a):]
            a_row, b_row = mine["row"].to_numpy(), theirs["row"].to_numpy()

            def add(x: np.ndarray, y: np.ndarray, scores: np.ndarray, able: np.ndarray) -> None:
                at, to = firsts(scores, able, k)
                found.append((x[at], y[to], scores[at, to]))

            step = max(1, MATRIX // len(b))
            if second:
                windows = mine["windows"].to_pylist()
                for at in range(0, len(a), step):
                    x, y = np.arange(at, min(at + step, len(a))), np.arange(len(b))
                    scores = products(a[x], b)
                    apart = own[x, None] != other[None]
                    for w in range(max(len(windows[i]) for i in x)):
                        some = np.array([i for i in x if w < len(windows[i])], np.int64)
                        top = np.array([windows[i][w] for i in some], np.int64)
                        low = np.array([lowest(t, percent) for t in top], np.int64)
                        part = scores[some - at]
                        add(some, y, part, apart[some - at] & (part <= top[:, None])
                            & (part >= low[:, None]))
            else:
                for label in np.unique(own):
                    x, y = np.flatnonzero(own == label), np.flatnonzero(other == label)
                    for at in range(0, len(x) if len(y) else 0, step):
                        part = x[at:at + step]
                        add(part, y, products(a[part], b[y]),
                            a_row[part, None] != b_row[None, y])
        x, y, scores = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [
            np.zeros(0, np.int64)] * 3
        if second and len(x):  # windows overlap
            _, once = np.unique(x * theirs.num_rows + y, return_index=True)
            x, y, scores = x[once], y[once], scores[once]
        return pa.table({
            "anchor": mine["row"].take(pa.array(x)), "anchor_key": mine["key"].take(pa.array(x)),
            "score": pa.array(scores, pa.int64()),
            "side": pa.array(np.full(len(x), NEGATIVE if second else POSITIVE), pa.int32()),
            "key": theirs["key"].take(pa.array(y)), "row": theirs["row"].take(pa.array(y))})

    kind = dict(rows.dtypes)["key"]
    on = ["dim", "block", "part"]
    anchors = anchors.toDF(*anchors.columns).select(*[
        F.col(c).alias(c) for c in anchors.columns])  # both come from one table
    return anchors.groupBy(*on).cogroup(rows.groupBy(*on)).applyInArrow(
        run, f"anchor long, anchor_key {kind}, score long, side int, key {kind}, row long")


def _sorted(pairs: DataFrame) -> DataFrame:
    """The shuffle with its secondary sort: anchors apart, each from its highest score down."""
    return pairs.repartition("anchor").sortWithinPartitions(
        "anchor", F.desc("score"), "side", F.asc_nulls_last("key"), "row")


def _streamed(pairs: DataFrame, each, schema: str) -> DataFrame:
    """Run ``each(records)`` over the sorted pairs of a task, a batch of results at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.Field] = []

        def records() -> Iterator[tuple]:
            for batch in batches:
                types[:] = [batch.schema.field("key")]
                yield from zip(*(batch.column(name).to_pylist() for name in (
                    "anchor", "anchor_key", "score", "side", "key", "row")), strict=True)

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            keys = types[0].type
            kinds = {"key": keys, "int": pa.int32(), "long": pa.int64()}
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[k]) for c, k in zip(zip(*made, strict=True), shapes, strict=True)],
                names=names)

        made: list[tuple] = []
        for result in each(records()):
            made.append(result)
            if len(made) == 10_000:
                yield batch_of(made)
                made = []
        if made:
            yield batch_of(made)

    kind = dict(pairs.dtypes)["key"]
    names = [field.split()[0] for field in schema.split(", ")]
    shapes = [field.split()[1] for field in schema.split(", ")]
    typed = ", ".join(f"{n} {kind if s == 'key' else s}"
                      for n, s in zip(names, shapes, strict=True))
    return pairs.mapInArrow(run, typed)


def _first_positives(k: int):
    def each(records: Iterator[tuple]) -> Iterator[tuple]:
        last, taken = None, 0
        for anchor, anchor_key, score, _, key, row in records:
            if anchor != last:
                last, taken = anchor, 0
            if taken < k:
                taken += 1
                yield anchor, anchor_key, score, POSITIVE, key, row
    return each


def _windows(k: int, percent: int):
    def each(records: Iterator[tuple]) -> Iterator[tuple]:
        last, open_windows = None, []  # of (positive, its score, lowest score, emitted)
        for anchor, anchor_key, score, side, key, _ in records:
            if anchor != last:
                last, open_windows = anchor, []
            if side == POSITIVE:
                open_windows.append([key, score, lowest(score, percent), 0])
                continue
            open_windows = [w for w in open_windows if score >= w[2] and w[3] < k]
            for window in open_windows:
                window[3] += 1
                yield anchor_key, window[0], window[3], key, window[1], score
    return each


def mine(df: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5,
         percent: int = 80, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id`` and both scores.

    An anchor's positives are the best other rows of its label; the negatives of a positive are
    the best rows of other labels that score no more than it and at least ``percent`` hundredths
    of it.
    """
    spark = df.sparkSession
    rows = materialise(_prepared(df.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        label.cast("string").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.col(vector).alias("vector")).where("label IS NOT NULL")), "hardneg-rows")
    values, anchor_values = rows.agg(
        F.coalesce(F.sum("dim"), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("anchor"), F.col("dim"))), F.lit(0))).first()
    blocks = max(-(-values // BLOCK_VALUES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = max(1, -(-anchor_values // BLOCK_VALUES))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("row", F.lit("part")), F.lit(parts)).cast("int")

    dealt = rows.withColumn("block", block).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).drop("anchor")
    asking = rows.where("anchor").withColumn("part", part).drop("anchor")

    def everywhere(anchors: DataFrame) -> DataFrame:
        return anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    pair = "anchor long, anchor_key key, score long, side int, key key, row long"
    own = materialise(_streamed(
        _sorted(_meet(everywhere(asking), dealt, positives, percent)),
        _first_positives(positives), pair), "hardneg-positives")
    windows = own.groupBy(F.col("anchor").alias("row")).agg(
        F.collect_set("score").alias("windows"))  # no more than positives
    others = _meet(everywhere(asking.join(windows, "row")), dealt, negatives, percent)
    return _streamed(
        _sorted(own.union(others)), _windows(negatives, percent),
        "anchor_id key, positive_id key, rank int, negative_id key, positive_score long, "
        "negative_score long")
