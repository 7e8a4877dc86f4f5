"""Near-duplicate vectors of one label, by iterative quantisation.

A rotation of the principal components is learned so that the signs of rotated vectors are
balanced and lose little; they give a vector's 64-bit code.  The code is cut into eight
bytes, each the key of one Hamming table: codes that differ in at most seven bits meet in a
table at least.  Vectors that meet are compared by cosine on the original values, in the
first table only where they do.  Exact copies are counted, not compared.

The rotation is learned on about ``SAMPLE`` vectors of a dimension, chosen by a hash; every
vector is indexed.  A full bucket is compared block by block, and no pairs are written out:
tasks return numbers of links and spanning links.

Vectors that are null, zero or empty, or hold null or non-finite components, and rows without
a label, link with nothing.  Vectors of different length are not compared.  Rows with equal
keys stay rows of their own.  A null key is passed over where a smallest key is sought.  An
empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hash_below, share, shared
from tidemark.llm.components import connected
from tidemark.sources.scratch import materialise

TABLES = 8
BITS = 8 * TABLES
SAMPLE = 20_000
TURNS = 40
BLOCK = 1024


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, safe for very large and very small values."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def learn(vectors: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The mean, and a projection to ``BITS`` values whose signs are the code.

    Principal directions are rotated by turns: signs for a fixed rotation, then the rotation
    that brings the projections closest to them.  Short vectors get several such rotations.
    """
    mean = vectors.mean(axis=0)
    centred = vectors - mean
    directions = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :BITS]
    random, parts = np.random.default_rng(seed), []
    while sum(p.shape[1] for p in parts) < BITS:
        projected = centred @ directions
        turn = np.linalg.qr(random.normal(size=(directions.shape[1],) * 2))[0]
        for _ in range(TURNS):
            signs = np.where(projected @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(projected.T @ signs)
            turn = u @ v
        parts.append(directions @ turn)
    return mean, np.concatenate(parts, axis=1)[:, :BITS]


def codes(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    bits = (vectors - mean) @ projection >= 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def usable(vector) -> F.Column:
    return (F.col(vector).isNotNull() & (F.size(vector) > 0)
            & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                       & (F.abs(x) < float("inf")))
            & F.exists(vector, lambda x: x != 0))


def _coded(classes: DataFrame, label: str, sent) -> DataFrame:
    """A row for each table: its byte of the code, the code and the vector."""
    names = [label, "dim", "cid", "weight", "vector", "code", "table", "bucket"]

    def run(batches):
        models = sent()
        for batch in batches:
            table = pa.Table.from_batches([batch])
            dims = table["dim"].to_numpy()
            for dim in np.unique(dims):
                part = table.filter(pa.array(dims == dim)).combine_chunks()
                found = part["vector"].chunk(0) if part["vector"].num_chunks else None
                rows = unit(np.asarray(found.flatten(), np.float64).reshape(-1, dim))
                code = codes(rows, *models[int(dim)])
                for t in range(TABLES):
                    made = part.append_column("code", pa.array(code.view(np.int64)))
                    made = made.append_column("table", pa.array([t] * len(code), pa.int32()))
                    bucket = (code >> np.uint64(8 * t)) & np.uint64(255)
                    made = made.append_column("bucket", pa.array(bucket.astype(np.int32)))
                    yield from made.select(names).to_batches()

    kinds = dict(classes.dtypes)
    return classes.select(label, "dim", "cid", "weight", "vector").mapInArrow(
        run, f"`{label}` {kinds[label]}, dim int, cid long, weight long, "
             f"vector {kinds['vector']}, code long, table int, bucket int")


def _compare(label: str, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        dim, t = table["dim"][0].as_py(), table["table"][0].as_py()
        block, first = table["block"].to_numpy(), table["low"][0].as_py()
        rows = unit(np.asarray(table["vector"].combine_chunks().flatten(), np.float64)
                    .reshape(-1, dim))
        code = table["code"].to_numpy().view(np.uint64)
        weights, classes = table["weight"].to_numpy(), table["cid"].to_numpy()
        links = rows @ rows.T >= threshold
        np.fill_diagonal(links, False)
        if table["high"][0].as_py() != first:  # two blocks: each was compared with itself
            links &= block[:, None] != block[None, :]
        at = np.nonzero(links)
        differ = code[at[0]] ^ code[at[1]]
        earlier = np.zeros(len(differ), bool)
        for before in range(t):
            earlier |= (differ >> np.uint64(8 * before)) & np.uint64(255) == 0
        links[at[0][earlier], at[1][earlier]] = False
        root = np.arange(len(rows))
        one, other = np.nonzero(links)
        while len(one):
            new = root.copy()
            np.minimum.at(new, one, root[other])
            new = new[new]
            if (new == root).all():
                break
            root = new
        counts = links @ weights
        linked = np.flatnonzero(counts)
        return pa.table({"cid": classes[linked], "links": counts[linked].astype(np.int64),
                         "root": classes[root[linked]]})

    return run


def near_duplicates(df: DataFrame, threshold: float, key: str = "vec_id",
                    vector: str = "embedding", label: str = "label",
                    sample: int = SAMPLE) -> DataFrame:
    """Key, ``n_links``, ``component_id`` and ``kept`` for every row."""
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"),
                     F.col(vector).alias("vector"))
    rows = rows.withColumn("cid", F.when(
        usable("vector") & F.col("label").isNotNull(), F.xxhash64("label", "vector")))
    classes = materialise(
        rows.where(F.col("cid").isNotNull()).groupBy("cid").agg(
            F.count(F.lit(1)).alias("weight"), F.min("key").alias("least"),
            F.first("label").alias("label"), F.first("vector").alias("vector"))
        .withColumn("dim", F.size("vector")), "itq-classes")
    models = {}
    for dim, count in classes.groupBy("dim").agg(F.count(F.lit(1))).collect():
        chosen = classes.where(
            (F.col("dim") == dim) & hash_below(share(sample, count), "cid")).select("vector")
        found = [v.as_py() for v in chosen.limit(2 * sample).toArrow().column(0)]
        models[dim] = learn(unit(np.array(found or [[1.0] * dim], np.float64)))
    coded = materialise(_coded(classes, "label", shared(df.sparkSession, models)), "itq-codes")
    bucket = ["label", "dim", "table", "bucket"]
    sizes = (coded.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
             .select(*bucket, F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    dealt = (coded.join(sizes, bucket)
             .withColumn("block", F.pmod(F.xxhash64("cid", F.lit(3)), F.col("blocks")).cast("int"))
             .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("low", F.least("block", "partner"))
             .withColumn("high", F.greatest("block", "partner")))
    found = materialise(
        dealt.select(*bucket, "low", "high", "block", "cid", "weight", "code", "vector")
        .groupBy(*bucket, "low", "high")
        .applyInArrow(_compare("label", threshold), "cid long, links long, root long"),
        "itq-links")
    roots = connected(found, "cid", "root")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    own = (classes.select("cid", "weight", "least").join(counts, "cid", "left")
           .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
           .withColumn("root", F.coalesce("root", "cid")))
    named = own.groupBy("root").agg(F.min("least").alias("component_id"))
    own = own.join(named, "root").select(
        "cid", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        "component_id")
    return (rows.select("key", "cid").join(own, "cid", "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("cid").isNull(), F.col("key")).otherwise(F.col("component_id"))
        .alias("component_id"))
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))))
