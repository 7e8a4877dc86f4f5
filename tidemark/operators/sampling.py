"""A repeatable pseudo-random sample of exactly k rows."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import draw, id_key
from tidemark.functions.vocabulary import MOVE_ORDER_SPAN, SALT_MOVE_ORDER

# Above this, k rows are no longer merged in one task.
TOP_K_LIMIT = 100_000


def hash_order_sample(df: DataFrame, key: str, k: int, salt: str = SALT_MOVE_ORDER,
                      span: int = MOVE_ORDER_SPAN, top_k_limit: int = TOP_K_LIMIT) -> DataFrame:
    """The k rows that come first by (hash of the key, key).

    A small k is a plain top-k.  A large one goes by a cut-off instead: rows whose hash
    lies below the value at which the running count reaches k are kept by a filter, and
    only the rows on that value (about 1 in ``span``) are ordered by key.
    """
    order = "__hash_order"
    ordered = df.withColumn(order, draw(id_key(key), salt, span))
    if k <= top_k_limit:
        return ordered.orderBy(order, key).limit(k).drop(order)
    position = F.col(order)
    width = isqrt(span - 1) + 1  # two counts of at most `width` groups find the value
    block, taken, size = _reaching(ordered, F.floor(position / width), k)
    if taken + size < k:
        return df  # the table holds fewer than k rows
    in_block = ordered.filter((position >= block * width) & (position < (block + 1) * width))
    value, within, _ = _reaching(in_block, position, k - taken)
    whole = ordered.filter(position < value)
    edge = ordered.filter(position == value).orderBy(key).limit(k - taken - within)
    return whole.unionByName(edge).drop(order)


def _reaching(df: DataFrame, group: Column, k: int) -> tuple[int, int, int]:
    """The group at which the running count reaches k, the rows before it, and its own."""
    counts = df.groupBy(group.alias("g")).agg(F.count("*").alias("n")).orderBy("g").collect()
    before, last = 0, (0, 0, 0)
    for row in counts:
        last = (row.g, before, row.n)
        if before + row.n >= k:
            break
        before += row.n
    return last
