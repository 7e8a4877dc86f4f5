"""Column expressions that derive repeatable content from a key.

Everything here is a built-in Spark expression, so it stays inside code generation and
gives the same value for the same key on any cluster, partitioning or retry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import vocabulary as v


def id_key(column: str | Column) -> Column:
    """The key as BIGINT: the hash of an INT differs from that of the same BIGINT."""
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def keyed_hash(key: Column, salt: str) -> Column:
    """Signed 32-bit hash of (key, salt).  Each salt is an independent draw."""
    return F.hash(key, F.lit(salt))


def draw(key: Column, salt: str, n: int | Column) -> Column:
    """Repeatable number in 0..n-1."""
    if isinstance(n, int) and n < 1:
        raise ValueError("a draw needs at least one outcome")
    return F.pmod(keyed_hash(key, salt), n if isinstance(n, Column) else F.lit(n))


def pick(values: Sequence[str], key: Column, salt: str) -> Column:
    """Repeatable element of a value list."""
    options = F.array(*[F.lit(value) for value in values])
    return F.element_at(options, draw(key, salt, len(values)) + 1)


def full_name(first: Sequence[str], last: Sequence[str], key: Column,
              first_salt: str, last_salt: str) -> Column:
    return F.concat(pick(first, key, first_salt), F.lit(" "), pick(last, key, last_salt))


def cost_center(key: Column) -> Column:
    number = draw(key, v.SALT_COST_CENTER, v.COST_CENTER_SPAN) + v.COST_CENTER_BASE
    digits = F.lpad(number.cast("string"), v.COST_CENTER_DIGITS, "0")
    return F.concat(F.lit(v.COST_CENTER_PREFIX), digits)


def bucket_of(key: Column, buckets: int) -> Column:
    """Bucket of an id; narrowed to INT, the declared type of the partition column."""
    return F.pmod(key, F.lit(buckets)).cast("int")


def skewed_key(key: Column, n: int, hot_keys: int = 3, hot_percent: int = 30) -> Column:
    """Parent key in 1..n, deliberately skewed towards the first ``hot_keys`` values.

    ``hot_percent`` of the rows draw among the hot keys only, the others among all n, so
    the hot keys together expect ``hot + (1 - hot) * hot_keys / n`` of the rows.  With
    fewer than ``hot_keys`` parents every parent is hot, and no parent outside 1..n is
    ever named.
    """
    hot = min(hot_keys, n)
    return (
        F.when(draw(key, v.SALT_IS_HOT, 100) < hot_percent, draw(key, v.SALT_HOT_KEY, hot) + 1)
        .otherwise(draw(key, v.SALT_ANY_KEY, n) + 1)
    )


def expected_hot_share(n: int, hot_keys: int = 3, hot_percent: int = 30) -> float:
    hot = min(hot_keys, n)
    share = hot_percent / 100.0
    return share + (1.0 - share) * hot / n


def anchor(timestamp: str) -> Column:
    """A timestamp literal without a zone, so results do not depend on the session's."""
    return F.lit(timestamp).cast("timestamp_ntz")


def seconds_before(at: Column, key: Column, salt: str, span: int) -> Column:
    """``at`` minus 0..span-1 seconds.  BIGINT arithmetic: a long history cannot overflow."""
    return F.timestamp_add("SECOND", -draw(key, salt, span).cast("bigint"), at)


def minutes_after(at: Column, key: Column, salt: str, span: int) -> Column:
    """``at`` plus 0..span-1 minutes."""
    return F.timestamp_add("MINUTE", draw(key, salt, span).cast("bigint"), at)
