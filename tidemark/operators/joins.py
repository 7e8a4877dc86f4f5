"""Many-to-one joins that neither fan out, nor stall on a hot key, nor broadcast blindly."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its measured in-memory size stays below this.
BROADCAST_LIMIT = 64 * 1024 * 1024

ROW_OVERHEAD = 48


class FanOutError(ValueError):
    """The side that should hold one row per key holds several."""


@dataclass(frozen=True)
class SideSize:
    rows: int
    bytes: int
    rows_of_largest_key: int
    null_keys: int

    @property
    def unique(self) -> bool:
        return self.rows_of_largest_key <= 1


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) * 4 + 32
    return F.lit(16)


def measure_side(side: DataFrame, keys: Sequence[str]) -> SideSize:
    """Size and key uniqueness of a join side, in one job that returns one row."""
    width = F.lit(ROW_OVERHEAD)
    for field in side.schema:
        width = width + _width(field)
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    per_key = side.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(width.cast("bigint")).alias("bytes"))
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.when(~has_null, F.col("n"))), F.lit(0)).alias("largest"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("nulls"),
    ).first()
    return SideSize(row.rows, row.bytes, row.largest, row.nulls)


def sized_join(large: DataFrame, small: DataFrame, key: str, how: str,
               broadcast: bool) -> DataFrame:
    """Join on one key, broadcasting ``small`` when its measured size allows.

    Beyond that both sides are shuffled once and merged, whatever a file size might suggest;
    adaptive execution splits the partitions of hot keys, of any type.
    """
    return large.join(F.broadcast(small) if broadcast else small.hint("merge"), key, how)


def filtering_join(large: DataFrame, keys: DataFrame, key: str, how: str,
                   broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Rows of ``large`` whose key is (``left_semi``) or is not (``left_anti``) among ``keys``."""
    side = keys.select(key)
    fits = measure_side(side, [key]).bytes <= broadcast_limit
    return sized_join(large, side, key, how, fits).select(large.columns)


def many_to_one_join(large: DataFrame, small: DataFrame, key: str, how: str = "inner",
                     broadcast_limit: int = BROADCAST_LIMIT,
                     size: SideSize | None = None) -> DataFrame:
    """``large`` with the columns of its one matching ``small`` row.

    The small side is measured first: several rows of one key raise ``FanOutError`` before
    anything is joined, and its size decides between broadcast and shuffle.  ``inner``
    drops rows without a match (see ``unmatched_rows``), ``left`` keeps them.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a many-to-one join is inner or left, not {how!r}")
    size = size or measure_side(small, [key])
    if not size.unique:
        raise FanOutError(f"{key!r} has up to {size.rows_of_largest_key} rows per value on "
                          "the small side; the join would fan out")
    return sized_join(large, small, key, how, size.bytes <= broadcast_limit)


def unmatched_rows(large: DataFrame, small: DataFrame, key: str,
                   broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Rows an inner join would drop, null keys included: the quarantine of a build."""
    return filtering_join(large, small, key, "left_anti", broadcast_limit)


def computed_key_join(rows: DataFrame, parents: DataFrame, parent_key: str,
                      key_of: Callable[[int], Column], columns: Sequence[str],
                      broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Join on a key computed from the row.

    ``key_of(n)`` gets the number of parents and returns the expression; the result is
    compared as BIGINT, so INT and BIGINT keys match.
    """
    joined_on = "__computed_key"
    side = parents.select(F.col(parent_key).cast("bigint").alias(joined_on), *columns)
    size = measure_side(side, [joined_on])
    keyed = rows.withColumn(joined_on, key_of(size.rows).cast("bigint"))
    return many_to_one_join(keyed, side, joined_on, "inner", broadcast_limit, size).drop(joined_on)
