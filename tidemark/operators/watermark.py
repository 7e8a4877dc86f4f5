"""The batch high-water mark: read it, and select what lies beyond."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import WatermarkPolicy


@dataclass(frozen=True)
class Watermark:
    """The largest value of a column, in a form no time zone can shift.

    Timestamps with a zone travel as microseconds since the epoch (their text is ambiguous
    in the hour clocks are set back), everything else as text.
    """

    value: str | int
    data_type: T.DataType

    def literal(self) -> Column:
        if isinstance(self.data_type, T.TimestampType):
            return F.timestamp_micros(F.lit(self.value).cast("bigint"))
        return F.lit(self.value).cast(self.data_type)


def high_water_mark(target: DataFrame, column: str) -> Watermark | None:
    """Largest value in the target; ``None`` when it holds none.  One row reaches the driver."""
    data_type = target.schema[column].dataType
    top = F.max(column)
    top = F.unix_micros(top) if isinstance(data_type, T.TimestampType) else top.cast("string")
    value = target.agg(top.alias("top")).first().top
    return None if value is None else Watermark(value, data_type)


def is_newer(column: str, mark: Watermark, policy: WatermarkPolicy = WatermarkPolicy()) -> Column:
    """The condition that a row lies beyond the mark.

    The bound is a literal of the column's type, so it reaches the scan and row groups
    below it are skipped.
    """
    bound = mark.literal()
    if policy.lookback:
        bound = (bound - F.expr(f"INTERVAL {policy.lookback}")).cast(mark.data_type)
    value = F.col(column)
    return value >= bound if policy.mode == "inclusive" else value > bound


def newer_than(fact: DataFrame, column: str, mark: Watermark | None,
               policy: WatermarkPolicy = WatermarkPolicy()) -> DataFrame:
    """Fact rows beyond the mark; all rows when there is none."""
    return fact if mark is None else fact.filter(is_newer(column, mark, policy))
