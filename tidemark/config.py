"""Job parameters, validated before any Spark work starts."""

from __future__ import annotations

from dataclasses import dataclass, field

from tidemark.functions.vocabulary import Vocabulary

DEFAULT_ASOF = "2026-08-14 00:00:00"
FIRST_EMPLOYEE_ID = 100_000
SECONDS_PER_DAY = 86_400


def _at_least(name: str, value: int, low: int) -> None:
    if isinstance(value, bool) or not isinstance(value, int) or value < low:
        raise ValueError(f"{name} must be an integer of at least {low}, got {value!r}")


@dataclass(frozen=True)
class GenerationConfig:
    """Size and shape of the generated tables."""

    employees: int = 10_000
    departments: int = 24
    buckets: int = 2
    history_days: int = 90
    asof: str = DEFAULT_ASOF
    first_employee_id: int = FIRST_EMPLOYEE_ID
    hot_keys: int = 3
    hot_percent: int = 30
    vocabulary: Vocabulary = field(default_factory=Vocabulary)

    def __post_init__(self) -> None:
        _at_least("employees", self.employees, 0)
        _at_least("departments", self.departments, 1)
        _at_least("buckets", self.buckets, 1)
        _at_least("history_days", self.history_days, 1)
        _at_least("hot_keys", self.hot_keys, 1)
        _at_least("hot_percent", self.hot_percent, 0)
        if self.hot_percent > 100:
            raise ValueError("hot_percent must not exceed 100")


@dataclass(frozen=True)
class BatchConfig:
    """One landing of new and moved rows.

    ``asof`` is the batch's own anchor.  Advance it from batch to batch: a second batch
    inside the first one's time span hides below the high-water mark of the output.
    ``force_move`` makes every mover change its department; otherwise one draw in n lands
    on the department it already has.
    """

    new_rows: int = 500
    updated_rows: int = 200
    asof: str = DEFAULT_ASOF
    span_minutes: int = 720
    force_move: bool = False

    def __post_init__(self) -> None:
        _at_least("new_rows", self.new_rows, 0)
        _at_least("updated_rows", self.updated_rows, 0)
        _at_least("span_minutes", self.span_minutes, 1)


@dataclass(frozen=True)
class WatermarkPolicy:
    """Which fact rows count as new.

    ``strict`` takes rows above the mark; rows that carry exactly the mark's timestamp but
    arrived later are skipped.  ``inclusive`` also takes rows at the mark, which is safe
    because the merge is idempotent.  ``lookback`` lowers the mark by an interval such as
    ``"12 hours"`` for sources whose rows arrive late.
    """

    mode: str = "strict"
    lookback: str | None = None

    def __post_init__(self) -> None:
        if self.mode not in ("strict", "inclusive"):
            raise ValueError(f"unknown watermark mode {self.mode!r}")


@dataclass(frozen=True)
class OutputSpec:
    """The denormalised read table: what it joins, keeps, and is laid out by."""

    key: str = "employee_id"
    join_key: str = "department_name"
    watermark: str = "updated_at"
    fact_columns: tuple[str, ...] = (
        "employee_id", "employee_name", "department_number", "department_name",
        "location_code", "salary_band", "updated_at",
    )
    dim_columns: tuple[str, ...] = ("department_head", "cost_center", "division")
    cluster_by: tuple[str, ...] = ("department_name",)

    def __post_init__(self) -> None:
        for needed in (self.key, self.join_key, self.watermark):
            if needed not in self.fact_columns:
                raise ValueError(f"{needed!r} must be one of the fact columns")
        overlap = set(self.fact_columns) & set(self.dim_columns)
        if overlap:
            raise ValueError(f"columns taken from both sides: {sorted(overlap)}")
        missing = set(self.cluster_by) - set(self.columns)
        if missing:
            raise ValueError(f"cluster columns not in the output: {sorted(missing)}")

    @property
    def columns(self) -> tuple[str, ...]:
        return self.fact_columns + self.dim_columns
