from tidemark.plans.batch import (
    MOVE, allocate_ids, land_batch, moved_rows, new_rows, next_id,
)
from tidemark.plans.generate import create_sources, generate_dimension, generate_fact
from tidemark.plans.output import (
    BuildResult, OutputCheckError, build_output, changed_rows, check_output, quarantine,
    refresh_output, run_build,
)
from tidemark.plans.overlay import OverlayResult, compact_overlay, refresh_overlay
from tidemark.plans.ranges import (
    RangeResult, drop_replaced, live_ranges, refresh_ranges, stored_rows,
)
from tidemark.plans.verify import Expectations, verify, verify_layout

__all__ = [
    "BuildResult", "Expectations", "MOVE", "OutputCheckError", "OverlayResult", "RangeResult",
    "allocate_ids", "build_output", "changed_rows", "check_output", "compact_overlay",
    "create_sources", "drop_replaced", "generate_dimension", "generate_fact", "land_batch",
    "live_ranges", "moved_rows", "new_rows", "next_id", "quarantine", "refresh_output",
    "refresh_overlay", "refresh_ranges", "run_build", "stored_rows", "verify", "verify_layout",
]
