from tidemark.operators.checks import (
    duplicate_keys, leaf_digests, locate_differences, not_null_report, orphans, reconcile,
    relationships, row_counts,
)
from tidemark.operators.joins import (
    FanOutError, SideSize, computed_key_join, many_to_one_join, measure_side, unmatched_rows,
)
from tidemark.operators.merge import (
    append_only, latest_per_key, move_partitions, one_per_key, partial_update,
    touched_partitions, upsert,
)
from tidemark.operators.profiles import (
    column_stats, partition_profile, skew_profile, watermark_profile,
)
from tidemark.operators.sampling import hash_order_sample
from tidemark.operators.sketches import merged_stats, refresh_sketches, sketch_partitions
from tidemark.operators.watermark import Watermark, high_water_mark, is_newer, newer_than

__all__ = [
    "FanOutError", "SideSize", "Watermark", "append_only", "column_stats",
    "computed_key_join", "duplicate_keys", "hash_order_sample", "high_water_mark", "is_newer",
    "latest_per_key", "leaf_digests", "locate_differences", "many_to_one_join", "measure_side",
    "merged_stats", "move_partitions",
    "newer_than", "not_null_report", "one_per_key", "orphans", "partial_update",
    "partition_profile", "reconcile", "refresh_sketches", "relationships", "row_counts",
    "sketch_partitions", "skew_profile",
    "touched_partitions", "unmatched_rows", "upsert", "watermark_profile",
]
