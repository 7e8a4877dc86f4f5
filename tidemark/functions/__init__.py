from tidemark.functions.keyed import (
    anchor, bucket_of, cost_center, draw, expected_hot_share, full_name, id_key, keyed_hash,
    minutes_after, pick, seconds_before, skewed_key,
)
from tidemark.functions.vocabulary import Vocabulary

__all__ = [
    "Vocabulary", "anchor", "bucket_of", "cost_center", "draw", "expected_hot_share",
    "full_name", "id_key", "keyed_hash", "minutes_after", "pick", "seconds_before",
    "skewed_key",
]
