from .keys import key_text, surrogate_key
from .labels import (
    days_segment,
    engagement_label,
    flipped_level,
    page_category,
    session_tier,
)
from .numbers import exact_sum, ratio_or_zero, round_half_up, safe_share
from .repair import repair_text
from .text import match_artist, match_title, normalize_title, standard_postal, strip_quotes
from .times import (
    OPEN_END,
    elapsed,
    hour_bucket,
    millis_to_timestamp,
    plausible_millis,
    second_boundaries,
    time_bucket,
    time_parts,
    to_epoch_millis,
)

__all__ = [
    "OPEN_END",
    "days_segment",
    "elapsed",
    "engagement_label",
    "exact_sum",
    "flipped_level",
    "hour_bucket",
    "key_text",
    "match_artist",
    "match_title",
    "millis_to_timestamp",
    "plausible_millis",
    "normalize_title",
    "page_category",
    "ratio_or_zero",
    "repair_text",
    "round_half_up",
    "safe_share",
    "second_boundaries",
    "session_tier",
    "standard_postal",
    "strip_quotes",
    "surrogate_key",
    "time_bucket",
    "time_parts",
    "to_epoch_millis",
]
