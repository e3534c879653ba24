"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from vistra.functions.dates import (
    clip_at_zero,
    duration_days,
    parse_timestamp,
    period_label,
    timestamp_to_text,
    truncate_to_millis,
)
from vistra.functions.numbers import (
    clip_between,
    parse_long,
    parse_person_id,
)

__all__ = [
    "clip_at_zero",
    "clip_between",
    "duration_days",
    "parse_long",
    "parse_person_id",
    "parse_timestamp",
    "period_label",
    "timestamp_to_text",
    "truncate_to_millis",
]
