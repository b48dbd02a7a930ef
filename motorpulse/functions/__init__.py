from .codec import decode, encode, field_faults
from .columns import (
    alert_condition,
    color_of,
    event_timestamp,
    expected_gear,
    stray_time,
)

__all__ = [
    "alert_condition",
    "color_of",
    "decode",
    "encode",
    "event_timestamp",
    "expected_gear",
    "field_faults",
    "stray_time",
]
