from .chain import STEPS, drain, fleet_steps, start, wait_for_any
from .jobs import (
    first_deliveries,
    start_alerts,
    start_enrichment,
    start_pane_counts,
    start_window_counts,
)
from .sinks import (
    ChangedSettingsError,
    keep_settings,
    start_appending,
    start_console,
    start_preview,
    start_writers,
)
from .snapshots import SnapshotTable

__all__ = [
    "STEPS",
    "ChangedSettingsError",
    "SnapshotTable",
    "drain",
    "first_deliveries",
    "fleet_steps",
    "keep_settings",
    "start",
    "start_alerts",
    "start_appending",
    "start_console",
    "start_enrichment",
    "start_pane_counts",
    "start_preview",
    "start_window_counts",
    "start_writers",
    "wait_for_any",
]
