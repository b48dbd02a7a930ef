from .alerts import alerts
from .counts import (
    combine_panes,
    latest_closed_window,
    latest_window,
    normalize,
    pane_counts,
    window_counts,
)
from .dimensions import (
    DuplicateKeysError,
    car_profile,
    duplicate_keys,
    load_dimension,
    load_profile,
    one_row_per_key,
    preview,
    require_unique,
    write_dimension,
    write_fixed_dimensions,
)
from .enrich import attach_profile, enrich, fits_broadcast, frequent_keys
from .fleet_store import FleetStore
from .versions import PublishedMeanwhileError, VersionedTables, keys_in_both

__all__ = [
    "DuplicateKeysError",
    "FleetStore",
    "PublishedMeanwhileError",
    "VersionedTables",
    "alerts",
    "attach_profile",
    "car_profile",
    "combine_panes",
    "duplicate_keys",
    "enrich",
    "fits_broadcast",
    "frequent_keys",
    "keys_in_both",
    "latest_closed_window",
    "latest_window",
    "load_dimension",
    "load_profile",
    "normalize",
    "one_row_per_key",
    "pane_counts",
    "preview",
    "require_unique",
    "window_counts",
    "write_dimension",
    "write_fixed_dimensions",
]
