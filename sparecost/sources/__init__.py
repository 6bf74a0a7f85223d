from sparecost.sources.published import Folder, PublishConflict, Published, advance, land, typed
from sparecost.sources.readers import (
    append_tables, column_map, read_months, read_remote, read_table, recode_regions, strict_load,
)
from sparecost.sources.writers import (
    backfill, full_refresh, overwrite_period, replace_window, reload_window, stamp_period,
)

__all__ = [
    "Folder", "PublishConflict", "Published", "advance", "append_tables", "backfill", "column_map", "full_refresh", "land", "overwrite_period",
    "read_months", "read_remote", "read_table", "recode_regions", "reload_window", "replace_window", "stamp_period", "strict_load", "typed",
]
