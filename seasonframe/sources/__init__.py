from seasonframe.sources.scratch import written_and_observed, written_once
from seasonframe.sources.tables import (
    DRIVER_SCHEMAS,
    SEASON_SCHEMAS,
    read_driver_table,
    read_season_tables,
    register_views,
    season_table,
    season_tables_from_catalog,
)

__all__ = [
    "DRIVER_SCHEMAS",
    "SEASON_SCHEMAS",
    "read_driver_table",
    "read_season_tables",
    "register_views",
    "season_table",
    "season_tables_from_catalog",
    "written_and_observed",
    "written_once",
]
