"""Inputs and outputs: CSV scan, Parquet landing, contract checks, driver-table bindings."""

from boxstar.sources.bindings import (  # noqa: F401
    player_stats_source,
    players_source,
    team_stats_source,
)
from boxstar.sources.contract import missing_inputs, require_inputs  # noqa: F401
from boxstar.sources.csvscan import apply_na_tokens, read_box_csv  # noqa: F401
from boxstar.sources.landing import read_table, write_table  # noqa: F401
