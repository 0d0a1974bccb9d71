"""The analyses wired together over one set of inputs.

``Analysis`` lands the cleaned raw inputs and the dimensions it needs once
(Parquet tables in the shared checkpoint folder; box rows by year), keeps the
facts lazy, and exposes every recipe as a DataFrame. The player-season pool and
the scored pool are landed too: each feeds several consumers (z-scores, nine
percentile ranks, benchmarks, active pool), which would otherwise
re-aggregate the box rows each time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstar import config
from boxstar.functions.cleaning import pick_format
from boxstar.plans import audits, clean, pool, roles, teams, tiers
from boxstar.plans.warehouse import Warehouse, open_warehouse, row_count_summary
from boxstar.session import Scratch, land
from boxstar.sources import bindings
from boxstar.sources.contract import require_columns, require_inputs
from boxstar.sources.csvscan import read_box_csv


@dataclass(frozen=True)
class Params:
    """Thresholds of the analyses (defaults: the original values)."""

    pool_min_minutes: float = config.POOL_MIN_MINUTES
    pool_min_games: int = config.POOL_MIN_GAMES
    tp_min_attempts: float = config.TP_PCT_MIN_ATTEMPTS
    fg_min_attempts: float = config.FG_PCT_MIN_ATTEMPTS
    active_min_minutes: float = config.ACTIVE_MIN_MINUTES
    active_min_games: int = config.ACTIVE_MIN_GAMES
    active_years: tuple[int, ...] = config.ACTIVE_YEARS
    recent_seasons: int = config.RECENT_SEASONS
    top_since_year: int = config.TOP_TEAMS_SINCE_YEAR
    top_min_games: int = config.TOP_TEAMS_MIN_GAMES
    top_limit: int = config.TOP_TEAMS_LIMIT
    profile_team: str = config.PROFILE_TEAM
    per_role: int = config.LEADERBOARD_PER_ROLE


# Thresholds for the stand-in tables (order lines are far fewer per customer
# than box-score rows per player): same recipes, smaller cut-offs.
STANDIN = Params(
    pool_min_minutes=150,
    pool_min_games=2,
    tp_min_attempts=14,
    fg_min_attempts=250,
    active_min_minutes=200,
    active_min_games=2,
    active_years=(2000, 2001),
    recent_seasons=3,
    top_since_year=2000,
    top_min_games=10,
    top_limit=10,
    profile_team="Nation_7",
    per_role=5,
)


def _owned(make):
    """Tables that a recipe lands belong to its analysis."""

    @wraps(make)
    def run(self, *args, **kwargs):
        with self.scratch.active():
            return make(self, *args, **kwargs)

    return run


class Analysis:
    """Recipes over the stand-in tables of ``sf_dir``, over three CSV files
    (:meth:`from_csv`) or over a written warehouse (:meth:`from_warehouse`).

    Every table and result is made and landed on first use. With ``strict``, an
    empty pool or an empty current pool raises ValueError. :meth:`close`, or the end of a
    ``with`` block (an error too), removes what the analysis has landed; a written warehouse stays.
    """

    def __init__(self, spark: SparkSession, sf_dir: str = "", params: Params | None = None, key_method: str = "ranged",
                 strict: bool = False, warehouse: Warehouse | None = None):
        self.spark, self.sf_dir, self.strict = spark, sf_dir, strict
        self.params = params or STANDIN
        self.warehouse = warehouse or Warehouse(self._standin_sources(), key_method, stage=land, games=self._standin_games())
        self.scratch = self.warehouse.scratch

    def close(self) -> None:
        """Remove the tables that this analysis has landed; its frames can be read no more."""
        self.scratch.close()

    def __enter__(self) -> "Analysis":
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def _standin_sources(self):
        spark, sf = self.spark, self.sf_dir
        boxes = {"player_stats_raw": bindings.player_stats_source, "team_stats_raw": bindings.team_stats_source}
        people = {"players_raw": lambda: land(clean.clean_players(bindings.players_source(spark, sf)), "players_raw")}
        return people | {n: (lambda n=n, read=read: _land_box(clean.clean_box_stats(read(spark, sf)), n)) for n, read in boxes.items()}

    def _standin_games(self):
        """The box rows without their statistics."""
        spark, sf = self.spark, self.sf_dir
        boxes = {"player_stats_raw": bindings.player_stats_source, "team_stats_raw": bindings.team_stats_source}

        def games(name: str) -> DataFrame:
            rows = clean.clean_box_stats(boxes[name](spark, sf))
            return _land_box(rows.select(*[c for c in rows.columns if c in config.GAME_COLUMNS]), f"{name}_games")

        return {n: (lambda n=n: games(n)) for n in boxes}

    @classmethod
    def from_csv(
        cls,
        spark: SparkSession,
        players_csv: str,
        player_stats_csv: str,
        team_stats_csv: str,
        params: Params | None = None,
        time_formats: Sequence[str] = config.TIMESTAMP_FORMATS,
        strict: bool = False,
        multi_line: bool | None = None,
        key_method: str = "ranged",
    ) -> "Analysis":
        """The recipes over the three original box-score CSV files.

        Missing files or columns are named in the error. Each time column is read
        in the format of its first value that follows one of ``time_formats``;
        values in another format become NULL, and game times of which none can be
        read raise ValueError.
        """
        paths = {"players": players_csv, "player_stats": player_stats_csv, "team_stats": team_stats_csv}
        raw: dict[str, DataFrame | None] = {}
        scratch = Scratch()
        try:
            for name, path in paths.items():
                try:
                    with scratch.active():
                        raw[name] = read_box_csv(spark, path, multi_line=multi_line)
                except FileNotFoundError:
                    raw[name] = None
            require_inputs(raw, paths)
            for name, columns in config.REQUIRED_COLUMNS.items():
                require_columns(name, raw[name], columns)
        except BaseException:
            scratch.close()
            raise

        def box(name: str) -> DataFrame:
            fmt = pick_format(raw[name], "gameDateTimeEst", time_formats)
            unread = [] if fmt else raw[name].where(F.col("gameDateTimeEst").isNotNull()).select("gameDateTimeEst").limit(1).collect()
            if unread:
                raise ValueError(f"input {name}: no game time can be read, such as {unread[0][0]!r}")
            return _land_box(clean.clean_box_stats(raw[name], ts_format=fmt or clean.TIMESTAMP_FORMAT), f"{name}_raw")

        def people() -> DataFrame:
            born = next((c for c in ("birthDate", "birthdate") if c in raw["players"].columns), None)
            fmt = pick_format(raw["players"], born, (clean.DATE_FORMAT, *time_formats)) if born else None
            return land(clean.clean_players(raw["players"], fmt or clean.DATE_FORMAT), "players_raw")

        sources = {"players_raw": people, "player_stats_raw": lambda: box("player_stats"), "team_stats_raw": lambda: box("team_stats")}
        warehouse = Warehouse(sources, key_method, stage=land, scratch=scratch)
        return cls(spark, params=params or Params(), strict=strict, warehouse=warehouse)

    @classmethod
    def from_warehouse(cls, spark: SparkSession, root: str, params: Params | None = None, strict: bool = False) -> "Analysis":
        """The recipes over the tables that ``write_warehouse`` has left under ``root``."""
        stored = open_warehouse(spark, root)
        require_inputs(stored, config.WAREHOUSE_TABLES)
        return cls(spark, params=params or Params(), strict=strict, warehouse=Warehouse({}, stored=stored))

    @property
    def players_raw(self) -> DataFrame:
        return self.warehouse.players_raw

    @property
    def player_stats_raw(self) -> DataFrame:
        return self.warehouse.player_stats_raw

    @property
    def team_stats_raw(self) -> DataFrame:
        return self.warehouse.team_stats_raw

    @_owned
    def row_counts(self) -> DataFrame:
        return row_count_summary(self.warehouse.counting_tables())

    @_owned
    def audits(self, stored: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
        return audits.run_audits(self.warehouse, stored or self.warehouse.counting_tables(), self.params.active_years)

    # -- team analyses -------------------------------------------------------
    @cached_property
    @_owned
    def win_loss(self) -> DataFrame:
        return teams.win_loss_summary(self.warehouse.team_fact(keys=()))

    @_owned
    def top_teams(self) -> DataFrame:
        p = self.params
        fact = self.warehouse.team_fact(keys=("teamKey",), since_year=p.top_since_year, stats=())
        return teams.top_teams(fact, self.warehouse.teams, p.top_since_year, p.top_min_games, p.top_limit)

    @_owned
    def team_profile(self) -> DataFrame:
        p = self.params
        fact = self.warehouse.team_fact(keys=("teamKey",), since_year=p.top_since_year)
        return teams.team_profile(fact, self.warehouse.teams, p.profile_team)

    # -- player benchmarks ---------------------------------------------------
    @cached_property
    @_owned
    def season_rows(self) -> DataFrame:
        p = self.params
        wh = self.warehouse
        return land(pool.season_aggregates(wh.player_stats_raw, wh.players, p.pool_min_minutes, p.pool_min_games), "season_rows")

    @cached_property
    @_owned
    def pool(self) -> DataFrame:
        p = self.params
        return land(pool.player_season_pool(self.season_rows, p.tp_min_attempts, p.fg_min_attempts, self.strict), "pool")

    @cached_property
    @_owned
    def roles(self) -> DataFrame:
        return land(roles.assign_roles(self.pool), "roles")

    @cached_property
    @_owned
    def scored(self) -> DataFrame:
        return land(roles.score_roles(self.roles, stage=land), "scored")

    @cached_property
    @_owned
    def benchmarks(self) -> DataFrame:
        return land(tiers.role_benchmarks(self.spark, self.scored), "benchmarks")

    @cached_property
    @_owned
    def active(self) -> DataFrame:
        p = self.params
        wh = self.warehouse
        return tiers.active_players(
            self.scored, wh.player_stats_raw, wh.players, p.active_min_minutes, p.active_min_games, p.active_years,
            p.recent_seasons, strict=self.strict,
        )

    @cached_property
    @_owned
    def metric_tiers(self) -> DataFrame:
        return tiers.metric_tiers(self.active, self.benchmarks)

    @cached_property
    @_owned
    def active_tiers(self) -> DataFrame:
        return land(tiers.overall_tier(self.metric_tiers), "active_tiers")

    @_owned
    def window_label(self) -> DataFrame:
        return tiers.window_label(self.scored, self.params.recent_seasons)

    @_owned
    def leaderboard(self) -> DataFrame:
        return tiers.leaderboard(self.active_tiers, self.params.per_role)

    @_owned
    def tier_distribution(self) -> DataFrame:
        return tiers.tier_distribution(self.spark, self.active_tiers)


def _land_box(df: DataFrame, name: str) -> DataFrame:
    """Box rows, landed by year of the game."""
    return land(clean.with_year(df), name, partition_by="_year")
