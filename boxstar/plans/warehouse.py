"""Star schema: players, teams, games, dates dimensions and the two facts."""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxstar import config
from boxstar.functions.calendar import day_of_week_sunday0
from boxstar.functions.cleaning import normalize_game_type, to_double, to_whole
from boxstar.operators.keys import through_keys
from boxstar.operators.ordered import dense_key
from boxstar.operators.shaping import latest_per_key
from boxstar.session import Scratch
from boxstar.sources.landing import VersionedFolder, write_files

PLAYER_COLUMNS, BOX_STATS, TEAM_STATS = config.PLAYER_COLUMNS, config.BOX_STATS, config.TEAM_STATS


def typed_column(df: DataFrame, name: str, kind: str) -> Column:
    """Column ``name`` as ``kind``. Text follows the cleaning rules: strict
    numbers, ``1.0`` and boolean words as whole numbers, nothing infinite."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        if kind in ("int", "long"):
            return to_whole(c, kind)
        if kind == "double":
            return to_double(c)
    return c.try_cast(kind)


def since(df: DataFrame, year: int | None, ts_col: str = "gameDateTimeEst") -> DataFrame:
    """Rows from ``year`` on. Landed box rows are partitioned by ``_year``, so the
    scan leaves out earlier partitions; otherwise the time filter reaches the files."""
    if year is None:
        return df
    if "_year" in df.columns:
        df = df.where(F.col("_year") >= year)
    return df.where(F.col(ts_col).cast("timestamp_ntz") >= F.lit(f"{year:04d}-01-01").cast("timestamp_ntz"))


def players_dim(players_raw: DataFrame, key_method: str = "ranged") -> DataFrame:
    """One row per raw player row (not de-duplicated), key by personId, NULLs last."""
    typed = players_raw.select(*[typed_column(players_raw, n, t).alias(n) for n, t in PLAYER_COLUMNS])
    keyed = dense_key(typed, "personId", "playerKey", method=key_method)
    return keyed.select("playerKey", *[n for n, _ in PLAYER_COLUMNS])


def teams_dim(team_stats_raw: DataFrame, key_method: str = "ranged") -> DataFrame:
    """One row per team name with its most recently seen city and that city's max coach."""
    history = team_stats_raw.groupBy("teamName", "teamCity").agg(
        F.max(typed_column(team_stats_raw, "coachId", "double")).alias("coachId"),
        F.max(F.col("gameDateTimeEst").cast("timestamp_ntz")).alias("last_seen"),
    )
    last_seen, city = F.col("last_seen"), F.col("teamCity")
    latest = latest_per_key(
        history,
        ["teamName"],
        # last_seen DESC NULLS LAST, then non-NULL city first, then city DESC
        [last_seen.isNotNull(), last_seen, city.isNotNull(), city],
    )
    # one row per name: the key is unique by construction
    keyed = dense_key(
        latest.select("teamName", "teamCity", "coachId"), "teamName", "teamKey", method=key_method, spread_ties=False
    )
    return keyed.select("teamKey", "teamName", "teamCity", "coachId")


def team_lookup(teams: DataFrame) -> DataFrame:
    """Team name -> smallest key (the key used by both facts)."""
    return teams.groupBy("teamName").agg(F.min("teamKey").alias("teamKey"))


def games_dim(player_stats_raw: DataFrame, key_method: str = "ranged") -> DataFrame:
    """One row per gameId of the player statistics, normalised game type."""
    src = player_stats_raw.select(
        typed_column(player_stats_raw, "gameId", "long").alias("gameId"),
        normalize_game_type("gameType").alias("gameType"),
    )
    games = src.groupBy("gameId").agg(F.coalesce(F.max("gameType"), F.lit(config.GAME_TYPE_LABELS["unknown"])).alias("gameType"))
    keyed = dense_key(games, "gameId", "gameKey", method=key_method, spread_ties=False)
    return keyed.select("gameKey", "gameId", "gameType")


def dates_dim(team_stats_raw: DataFrame, player_stats_raw: DataFrame, key_method: str = "ranged") -> DataFrame:
    """One row per distinct game timestamp of either input (NULL is one row)."""
    ts = F.col("gameDateTimeEst").cast("timestamp_ntz").alias("gameDateEst")
    stamps = team_stats_raw.select(ts).union(player_stats_raw.select(ts)).distinct()
    keyed = dense_key(stamps, "gameDateEst", "dateKey", method=key_method, spread_ties=False)
    d = F.col("gameDateEst")
    return keyed.select(
        "dateKey",
        "gameDateEst",
        F.date_format(d, "yyyy-MM-dd").alias("fullDate"),
        F.year(d).cast("int").alias("year"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
        day_of_week_sunday0(d).cast("int").alias("dayOfTheWeek"),
        F.quarter(d).cast("int").alias("quarter"),
    )


FACT_KEYS = ("teamKey", "opponentTeamKey", "gameKey", "dateKey")


def _resolve_keys(
    src: DataFrame,
    team_col: str,
    opp_col: str,
    lookup: DataFrame | None,
    games: DataFrame | None,
    dates: DataFrame | None,
    keys=FACT_KEYS,
) -> DataFrame:
    """Left joins of a raw fact to the lookup (twice), games and dates.

    Only the requested ``keys`` are resolved. Each of these dimensions is
    unique on its join key by construction (lookup grouped by name, games by
    id, dates distinct), so a left join never changes the row count and an
    unrequested key can be skipped -- a fact read for its measures only does
    not shuffle against a dimension. The planner broadcasts a dimension when
    its files are below the session's broadcast threshold; each of the others
    deals ``src`` out once.
    """
    # key -> (dimension, its join column, its key, column of the fact)
    wanted = {
        "teamKey": (lookup, "teamName", "teamKey", team_col),
        "opponentTeamKey": (lookup, "teamName", "teamKey", opp_col),
        "gameKey": (games, "gameId", "gameKey", "_gid"),
        "dateKey": (dates, "gameDateEst", "dateKey", "_ts"),
    }
    for key in FACT_KEYS:
        if key in keys:
            dim, on, number, left = wanted[key]
            side = dim.select(F.col(on).alias(f"_j_{key}"), F.col(number).alias(key))
            src = src.join(side, F.col(left) == F.col(f"_j_{key}"), "left").drop(f"_j_{key}")
    return src


def natural_keys(raw: DataFrame, team_col: str, opp_col: str) -> dict[str, Column]:
    """The columns by which a box row meets the dimensions, typed."""
    out = {
        "_gid": typed_column(raw, "gameId", "long"),
        "_ts": F.col("gameDateTimeEst").cast("timestamp_ntz"),
        "_team": F.col(team_col),
        "_opp": F.col(opp_col),
    }
    return ({"_pid": typed_column(raw, "personId", "long")} | out) if "personId" in raw.columns else out


def player_stats_fact(
    player_stats_raw: DataFrame, players: DataFrame, lookup: DataFrame, games: DataFrame, dates: DataFrame, keys=FACT_KEYS,
    narrow: Collection[str] = (),
) -> DataFrame:
    """One row per player-game row (times duplicate players: not de-duplicated).

    ``playerKey`` is always resolved (a duplicated player multiplies rows); the
    other keys only when listed in ``keys`` -- the rest are left out. The joins for the keys
    in ``narrow`` see the key columns alone and whole rows move once
    (:func:`through_keys`): for dimensions too large to broadcast."""
    raw = player_stats_raw

    def resolve(rows: DataFrame, wanted: Collection[str]) -> DataFrame:
        if "playerKey" in wanted:
            people = players.select(F.col("personId").alias("_j_person"), "playerKey")
            rows = rows.join(people, F.col("_pid") == F.col("_j_person"), "left").drop("_j_person")
        return _resolve_keys(rows, "_team", "_opp", lookup, games, dates, wanted)

    out = _with_keys(raw, natural_keys(raw, "playerteamName", "opponentteamName"), resolve, ("playerKey", *keys), narrow)
    numbers = [("win", "int"), ("home", "int"), ("numMinutes", "double"), *[(c, "double") for c in BOX_STATS]]
    return out.select(
        "playerKey",
        *[k for k in FACT_KEYS if k in keys],
        "gameType",
        "gameLabel",
        "gameSubLabel",
        "seriesGameNumber",
        *[typed_column(raw, c, t).alias(c) for c, t in numbers],
    )


#: The natural key by which each key is found.
NATURAL = {"playerKey": "_pid", "teamKey": "_team", "opponentTeamKey": "_opp", "gameKey": "_gid", "dateKey": "_ts"}


def _with_keys(
    raw: DataFrame, natural: dict[str, Column], resolve: Callable[[DataFrame, Collection[str]], DataFrame], keys: Collection[str],
    narrow: Collection[str],
) -> DataFrame:
    """``raw`` with ``keys``: those in ``narrow`` through their natural keys alone, the others beside the whole rows."""
    through = [k for k in keys if k in narrow]

    def beside(rows: DataFrame) -> DataFrame:
        return resolve(rows.withColumns(natural), [k for k in keys if k not in through])

    if not through:
        return beside(raw)
    return through_keys(raw, {NATURAL[k]: natural[NATURAL[k]] for k in through}, lambda rows: resolve(rows, through), beside)


def team_stats_fact(
    team_stats_raw: DataFrame, lookup: DataFrame, games: DataFrame, dates: DataFrame, keys=FACT_KEYS, narrow: Collection[str] = (),
    stats=TEAM_STATS,
) -> DataFrame:
    """One row per team-game row; games come from player statistics only.

    Keys not listed in ``keys`` and statistics not listed in ``stats`` are left out; ``narrow`` as in
    :func:`player_stats_fact`."""
    raw = team_stats_raw

    def resolve(rows: DataFrame, wanted: Collection[str]) -> DataFrame:
        return _resolve_keys(rows, "_team", "_opp", lookup, games, dates, wanted)

    out = _with_keys(raw, natural_keys(raw, "teamName", "opponentTeamName"), resolve, keys, narrow)
    numbers = [("home", "int"), ("win", "int"), *[(c, "double") for c in stats]]
    return out.select(*[k for k in FACT_KEYS if k in keys], *[typed_column(raw, c, t).alias(c) for c, t in numbers])


class Warehouse:
    """The nine tables, each made on first use.

    ``sources`` gives the three raw tables as functions; ``stored`` tables (of a
    written warehouse) are taken as they are. ``stage(df, name)`` lands each
    dimension, so that both facts and every analysis read one copy; facts stay
    lazy so that consumers prune them to the columns they use. ``direct_rows`` is the size
    up to which a dimension is taken to be broadcast. ``scratch`` notes what is landed on
    the way. ``games`` gives box rows without their statistics, for what needs no more.
    """

    def __init__(self, sources: dict[str, Callable[[], DataFrame]], key_method: str = "ranged", stage=None,
                 stored: dict[str, DataFrame] | None = None, direct_rows: int = config.DIRECT_JOIN_ROWS,
                 scratch: Scratch | None = None, games: dict[str, Callable[[], DataFrame]] | None = None):
        self.scratch = scratch or Scratch()
        self._games, self._game_rows = games or {}, {}
        self.direct_rows, self._counts = direct_rows, {}
        self._sources, self._key_method = sources, key_method
        self._stage = stage or (lambda df, name: df)
        self._stored = stored or {}

    def _table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        with self.scratch.active():
            return self._stored[name] if name in self._stored else make()

    @cached_property
    def players_raw(self) -> DataFrame:
        return self._table("players_raw", self._sources.get("players_raw"))

    @cached_property
    def player_stats_raw(self) -> DataFrame:
        return self._table("player_stats_raw", self._sources.get("player_stats_raw"))

    @cached_property
    def team_stats_raw(self) -> DataFrame:
        return self._table("team_stats_raw", self._sources.get("team_stats_raw"))

    def game_rows(self, name: str) -> DataFrame:
        """All rows of the box table ``name`` for readers of ``config.GAME_COLUMNS`` alone: the table
        itself once it is there, else a copy without statistics, which need not be derived for it."""
        if name in self.__dict__ or name in self._stored or name not in self._games:
            return getattr(self, name)
        if name not in self._game_rows:
            with self.scratch.active():
                self._game_rows[name] = self._games[name]()
        return self._game_rows[name]

    @cached_property
    def players(self) -> DataFrame:
        return self._table("players", lambda: self._stage(players_dim(self.players_raw, self._key_method), "players"))

    @cached_property
    def teams(self) -> DataFrame:
        return self._table("teams", lambda: self._stage(teams_dim(self.game_rows("team_stats_raw"), self._key_method), "teams"))

    @cached_property
    def team_lookup(self) -> DataFrame:
        return team_lookup(self.teams)

    @cached_property
    def games(self) -> DataFrame:
        return self._table("games", lambda: self._stage(games_dim(self.game_rows("player_stats_raw"), self._key_method), "games"))

    @cached_property
    def dates(self) -> DataFrame:
        def make() -> DataFrame:
            return dates_dim(self.game_rows("team_stats_raw"), self.game_rows("player_stats_raw"), self._key_method)

        return self._table("dates", lambda: self._stage(make(), "dates"))

    @cached_property
    def player_stats_fact(self) -> DataFrame:
        return self._table("player_stats_fact", self.player_fact)

    @cached_property
    def team_stats_fact(self) -> DataFrame:
        return self._table("team_stats_fact", self.team_fact)

    def player_fact(self, keys=FACT_KEYS, since_year: int | None = None) -> DataFrame:
        """The player fact with ``keys`` (playerKey always), from ``since_year`` on."""
        raw = since(self.player_stats_raw, since_year)
        tables = self._key_tables(keys)
        with self.scratch.active():
            return player_stats_fact(raw, self.players, *tables, keys, self._narrow(keys, players=True))

    def team_fact(self, keys=FACT_KEYS, since_year: int | None = None, stats=TEAM_STATS) -> DataFrame:
        """The team fact with ``keys`` and ``stats``, from ``since_year`` on."""
        raw = since(self.team_stats_raw if stats else self.game_rows("team_stats_raw"), since_year)
        with self.scratch.active():
            return team_stats_fact(raw, *self._key_tables(keys), keys, self._narrow(keys), stats)

    def _rows(self, name: str) -> int:
        """Rows of a landed dimension, counted once."""
        if name not in self._counts:
            self._counts[name] = getattr(self, name).count()
        return self._counts[name]

    def _narrow(self, keys, players: bool = False) -> list[str]:
        """The keys whose joins would each deal out whole box rows, where there are two or more:
        they meet a dimension of over ``direct_rows`` rows. One alone costs what the way
        through keys costs, and small dimensions are broadcast."""
        dimension = {"teamKey": "teams", "opponentTeamKey": "teams", "gameKey": "games", "dateKey": "dates"}
        joined = {k: dimension[k] for k in FACT_KEYS if k in keys} | ({"playerKey": "players"} if players else {})
        if len(joined) < 2:
            return []
        large = [k for k, name in joined.items() if self._rows(name) > self.direct_rows]
        return large if len(large) > 1 else []

    def _key_tables(self, keys) -> list[DataFrame | None]:
        """Lookup, games and dates, where ``keys`` need them (else not even built)."""
        return [
            self.team_lookup if {"teamKey", "opponentTeamKey"} & set(keys) else None,
            self.games if "gameKey" in keys else None,
            self.dates if "dateKey" in keys else None,
        ]

    def is_stored(self, name: str) -> bool:
        return name in self._stored

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in config.WAREHOUSE_TABLES}

    def counting_tables(self) -> dict[str, DataFrame]:
        """The same tables for counting: facts without the joins that cannot
        change their number of rows (only duplicate players can)."""
        facts = {"player_stats_fact": lambda: self.player_fact(keys=()), "team_stats_fact": lambda: self.team_stats_raw}
        return {n: self._table(n, facts[n]) if n in facts else getattr(self, n) for n in config.WAREHOUSE_TABLES}


def build_warehouse(
    players_raw: DataFrame, player_stats_raw: DataFrame, team_stats_raw: DataFrame, key_method: str = "ranged", stage=None
) -> Warehouse:
    """A warehouse over three raw tables."""
    raw = {"players_raw": players_raw, "player_stats_raw": player_stats_raw, "team_stats_raw": team_stats_raw}
    return Warehouse({name: (lambda df=df: df) for name, df in raw.items()}, key_method, stage)


def write_warehouse(wh: Warehouse, root: str, force_rebuild: bool = True) -> dict[str, str]:
    """Write the nine tables under ``root`` and make them the warehouse there in one step: readers
    see all of the former tables or all of the new ones, and a write that fails leaves the
    former ones. ``force_rebuild=False`` raises where a warehouse is there. Box rows with a year
    are partitioned by it. Returns the tables' paths."""
    root = root.rstrip("/")

    def write(folder: str) -> None:
        for name, df in wh.tables().items():
            write_files(df, f"{folder}/{name}", ["_year"] if "_year" in df.columns else None)

    folder = VersionedFolder(wh.players.sparkSession, root).replace(write, force_rebuild)
    return {name: f"{folder}/{name}" for name in config.WAREHOUSE_TABLES}


def open_warehouse(spark, root: str, names=config.WAREHOUSE_TABLES) -> dict[str, DataFrame]:
    """Reopen the current tables; tables that are not there are left out. Any other
    failure (rights, broken files) is raised."""
    folder = VersionedFolder(spark, root).current() or root.rstrip("/")
    out = {}
    for name in names:
        try:
            out[name] = spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return out


def row_count_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table, ordered by name."""
    parts = [df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")
