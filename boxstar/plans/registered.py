"""Queries registered with the driver: Spark builders over the driver tables.

Every query reads the driver's tables (through the stand-in bindings or
directly) and returns a lazy DataFrame; the matching DuckDB SQL lives in
``oracle.sql``. Float columns listed in ``ROUNDED`` are rounded to six
places on both sides (half away from zero on the binary value), so
summation order cannot change the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstar import config
from boxstar.functions.cleaning import parse_minutes
from boxstar.functions.numeric import round_half_away
from boxstar.operators.ordered import dense_key, dense_rank_by, exact_quantiles, percentile_rank_by
from boxstar.plans import audits, teams, tiers
from boxstar.plans.recipes import Analysis
from boxstar.plans.warehouse import open_warehouse, row_count_summary, write_warehouse
from boxstar.session import scratch_path
from boxstar.sources.csvscan import read_box_csv
from boxstar.sources.landing import read_table, write_table

_CACHE: dict[tuple[str, str], Analysis] = {}


def analysis(spark: SparkSession, sf_dir: str, fresh: bool = False) -> Analysis:
    """One Analysis per (application, input folder); ``fresh`` rebuilds it, as is
    needed when the input files change in place."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if fresh or key not in _CACHE:
        _CACHE[key] = Analysis(spark, sf_dir)
    return _CACHE[key]


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: round_half_away(F.col(c), 6) for c in cols}) if cols else df


POOL_COLS = (
    "season_end_year", "playerKey", "firstName", "lastName", "games_played", "total_minutes",
    "pts36", "ast36", "stl36", "blk36", "tpm36", "three_pa_total", "tpa36", "dreb36", "oreb36",
    "tov36", "field_goal_attempts", "fg_pct", "tp_pct", "player", "season_label",
)
SIGNALS = ("creator_signal", "wing_signal", "big_signal")
PILLAR_COLS = tuple(p for p, _ in config.PILLARS)
SCORE_COLS = ("season_end_year", "playerKey", "role", *PILLAR_COLS, "overall_score",
              "historical_percentile_within_role", "historical_rank_within_role", "historical_pool_size", "reb36")
ACTIVE_COLS = ("season_end_year", "playerKey", "player", "season_label", "role", "total_minutes", "games_played",
               "overall_score", "historical_percentile_within_role", "current_rank_overall", "current_rank_within_role")
TIER_COLS = tuple(f"{m}_tier" for m, _ in config.BENCHMARK_METRICS)
WL_COLS = tuple(c for c, _ in config.WIN_LOSS_COLUMNS)


# -- sources and cleaning ------------------------------------------------------------------

def q_csv_scan_na(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.col("p_partkey")
    text = part.select(
        k.cast("string").alias(" p_partkey"),
        F.when(k % 17 == 0, F.concat(F.col("p_name"), F.lit(' "q", x')))
        .when(k % 19 == 0, F.concat(F.col("p_name"), F.lit("\nsecond, line")))
        .otherwise(F.col("p_name")).alias("p_name "),
        F.when(k % 7 == 0, F.lit("NA")).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(k % 11 == 0, F.lit("null")).when(k % 13 == 0, F.lit("")).otherwise(F.col("p_type")).alias("p_type"),
        F.col("p_size").cast("string").alias("p_size"),
        F.col("p_retailprice").cast("string").alias("p_retailprice"),
    )
    path = scratch_path(spark, "csv")
    text.write.mode("overwrite").option("header", "true").option("quote", '"').option("escape", '"').csv(path)
    back = read_box_csv(spark, path)
    return back.select(
        F.col("p_partkey").try_cast("long").alias("p_partkey"),
        "p_name",
        "p_brand",
        "p_type",
        F.col("p_size").try_cast("int").alias("p_size"),
        F.col("p_retailprice").try_cast("double").alias("p_retailprice"),
    )


def q_landing_roundtrip(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    path = scratch_path(spark, "landing")
    write_table(orders, path, force_rebuild=True)
    write_table(orders, path, force_rebuild=True)  # overwrite, not append
    return read_table(spark, path)


def q_parse_minutes(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    q = F.col("l_quantity").cast("int").cast("string")
    ln = F.col("l_linenumber")
    bad = F.col("l_partkey") % 5
    text = (
        F.when(ln == 1, F.concat(q, F.lit(":00")))
        .when(ln == 2, F.concat(F.lit("  "), q, F.lit(" ")))
        .when(ln == 3, F.concat((F.col("l_quantity").cast("int") - 1).cast("string"), F.lit(":30")))
        .when(ln == 4, F.concat(q, F.lit(".5")))
        .when(ln == 5, F.concat(F.lit("-"), q, F.lit(":15")))
        .when((ln == 6) & (bad == 0), F.concat(q, F.lit(":34:56")))
        .when((ln == 6) & (bad == 1), F.concat(q, F.lit("d")))
        .when((ln == 6) & (bad == 2), F.lit(":30"))
        .when((ln == 6) & (bad == 3), F.concat(q, F.lit(":")))
        .when(ln == 6, F.lit("abc"))
        .otherwise(F.concat(q, F.lit("e0")))
    )
    return li.select("l_orderkey", "l_linenumber", text.alias("text")).withColumn("minutes", parse_minutes("text"))


def q_clean_people(spark, sf_dir):
    a = analysis(spark, sf_dir)
    return a.players_raw.select(
        F.col("personId"),
        "firstName",
        "lastName",
        F.col("birthdate").cast("date").alias("birthdate"),
        "lastAttended",
        "country",
        "height",
        "bodyWeight",
        "guard",
        "forward",
        "center",
        "draftYear",
        "draftRound",
        "draftNumber",
    )


# -- warehouse --------------------------------------------------------------------------------

def q_dim_people(spark, sf_dir):
    return analysis(spark, sf_dir).warehouse.players


def q_dim_teams(spark, sf_dir):
    return analysis(spark, sf_dir).warehouse.teams


def q_team_lookup(spark, sf_dir):
    return analysis(spark, sf_dir).warehouse.team_lookup


def q_dim_games(spark, sf_dir):
    return analysis(spark, sf_dir).warehouse.games


def q_dim_dates(spark, sf_dir):
    return analysis(spark, sf_dir).warehouse.dates


def q_fact_player(spark, sf_dir):
    return analysis(spark, sf_dir).warehouse.player_stats_fact


def q_fact_team(spark, sf_dir):
    return analysis(spark, sf_dir).warehouse.team_stats_fact


def q_row_count_summary(spark, sf_dir):
    # write the nine tables, reopen them, count what is there
    root = scratch_path(spark, "warehouse")
    write_warehouse(analysis(spark, sf_dir).warehouse, root, force_rebuild=True)
    return row_count_summary(open_warehouse(spark, root))


# -- audits -----------------------------------------------------------------------------------

def q_duplicate_key_audit_players(spark, sf_dir):
    wh = analysis(spark, sf_dir).warehouse
    return audits.duplicate_keys(wh.players, "personId", "total_rows", "distinct_person_ids", "duplicate_person_id_rows")


def q_duplicate_key_audit_games(spark, sf_dir):
    wh = analysis(spark, sf_dir).warehouse
    return audits.duplicate_keys(wh.games, "gameId", "total_rows", "distinct_game_ids", "duplicate_game_id_rows")


def q_duplicate_key_audit_lineitem(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return audits.duplicate_keys(li, "l_orderkey", "total_rows", "distinct_keys", "duplicate_key_rows")


def q_ambiguous_name_audit(spark, sf_dir):
    return audits.ambiguous_team_names(analysis(spark, sf_dir).warehouse.teams)


def q_ambiguous_name_history(spark, sf_dir):
    # the same audit one step earlier: (name, city) pairs before the latest-city pick
    raw = analysis(spark, sf_dir).team_stats_raw
    history = raw.groupBy("teamName", "teamCity").agg(F.max("coachId").alias("coachId"))
    return audits.ambiguous_team_names(history)


def q_missing_fk_player(spark, sf_dir):
    return audits.missing_player_fact_keys(analysis(spark, sf_dir).warehouse)


def q_missing_fk_team(spark, sf_dir):
    return audits.missing_team_fact_keys(analysis(spark, sf_dir).warehouse)


def q_flag_distribution(spark, sf_dir):
    return audits.position_flag_distribution(analysis(spark, sf_dir).warehouse.players)


def q_active_multi_flag(spark, sf_dir):
    a = analysis(spark, sf_dir)
    wh = a.warehouse
    return audits.active_multi_position(wh.players, wh.game_rows("player_stats_raw"), a.params.active_years)


# -- team analyses ----------------------------------------------------------------------------

def q_win_loss_summary(spark, sf_dir):
    return _round(analysis(spark, sf_dir).win_loss, WL_COLS)


def q_top_teams(spark, sf_dir):
    return analysis(spark, sf_dir).top_teams()


def q_team_profile(spark, sf_dir):
    return _round(analysis(spark, sf_dir).team_profile(), [c for c, _ in config.COUNT_LABELS])


def q_driver_gap_table(spark, sf_dir):
    a = analysis(spark, sf_dir)
    return _round(teams.winning_drivers(spark, a.win_loss), ("Win", "Loss", "gap"))


def q_team_vs_history(spark, sf_dir):
    a = analysis(spark, sf_dir)
    out = teams.team_vs_history(spark, a.win_loss, a.team_profile())
    return _round(out, ("winning_avg", "losing_avg", "team_wins_avg"))


def q_top_team_labels(spark, sf_dir):
    a = analysis(spark, sf_dir)
    return teams.ranked_team_labels(a.top_teams(), f"win_pct_{a.params.top_since_year}_plus")


# -- player benchmarks ------------------------------------------------------------------------

def q_player_season_pool(spark, sf_dir):
    return _round(analysis(spark, sf_dir).pool.select(*POOL_COLS), ("fg_pct", "tp_pct"))


def q_role_assignment(spark, sf_dir):
    r = analysis(spark, sf_dir).roles
    return _round(r.select("season_end_year", "playerKey", *SIGNALS, "role"), SIGNALS)


def q_pillar_scores(spark, sf_dir):
    s = analysis(spark, sf_dir).scored
    return _round(s.select(*SCORE_COLS), (*PILLAR_COLS, "overall_score", "historical_percentile_within_role", "reb36"))


def q_role_benchmarks(spark, sf_dir):
    b = analysis(spark, sf_dir).benchmarks
    return _round(b.select("role", "metric", "label", "p50", "p75", "p95", "pool_size"), ("p50", "p75", "p95"))


def q_active_pool(spark, sf_dir):
    a = analysis(spark, sf_dir).active
    return _round(a.select(*ACTIVE_COLS), ("overall_score", "historical_percentile_within_role"))


def q_metric_tiers(spark, sf_dir):
    t = analysis(spark, sf_dir).metric_tiers
    return t.select("playerKey", "season_end_year", "role", *TIER_COLS)


def q_overall_tier(spark, sf_dir):
    t = analysis(spark, sf_dir).active_tiers
    return t.select("playerKey", "season_end_year", "role", "overall_tier")


def q_season_window_label(spark, sf_dir):
    return analysis(spark, sf_dir).window_label()


def q_benchmark_matrix(spark, sf_dir):
    b = tiers.benchmark_matrix(analysis(spark, sf_dir).benchmarks)
    return _round(b, ("p50", "p75", "p95"))


def q_tier_distribution(spark, sf_dir):
    return analysis(spark, sf_dir).tier_distribution()


def q_leaderboard(spark, sf_dir):
    return _round(analysis(spark, sf_dir).leaderboard(), ("historical_percentile",))


# -- operators on whole driver tables --------------------------------------------------------
# Several range partitions even on the small test tables.
CHECK_PARTS = 8


def q_bucketed_key(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    return dense_key(o, "o_orderkey", "order_key", parts=CHECK_PARTS)


def q_bucketed_key_text(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    return dense_key(c, "c_name", "name_key", parts=CHECK_PARTS)


def q_bucketed_key_dates(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_shipdate").distinct()
    return dense_key(li, "l_shipdate", "ship_key", parts=CHECK_PARTS)


def q_bucketed_percentile_rank(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    pct = percentile_rank_by(li, ["l_returnflag"], "l_extendedprice", True, "pct", parts=CHECK_PARTS)
    return _round(li.join(pct, ["l_returnflag", "l_extendedprice"], "left"), ("pct",))


def q_bucketed_dense_rank(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_linestatus", "l_quantity")
    dr = dense_rank_by(li, ["l_linestatus"], "l_quantity", True, "qty_rank", parts=CHECK_PARTS)
    return li.join(dr, ["l_linestatus", "l_quantity"], "left")


def q_exact_quantiles(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_extendedprice")
    q = exact_quantiles(
        li, ["l_returnflag"], "l_extendedprice", [("p50", 0.5), ("p75", 0.75), ("p95", 0.95)], "n",
        parts=CHECK_PARTS,
    )
    return _round(q, ("p50", "p75", "p95"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name.removeprefix("q_"): fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

ROUNDED: dict[str, tuple[str, ...]] = {
    "win_loss_summary": WL_COLS,
    "team_profile": tuple(c for c, _ in config.COUNT_LABELS),
    "driver_gap_table": ("Win", "Loss", "gap"),
    "team_vs_history": ("winning_avg", "losing_avg", "team_wins_avg"),
    "player_season_pool": ("fg_pct", "tp_pct"),
    "role_assignment": SIGNALS,
    "pillar_scores": (*PILLAR_COLS, "overall_score", "historical_percentile_within_role", "reb36"),
    "role_benchmarks": ("p50", "p75", "p95"),
    "active_pool": ("overall_score", "historical_percentile_within_role"),
    "benchmark_matrix": ("p50", "p75", "p95"),
    "leaderboard": ("historical_percentile",),
    "bucketed_percentile_rank": ("pct",),
    "exact_quantiles": ("p50", "p75", "p95"),
}

__all__ = ["QUERIES", "ROUNDED", "analysis"]
