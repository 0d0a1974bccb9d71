"""What moves: plans of the recipes that read every box row."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from boxstar.operators import through_keys
from boxstar.plans import audits, pool
from boxstar.plans.recipes import Analysis
from boxstar.plans.warehouse import Warehouse, build_warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    return Analysis(spark, SF)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def nodes(df, name):
    """The columns that each node called ``name`` gets, from the formatted plan."""
    found = re.findall(rf"\(\d+\) {name}\n(?:Input|Left output)[^\n]*\[([^\n]*)\]", plan(df))
    return [{c.split("#")[0].strip() for c in f.split(",")} for f in found]


def box_tables(spark, people=((1, "A"), (2, "B"), (2, "B2"), (3, "C")), games=(10, 11)):
    times = ["2020-11-01 10:00:00", "2020-11-02 10:00:00", None]
    box = [(1, 10, "x", "y", 0), (2, 10, "x", "y", 0), (2, 11, "x", "z", 1), (9, 11, None, "y", 1), (None, 12, "y", "x", 2), (2, None, "q", "x", 0)]
    from boxstar import config

    stats = "".join(f", {c} double" for c in config.BOX_STATS)
    rows = [(p, g, t, o, times[k], "Regular", None, None, "1", 1, 1, 12.0, *[1.0] * len(config.BOX_STATS)) for p, g, t, o, k in box]
    player_stats = spark.createDataFrame(
        rows, "personId long, gameId long, playerteamName string, opponentteamName string, gameDateTimeEst string, gameType string, "
        "gameLabel string, gameSubLabel string, seriesGameNumber string, win int, home int, numMinutes double" + stats)
    team_stats = spark.createDataFrame(
        [(g, t, "City", o, times[0], 1, 1, 1.0, *[1.0] * len(config.TEAM_STATS)) for g, t, o in [(10, "x", "y"), (11, "y", "x"), (13, "x", "w"), (None, "y", None)]],
        "gameId long, teamName string, teamCity string, opponentTeamName string, gameDateTimeEst string, home int, win int, coachId double"
        + "".join(f", {c} double" for c in config.TEAM_STATS))
    typed = {n: t for n, t in config.PLAYER_COLUMNS}
    players = spark.createDataFrame([(p, n) for p, n in people], "personId long, firstName string")
    players = players.select("*", *[F.lit(None).cast(t).alias(n) for n, t in typed.items() if n not in players.columns])
    return players, player_stats, team_stats


def test_pool_moves_sums_and_games_apart(small, no_broadcast):
    wh = small.warehouse
    seasons = pool.season_aggregates(wh.player_stats_raw, wh.players, 1, 1)
    moved = nodes(seasons, "Exchange")
    assert any("_gid" in m for m in moved) and any("sum" in m for m in moved)
    assert not any("_gid" in m and "sum" in m for m in moved)
    # box rows themselves never move: only three ids, or one row for each season and task
    assert all(not {"numMinutes", "points"} & m for m in moved)


def test_pool_counts_a_game_once(spark):
    players, box, _ = box_tables(spark)
    twice = box.unionByName(box)
    got = pool.season_aggregates(twice.withColumn("gameDateTimeEst", F.col("gameDateTimeEst").cast("timestamp_ntz")),
                                 players.withColumn("playerKey", F.monotonically_increasing_id()), 0, 0)
    rows = sorted((r.firstName, r.games_played, r.total_minutes) for r in got.collect())
    assert rows == [("A", 1, 24.0), ("B", 2, 72.0), ("B2", 2, 72.0)]


def test_key_audits_do_not_build_the_fact(small, no_broadcast):
    for df in (audits.missing_player_fact_keys(small.warehouse), audits.missing_team_fact_keys(small.warehouse)):
        text = plan(df)
        joins = [n for n in re.findall(r"\(\d+\) (\w+Join)", text)]
        assert joins and not any({"personId", "gameId", "gameDateTimeEst", "points"} & m for m in nodes(df, "SortMergeJoin"))
        assert all(len(m) <= 3 for m in nodes(df, "Exchange"))


@pytest.mark.parametrize("people", [((1, "A"), (2, "B"), (2, "B2"), (3, "C")), ((1, "A"), (2, "B")), ()])
def test_key_audits_equal_the_built_fact(spark, people):
    players, box, team = box_tables(spark, people)
    wh = build_warehouse(players, box, team)
    for narrow, facts in ((wh.player_stats_fact, audits.missing_player_fact_keys(wh)), (wh.team_stats_fact, audits.missing_team_fact_keys(wh))):
        rows = narrow.collect()
        got = facts.first().asDict()
        assert got == {f"missing_{k.lower()}": sum(r[k] is None for r in rows) for k in narrow.columns if k.endswith("Key")}
    none = build_warehouse(players, box.limit(0), team)
    assert set(audits.missing_player_fact_keys(none).first().asDict().values()) == {None}
    stored = Warehouse({}, stored=wh.tables())
    assert audits.missing_player_fact_keys(stored).first() == audits.missing_player_fact_keys(wh).first()


def test_large_dimensions_move_whole_rows_once(spark, small, no_broadcast):
    wh = small.warehouse
    raw = {n: getattr(wh, n) for n in ("players_raw", "player_stats_raw", "team_stats_raw")}
    direct, narrow = (Warehouse({n: (lambda df=df: df) for n, df in raw.items()}, direct_rows=n) for n in (10**9, 0))
    wide = [m for m in nodes(direct.player_stats_fact, "Exchange") if "points" in m]
    once = [m for m in nodes(narrow.player_stats_fact, "Exchange") if "points" in m]
    assert len(wide) >= 4 and len(once) == 1
    assert len([m for m in nodes(narrow.team_stats_fact, "Exchange") if "assists" in m]) == 1
    for name in ("player_stats_fact", "team_stats_fact"):
        a, b = getattr(direct, name), getattr(narrow, name)
        assert a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).count() == 0
    players, box, team = box_tables(spark)
    a, b = (build_warehouse(players, box, team) for _ in range(2))
    b.direct_rows = 0
    assert a.player_stats_fact.exceptAll(b.player_stats_fact).count() == 0 == b.player_stats_fact.exceptAll(a.player_stats_fact).count()


def test_through_keys_repeats_and_drops(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "d")], "k long, wide string")
    dim = spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "k2 long, found long")
    out = through_keys(df, {"_k": F.col("k")}, lambda r: r.join(dim, r["_k"] == dim["k2"], "inner").drop("k2"))
    assert sorted(map(tuple, out.collect())) == [(1, "a", 10), (2, "b", 20), (2, "b", 20), (2, "b", 21), (2, "b", 21)]
