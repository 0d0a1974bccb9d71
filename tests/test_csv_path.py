"""The CSV path (original file inputs) gives the same results as the bindings."""

import pytest
from pyspark.sql import functions as F

from boxstar.plans.recipes import STANDIN, Analysis
from boxstar.sources import bindings

SF = "/root/testdata/sf0.001"


def _to_csv(df, path):
    text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    (
        text.write.mode("overwrite")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, repr(x)) for x in t))


def _inputs(spark, tmp_path, change=lambda name, df: df):
    paths = {}
    for name, fn in (
        ("players", bindings.players_source),
        ("player_stats", bindings.player_stats_source),
        ("team_stats", bindings.team_stats_source),
    ):
        paths[name] = str(tmp_path / name)
        _to_csv(change(name, fn(spark, SF)), paths[name])
    return paths


def test_from_csv_reads_iso_times(spark, tmp_path):
    def iso(name, df):
        t = "gameDateTimeEst"
        return df.withColumn(t, F.regexp_replace(F.col(t).cast("string"), " ", "T")) if t in df.columns else df

    p = _inputs(spark, tmp_path, iso)
    got = Analysis.from_csv(spark, p["players"], p["player_stats"], p["team_stats"], params=STANDIN)
    direct = Analysis(spark, SF)
    assert _rows(got.top_teams()) == _rows(direct.top_teams())
    assert got.season_rows.count() == direct.season_rows.count() > 0


def test_from_csv_names_what_is_missing(spark, tmp_path):
    p = _inputs(spark, tmp_path, lambda name, df: df.drop("coachId"))
    with pytest.raises(FileNotFoundError, match="player_stats"):
        Analysis.from_csv(spark, p["players"], str(tmp_path / "no.csv"), p["team_stats"])
    with pytest.raises(ValueError, match="team_stats lacks columns: coachId"):
        Analysis.from_csv(spark, p["players"], p["player_stats"], p["team_stats"])


def test_from_csv_refuses_unreadable_times(spark, tmp_path):
    bad = lambda name, df: df.withColumn("gameDateTimeEst", F.lit("soon")) if "gameDateTimeEst" in df.columns else df
    p = _inputs(spark, tmp_path, bad)
    a = Analysis.from_csv(spark, p["players"], p["player_stats"], p["team_stats"], params=STANDIN)
    with pytest.raises(ValueError, match="soon"):
        a.top_teams()


def test_from_csv_matches_bindings(spark, tmp_path):
    paths = _inputs(spark, tmp_path)
    from_csv = Analysis.from_csv(spark, paths["players"], paths["player_stats"], paths["team_stats"], params=STANDIN)
    direct = Analysis(spark, SF)
    assert _rows(from_csv.row_counts()) == _rows(direct.row_counts())
    # seriesGameNumber passes through as read (text from CSV, integer from the bindings)
    as_text = F.col("seriesGameNumber").cast("string")
    assert _rows(from_csv.warehouse.player_stats_fact.withColumn("seriesGameNumber", as_text)) == _rows(
        direct.warehouse.player_stats_fact.withColumn("seriesGameNumber", as_text)
    )
    assert _rows(from_csv.warehouse.players) == _rows(direct.warehouse.players)
    assert from_csv.leaderboard().collect() == direct.leaderboard().collect()
