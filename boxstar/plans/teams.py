"""Team analyses: win/loss drivers, recent ranking, one team's profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstar import config
from boxstar.functions.numeric import round_half_away


def win_loss_summary(team_fact: DataFrame) -> DataFrame:
    """Average team box score in wins and in losses (percentages x100)."""
    aggs = []
    for c, pct in config.WIN_LOSS_COLUMNS:
        a = F.avg(c)
        aggs.append((a * F.lit(100.0) if pct else a).alias(c))
    return team_fact.where(F.col("win").isin(0, 1)).groupBy("win").agg(*aggs).orderBy("win")


def top_teams(
    team_fact: DataFrame,
    teams: DataFrame,
    since_year: int = config.TOP_TEAMS_SINCE_YEAR,
    min_games: int = config.TOP_TEAMS_MIN_GAMES,
    limit: int = config.TOP_TEAMS_LIMIT,
) -> DataFrame:
    """Win % (NULL win counts as a loss) since ``since_year``, top ``limit`` teams.

    ``team_fact`` holds the rows since that year (``Warehouse.team_fact``)."""
    pct_col = f"win_pct_{since_year}_plus"
    rows = (
        team_fact.select("teamKey", "win")
        .join(teams.select("teamKey", "teamName", "teamCity"), "teamKey", "inner")
        .where(F.col("teamCity").isNotNull())
    )
    won = F.when(F.col("win") == 1, F.lit(1.0)).otherwise(F.lit(0.0))
    agg = (
        rows.groupBy("teamName", "teamCity")
        .agg(round_half_away(F.avg(won) * F.lit(100.0), 2).alias(pct_col), F.count(F.lit(1)).alias("games_count"))
        .where(F.col("games_count") >= min_games)
    )
    # the name breaks ties the original left undefined
    return agg.orderBy(F.col(pct_col).desc(), F.col("games_count").desc(), F.col("teamName").asc()).limit(limit)


def team_profile(
    team_fact: DataFrame,
    teams: DataFrame,
    team_name: str = config.PROFILE_TEAM,
) -> DataFrame:
    """One row: the team's average box score in its wins among ``team_fact``."""
    named = teams.where(F.lower(F.col("teamName")) == team_name.lower()).select("teamKey")
    rows = team_fact.where(F.col("win") == 1).join(named, "teamKey", "inner")
    return rows.agg(*[F.avg(c).alias(c) for c, _ in config.COUNT_LABELS])


def winning_drivers(spark, win_loss: DataFrame) -> DataFrame:
    """Per metric: Win and Loss averages, label, kind and gap (Win - Loss, counts only)."""
    metrics = [c for c, _ in config.COUNT_LABELS] + [c for c, _ in config.PCT_LABELS]
    labels = spark.createDataFrame(
        [(c, lbl, "count", i) for i, (c, lbl) in enumerate(config.COUNT_LABELS)]
        + [(c, lbl, "pct", i) for i, (c, lbl) in enumerate(config.PCT_LABELS)],
        "metric string, label string, kind string, _ord int",
    )
    long = win_loss.unpivot("win", metrics, "metric", "value")
    wide = long.groupBy("metric").pivot("win", [1, 0]).agg(F.first("value"))
    wide = wide.withColumnRenamed("1", "Win").withColumnRenamed("0", "Loss")
    out = wide.join(F.broadcast(labels), "metric", "inner")
    gap = F.when(F.col("kind") == "count", F.col("Win") - F.col("Loss"))
    return out.select("metric", "label", "kind", "Win", "Loss", gap.alias("gap"), "_ord").orderBy(
        F.col("kind"), F.col("gap").asc_nulls_last(), "_ord"
    ).drop("_ord")


def team_vs_history(spark, win_loss: DataFrame, profile: DataFrame) -> DataFrame:
    """Per counting stat: winning average, losing average, the team's average in wins."""
    metrics = [c for c, _ in config.COUNT_LABELS]
    labels = spark.createDataFrame(
        [(c, lbl, i) for i, (c, lbl) in enumerate(config.COUNT_LABELS)], "metric string, stat string, _ord int"
    )
    hist = (
        win_loss.unpivot("win", metrics, "metric", "value")
        .groupBy("metric")
        .agg(
            F.max(F.when(F.col("win") == 1, F.col("value"))).alias("winning_avg"),
            F.max(F.when(F.col("win") == 0, F.col("value"))).alias("losing_avg"),
        )
    )
    team = profile.withColumn("_k", F.lit(1)).unpivot("_k", metrics, "metric", "team_wins_avg").drop("_k")
    return (
        labels
        .join(hist, "metric", "left")
        .join(team, "metric", "left")
        .orderBy("_ord")
        .select("stat", "metric", "winning_avg", "losing_avg", "team_wins_avg")
    )


def ranked_team_labels(top: DataFrame, pct_col: str) -> DataFrame:
    """Top teams with their chart label ``city name`` (NULL-propagating)."""
    return top.select(
        F.concat(F.col("teamCity"), F.lit(" "), F.col("teamName")).alias("label"),
        "teamName",
        "teamCity",
        pct_col,
        "games_count",
    ).orderBy(F.col(pct_col).desc(), F.col("games_count").desc(), "teamName")
