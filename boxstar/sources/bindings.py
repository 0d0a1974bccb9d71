"""Stand-in box-score sources built from the driver's TPC-H-style tables.

The original inputs are three CSV files (players, player statistics, team
statistics). The driver ships order/lineitem/customer tables instead, so
these functions derive frames of the same shape -- including the messy
text forms the cleaning steps exist for -- entirely with Spark joins and
expressions. Mapping (fixed values of the stand-in):

* player        = customer (personId = c_custkey), country from nation
* game          = order (gameId = o_orderkey, time = o_orderdate)
* player box    = lineitem JOIN orders JOIN customer
* team box      = lineitem summed per order, JOIN orders JOIN customer
* team name     = 'NATION_' || c_nationkey, city = c_mktsegment
* opponent name = 'NATION_' || ((c_nationkey + o_orderkey) % 30)
  (NATION_25..29 never resolve: exercises the foreign-key audit)
* win           = order status F -> 1, O -> 0, P -> NULL; home = o_orderkey % 2

All statistics are integer valued (or halves), so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstar.operators.ordered import default_parts
from boxstar.sources.csvscan import apply_na_tokens

# ---------------------------------------------------------------------------
# fixed values of the stand-in
# ---------------------------------------------------------------------------
# Flag text cycled by key: decodes to 1, 0, 1, 0, NULL, NULL (NA), 1.
FLAG_TEXT = ("True", "False", "1", "0", "TRUE", "", "true")
# Order priority -> raw game type text.
GAME_TYPE_TEXT = (
    ("1-URGENT", " Pre Season "),
    ("2-HIGH", "regular season"),
    ("3-MEDIUM", "in-season-knockout"),
    ("4-NOT SPECIFIED", "  "),
    ("5-LOW", " Playoffs "),
)
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def _pick(index: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


def players_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players file stand-in: one row per customer, text columns as read."""
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # a small file is read by one task: the rows are spread before their text is worked on
    c = c.repartition(default_parts(c), "c_custkey", "c_name")
    # nation has 25 rows at every scale factor: a broadcast is size-safe
    n = _read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    k = F.col("c_custkey")
    df = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"], "left").select(
        _s(k).alias("personId"),
        F.when(k % 19 == 0, F.lit("N/A")).otherwise(F.col("c_name")).alias("firstName"),
        F.col("c_mktsegment").alias("lastName"),
        F.when(k % 23 == 0, F.lit("unknown"))
        .otherwise(_s(F.date_add(F.lit("1970-01-01").cast("date"), (k * 37 % 12000).cast("int"))))
        .alias("birthDate"),
        F.when(k % 5 == 0, F.lit("None")).otherwise(F.concat(F.lit("School_"), _s(k % 40))).alias("school"),
        F.col("n_name").alias("country"),
        _s(F.lit(60) + k % 35).alias("heightInches"),
        _s(F.lit(100) + (k * 7) % 320).alias("bodyWeightLbs"),
        _pick(k % 7, FLAG_TEXT).alias("guard"),
        _pick((k + 2) % 7, FLAG_TEXT).alias("forward"),
        _pick((k + 5) % 7, FLAG_TEXT).alias("center"),
        F.when(k % 10 == 0, F.lit("-1")).when(k % 10 == 1, F.lit("-22")).otherwise(_s(F.lit(1980) + k % 45)).alias("draftYear"),
        F.when(k % 13 == 0, F.lit("NA")).otherwise(_s(F.lit(1) + k % 2)).alias("draftRound"),
        F.when(k % 9 == 0, F.lit("undrafted")).otherwise(_s(k % 61 - 1)).alias("draftNumber"),
    )
    return apply_na_tokens(df)


def _orders_with_customer(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", *extra)
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    # customer grows with the data: no hint, the planner / AQE choose the join
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left")


def _game_columns(ok: Column) -> list[Column]:
    status = F.col("o_orderstatus")
    game_type = None
    for prio, text in GAME_TYPE_TEXT:
        cond = F.col("o_orderpriority") == prio
        game_type = F.when(cond, F.lit(text)) if game_type is None else game_type.when(cond, F.lit(text))
    return [
        ok.alias("gameId"),
        F.date_format(F.col("o_orderdate"), TIMESTAMP_TEXT_FORMAT).alias("gameDateTimeEst"),
        game_type.alias("_gameType"),
        F.when(status == "F", F.lit(1)).when(status == "O", F.lit(0)).otherwise(F.lit(None).cast("int")).alias("win"),
        (ok % 2).cast("int").alias("home"),
    ]


def _line_stats() -> list[Column]:
    """Per-lineitem box-score numbers (all integer valued, as double)."""
    q = F.col("l_quantity")
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    d = lambda c: c.cast("double")
    fta = (pk + sk) % 5
    return [
        d(F.floor(F.col("l_extendedprice") / 1000.0)).alias("points"),
        d(F.round(F.col("l_discount") * 100.0, 0)).alias("assists"),
        d(pk % 5).alias("blocks"),
        d(F.round(F.col("l_tax") * 100.0, 0)).alias("steals"),
        d(q).alias("fieldGoalsAttempted"),
        d(F.floor(q / 2.0)).alias("fieldGoalsMade"),
        d(sk % 4 + pk % 3).alias("threePointersAttempted"),
        d(sk % 4).alias("threePointersMade"),
        d(fta).alias("freeThrowsAttempted"),
        d(F.floor(fta / 2.0)).alias("freeThrowsMade"),
        d(ln).alias("reboundsDefensive"),
        d(pk % 3).alias("reboundsOffensive"),
        d(ln + pk % 3).alias("reboundsTotal"),
        d(pk % 6).alias("foulsPersonal"),
        d(sk % 3).alias("turnovers"),
        d(sk % 21 - 10).alias("plusMinusPoints"),
    ]


def _minutes_text() -> Column:
    qi = F.col("l_quantity").cast("int")
    ln = F.col("l_linenumber")
    return (
        F.when(ln == 1, F.concat(_s(qi), F.lit(":00")))
        .when(ln == 2, F.concat(F.lit(" "), _s(qi), F.lit(" ")))
        .when(ln == 7, F.concat(_s(qi - 1), F.lit(":30")))
        .otherwise(_s(qi))
    )


def _pct(made: str, att: str) -> Column:
    return F.col(made) / F.nullif(F.col(att), F.lit(0.0))


def player_stats_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player statistics file stand-in: one row per lineitem."""
    li = _read(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    )
    oc = _orders_with_customer(spark, sf_dir)
    rows = li.join(oc, li["l_orderkey"] == oc["o_orderkey"], "inner")
    ok = F.col("o_orderkey")
    nk = F.col("c_nationkey")
    df = rows.select(
        F.col("o_custkey").alias("personId"),
        *_game_columns(ok),
        F.concat(F.lit("NATION_"), _s(nk)).alias("playerteamName"),
        F.concat(F.lit("NATION_"), _s((nk + ok) % 30)).alias("opponentteamName"),
        F.col("o_orderpriority").alias("gameLabel"),
        F.when(F.col("l_linenumber") == 1, F.lit("NA")).otherwise(F.col("l_returnflag")).alias("gameSubLabel"),
        F.col("l_linenumber").alias("seriesGameNumber"),
        _minutes_text().alias("numMinutes"),
        *_line_stats(),
    ).withColumnRenamed("_gameType", "gameType")
    df = df.select(
        *df.columns,
        _pct("fieldGoalsMade", "fieldGoalsAttempted").alias("fieldGoalsPercentage"),
        _pct("threePointersMade", "threePointersAttempted").alias("threePointersPercentage"),
        _pct("freeThrowsMade", "freeThrowsAttempted").alias("freeThrowsPercentage"),
    )
    return apply_na_tokens(df)


_TEAM_SUMS = (
    "points", "assists", "blocks", "steals", "fieldGoalsAttempted", "fieldGoalsMade",
    "threePointersAttempted", "threePointersMade", "freeThrowsAttempted", "freeThrowsMade",
    "reboundsDefensive", "reboundsOffensive", "reboundsTotal", "foulsPersonal", "turnovers",
    "plusMinusPoints",
)


def team_stats_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team statistics file stand-in: one row per order (the team's game)."""
    li = _read(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax",
    )
    per_line = li.select("l_orderkey", "l_linenumber", "l_quantity", *_line_stats())
    ln = F.col("l_linenumber")
    pts = F.col("points")
    # partial aggregation runs map-side; one shuffle on the order key
    box = per_line.groupBy("l_orderkey").agg(
        *[F.sum(c).alias(c) for c in _TEAM_SUMS],
        F.sum("l_quantity").alias("_minutes"),
        F.sum(F.when(ln.isin(1, 5), pts).otherwise(0.0)).alias("q1Points"),
        F.sum(F.when(ln.isin(2, 6), pts).otherwise(0.0)).alias("q2Points"),
        F.sum(F.when(ln.isin(3, 7), pts).otherwise(0.0)).alias("q3Points"),
        F.sum(F.when(ln == 4, pts).otherwise(0.0)).alias("q4Points"),
        F.sum(F.when(ln >= 4, pts).otherwise(0.0)).alias("benchPoints"),
    )
    oc = _orders_with_customer(spark, sf_dir, ("o_totalprice",))
    rows = box.join(oc, box["l_orderkey"] == oc["o_orderkey"], "inner")
    ok = F.col("o_orderkey")
    nk = F.col("c_nationkey")
    d = lambda c: c.cast("double")
    df = rows.select(
        *_game_columns(ok),
        F.concat(F.lit("NATION_"), _s(nk)).alias("teamName"),
        F.when(ok % 11 == 0, F.lit("NULL")).otherwise(F.col("c_mktsegment")).alias("teamCity"),
        F.concat(F.lit("NATION_"), _s((nk + ok) % 30)).alias("opponentTeamName"),
        d(F.col("c_custkey")).alias("coachId"),
        F.col("points").alias("teamScore"),
        d(F.floor(F.col("o_totalprice") / 2000.0)).alias("opponentScore"),
        *[F.col(c) for c in _TEAM_SUMS if c != "points"],
        _pct("fieldGoalsMade", "fieldGoalsAttempted").alias("fieldGoalsPercentage"),
        _pct("threePointersMade", "threePointersAttempted").alias("threePointersPercentage"),
        _pct("freeThrowsMade", "freeThrowsAttempted").alias("freeThrowsPercentage"),
        F.concat(_s(F.col("_minutes").cast("int")), F.lit(":00")).alias("numMinutes"),
        "q1Points", "q2Points", "q3Points", "q4Points", "benchPoints",
        d(ok % 25).alias("biggestLead"),
        d(ok % 13).alias("biggestScoringRun"),
        d(ok % 17).alias("leadChanges"),
        F.col("steals").alias("pointsFastBreak"),
        (F.col("turnovers") * 2.0).alias("pointsFromTurnovers"),
        ((F.col("fieldGoalsMade") - F.col("threePointersMade")) * 2.0).alias("pointsInThePaint"),
        F.col("reboundsOffensive").alias("pointsSecondChance"),
        d(ok % 7).alias("timesTied"),
        d(ok % 4).alias("timeoutsRemaining"),
        d(F.col("o_custkey") % 60).alias("seasonWins"),
        d(F.col("o_custkey") % 50).alias("seasonLosses"),
    ).drop("_gameType")
    return apply_na_tokens(df)
