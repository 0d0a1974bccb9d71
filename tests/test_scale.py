"""What must not grow faster than the box rows: how rows are landed, read and dealt out."""

import re

import pytest
from pyspark.sql import functions as F

from boxstar import config
from boxstar.operators.keys import FEW_PARTS, PART_ROWS, place_parts
from boxstar.plans import audits
from boxstar.plans.recipes import Analysis
from boxstar.plans.warehouse import Warehouse
from boxstar.session import Scratch, land
from boxstar.sources import bindings
from boxstar.sources.landing import write_files
from tests.test_plans import box_tables, nodes, plan

SF = "/root/testdata/sf0.001"
RAW = {"players_raw", "player_stats_raw", "team_stats_raw"}


def rows_of_two_years(spark):
    return spark.range(0, 400, 1, 4).select("id", (F.lit(2000) + F.col("id") % 2).cast("int").alias("_year"))


def test_landed_rows_stay_in_their_tasks(spark):
    owner = Scratch()
    with owner.active():
        df = land(rows_of_two_years(spark), "years", partition_by="_year")
    # a file for each task and year, in the order of the task: nothing was dealt out or sorted by year
    assert len(df.inputFiles()) == 8
    assert df.count() == 400 and df.where("_year = 2001").agg(F.sum("id")).first()[0] == sum(range(1, 400, 2))
    owner.close()


def test_partitioned_writes_leave_the_session_as_it_was(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    write_files(rows_of_two_years(spark), str(tmp_path / "a"), ["_year"])
    with pytest.raises(Exception, match="stop"):
        write_files(spark.range(1).select(F.raise_error(F.lit("stop")).cast("int").alias("x"), F.lit(1).alias("_year")), str(tmp_path / "b"), ["_year"])
    assert spark.conf.get(name, None) == before
    assert spark.read.parquet(str(tmp_path / "a")).count() == 400
    # more years than open files
    many = spark.range(0, 900, 1, 2).select("id", (F.col("id") % 150).cast("int").alias("_year"))
    write_files(many, str(tmp_path / "c"), ["_year"])
    back = spark.read.parquet(str(tmp_path / "c"))
    assert back.exceptAll(many.select(back.columns)).count() == 0 and back.count() == 900


def test_people_are_spread_before_their_text_is_worked_on(spark):
    people = bindings.players_source(spark, SF)
    parts = people.select("personId", F.spark_partition_id().alias("p")).distinct().groupBy("p").count().count()
    assert parts > 1  # the file is read by one task


def test_dimensions_and_narrow_readers_do_not_build_statistics(spark):
    with Analysis(spark, SF) as a, Analysis(spark, SF) as whole:
        assert RAW <= set(whole.warehouse.tables())
        wh = a.warehouse
        top = a.top_teams().collect()
        several = audits.active_multi_position(wh.players, wh.game_rows("player_stats_raw"), a.params.active_years).collect()
        made = {n: sorted(getattr(wh, n).collect(), key=str) for n in ("teams", "games", "dates")}
        assert set(wh.__dict__) & RAW == {"players_raw"}
        w = whole.warehouse
        assert w.game_rows("player_stats_raw") is w.player_stats_raw
        assert top == whole.top_teams().collect()
        assert several == audits.active_multi_position(w.players, w.player_stats_raw, a.params.active_years).collect()
        assert all(rows == sorted(getattr(w, n).collect(), key=str) for n, rows in made.items())
        narrow = wh.game_rows("player_stats_raw")
        assert set(narrow.columns) <= {*config.GAME_COLUMNS, "_year"} and narrow.count() == w.player_stats_raw.count()


def test_whole_rows_are_not_sorted_for_large_dimensions(spark):
    players, box, team = box_tables(spark)
    raw = {"players_raw": players, "player_stats_raw": box, "team_stats_raw": team}
    wh = Warehouse({n: (lambda df=df: df) for n, df in raw.items()}, direct_rows=0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(wh.player_stats_fact)
        assert "ShuffledHashJoin" in text
        assert not [m for m in nodes(wh.player_stats_fact, "Sort") if "points" in m]
        # large dimensions alone go through the keys; what is small meets the whole rows first
        wh.direct_rows = 2
        assert re.findall("ShuffledHashJoin", plan(wh.player_fact()))
        direct = Warehouse({n: (lambda df=df: df) for n, df in raw.items()}, direct_rows=10**9)
        for a, b in ((wh.player_fact(), direct.player_fact()), (wh.team_fact(), direct.team_fact())):
            assert a.columns == b.columns and a.count() == b.count()
            assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_partitions_for_places():
    assert place_parts(10, 8) == 8
    assert place_parts(10**8, 600) == FEW_PARTS
    assert place_parts(PART_ROWS * 300, 8) == 300
