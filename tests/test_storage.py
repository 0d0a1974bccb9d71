"""Written tables are replaced in one step; landed tables go with their owner."""

import os

import pytest
from pyspark.sql import functions as F

from boxstar import config
from boxstar.plans import warehouse as W
from boxstar.plans.recipes import STANDIN, Analysis
from boxstar.session import Scratch, ensure_checkpoint_dir, land
from boxstar.sources.csvscan import read_box_csv
from boxstar.sources.landing import KEPT, VersionedFolder, read_table, write_table

SF = "/root/testdata/sf0.001"


def landed(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(folder) if n.startswith("boxstar-")}


def test_a_failed_write_leaves_the_former_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3).toDF("x"), path)
    broken = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("x"))
    with pytest.raises(Exception, match="stop"):
        write_table(broken, path)
    assert sorted(r.x for r in read_table(spark, path).collect()) == [0, 1, 2]
    assert len(os.listdir(path)) == 2  # the version and the pointer; nothing of the failed one
    with pytest.raises(FileExistsError):
        write_table(spark.range(9).toDF("x"), path, force_rebuild=False)
    write_table(spark.range(9).toDF("x"), str(tmp_path / "new"), force_rebuild=False)


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    opened = []
    for n in range(1, 6):
        write_table(spark.range(n).toDF("x"), path)
        opened.append(read_table(spark, path))
    assert opened[-1].count() == 5 and opened[-2].count() == 4  # a reader of the version before is not cut off
    store = VersionedFolder(spark, path)
    assert len(store.history()) == 5 and len(os.listdir(path)) == KEPT + 1
    # a table may be rebuilt from itself
    write_table(read_table(spark, path).where("x > 1"), path)
    assert sorted(r.x for r in read_table(spark, path).collect()) == [2, 3, 4]
    plain = str(tmp_path / "plain")
    spark.range(2).write.parquet(plain)
    assert read_table(spark, plain).count() == 2


def test_a_warehouse_is_of_one_age(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    a = Analysis(spark, SF)
    W.write_warehouse(a.warehouse, root)
    before = {n: df.inputFiles() for n, df in W.open_warehouse(spark, root).items()}
    assert set(before) == set(config.WAREHOUSE_TABLES)
    real, written = W.write_files, []

    def fail_in_the_fifth(df, path, partition_by=None):
        written.append(path)
        if len(written) == 5:
            raise RuntimeError("disk full")
        real(df, path, partition_by)

    monkeypatch.setattr(W, "write_files", fail_in_the_fifth)
    with pytest.raises(RuntimeError, match="disk full"):
        W.write_warehouse(a.warehouse, root)
    assert {n: df.inputFiles() for n, df in W.open_warehouse(spark, root).items()} == before
    monkeypatch.setattr(W, "write_files", real)
    with pytest.raises(FileExistsError):
        W.write_warehouse(a.warehouse, root, force_rebuild=False)
    # rebuilt from itself, and the tables move together
    again = Analysis.from_warehouse(spark, root, params=STANDIN)
    W.write_warehouse(again.warehouse, root)
    after = W.open_warehouse(spark, root)
    folders = {df.inputFiles()[0].split("/wh/")[1].split("/")[0] for df in after.values()}
    assert len(folders) == 1 and not any(set(df.inputFiles()) & set(before[n]) for n, df in after.items())
    assert after["players"].count() == a.warehouse.players.count()
    a.close()


def test_close_removes_what_an_analysis_has_landed(spark, tmp_path):
    before = landed(spark)
    kept = land(spark.range(3), "kept")
    a = Analysis(spark, SF)
    a.leaderboard().collect()
    a.audits()["team_rows_without_key"].collect()
    W.write_warehouse(a.warehouse, str(tmp_path / "wh"))
    assert len(landed(spark) - before) > 8
    a.close()
    assert {n.split("-")[1] for n in landed(spark) - before} == {"kept"} and kept.count() == 3
    assert W.open_warehouse(spark, str(tmp_path / "wh"))["players"].count() > 0
    with pytest.raises(ZeroDivisionError), Analysis(spark, SF) as b:
        b.top_teams().collect()
        raise ZeroDivisionError
    assert {n.split("-")[1] for n in landed(spark) - before} == {"kept"}


def test_failures_leave_nothing_landed(spark, tmp_path):
    before = landed(spark)
    with pytest.raises(Exception, match="stop"):
        land(spark.range(2).select(F.raise_error(F.lit("stop")).cast("int").alias("x")), "broken")
    (tmp_path / "p.csv").write_text('personId,firstName\n1,"two\nlines"\n')
    with pytest.raises(FileNotFoundError, match="player_stats"):
        Analysis.from_csv(spark, str(tmp_path / "p.csv"), str(tmp_path / "no.csv"), str(tmp_path / "none.csv"))
    assert landed(spark) == before


def test_scratch_owns_only_what_is_landed_while_active(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a\n"1\n2"\n')
    s, inner = Scratch(), Scratch()
    with s.active():
        df = read_box_csv(spark, str(tmp_path / "x.csv"))
        with inner.active():
            other = land(spark.range(2), "inner")
        one = land(spark.range(1), "one")
    assert [len(x.landed) for x in (s, inner)] == [2, 1]
    assert df.count() == 1 and one.count() == 1
    s.close()
    assert s.landed == [] and other.count() == 2
    inner.close()
