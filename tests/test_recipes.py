"""Recipe-level checks: tiers rule, CSV scan, guards, audits, warehouse properties."""

import os

import pytest
from pyspark.sql import functions as F

from boxstar import config
from boxstar.plans import tiers
from boxstar.plans.recipes import STANDIN, Analysis
from boxstar.sources.csvscan import read_box_csv

SF = "/root/testdata/sf0.001"


def _tier_row(role, key, others):
    metrics = [m for m, _ in config.BENCHMARK_METRICS]
    keys = dict(config.ROLE_KEY_METRICS)[role]
    row = {"role": role}
    ki = iter(key)
    oi = iter(others)
    for m in metrics:
        row[f"{m}_tier"] = next(ki) if m in keys else next(oi)
    return row


@pytest.mark.parametrize(
    "key,others,expected",
    [
        (("95", "95", "Low"), ("Low", "Low", "Low"), "95"),
        (("95", "Low", "Low"), ("75", "75", "Low"), "95"),
        (("75", "75", "Low"), ("Low", "Low", "Low"), "75"),
        (("75", "Low", "Low"), ("75", "75", "Low"), "75"),
        (("50", "Low", "Low"), ("Low", "Low", "Low"), "50"),
        (("Low", "Low", "Low"), ("Low", "Low", "Low"), "Low"),
        (("Low", "Low", "Low"), ("95", "95", "95"), "Low"),
    ],
)
@pytest.mark.parametrize("role", ["Creator", "Wing", "Big"])
def test_overall_tier_rule(spark, role, key, others, expected):
    df = spark.createDataFrame([_tier_row(role, key, others)])
    assert tiers.overall_tier(df).first()["overall_tier"] == expected


def test_csv_scan_quotes_header_na(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text(' a , b ,c\n"x ""q"", y",NA,1\n,None,\n"",null,  \n')
    df = read_box_csv(spark, str(p))
    assert df.columns == ["a", "b", "c"]
    rows = df.collect()
    assert rows[0]["a"] == 'x "q", y' and rows[0]["b"] is None and rows[0]["c"] == "1"
    assert rows[1]["a"] is None and rows[1]["b"] is None and rows[1]["c"] is None
    assert rows[2]["a"] is None and rows[2]["b"] is None and rows[2]["c"] == "  "


@pytest.fixture(scope="module")
def small(spark):
    return Analysis(spark, SF)


def test_keys_are_dense(small):
    wh = small.warehouse
    for df, key in ((wh.players, "playerKey"), (wh.games, "gameKey"), (wh.dates, "dateKey"), (wh.teams, "teamKey")):
        keys = sorted(r[0] for r in df.select(key).collect())
        assert keys == list(range(1, len(keys) + 1))


def test_fact_rows_equal_raw_rows(small):
    wh = small.warehouse
    assert wh.player_stats_fact.count() == wh.player_stats_raw.count()
    assert wh.team_stats_fact.count() == wh.team_stats_raw.count()


def test_bucketed_and_plain_keys_agree(spark):
    plain = Analysis(spark, SF, key_method="window")
    dist = Analysis(spark, SF)
    for name in ("players", "games", "dates", "teams"):
        a = sorted(getattr(plain.warehouse, name).collect())
        b = sorted(getattr(dist.warehouse, name).collect())
        assert a == b, name


def test_audits_run_and_foreign_keys_reported(spark, small):
    res = small.audits()
    assert len(res) == 8
    fk = res["team_rows_without_key"].first()
    assert fk["missing_opponentteamkey"] > 0  # NATION_25..29 never resolve
    assert fk["missing_teamkey"] == 0
    assert res["repeated_person_ids"].first()["duplicate_person_id_rows"] == 0
    assert {r["table_name"] for r in res["stored_tables"].collect()} == set(config.WAREHOUSE_TABLES)


def test_unrequested_fact_keys_are_left_out(small):
    fact = small.warehouse.player_fact(keys=("dateKey",))
    assert "dateKey" in fact.columns and "teamKey" not in fact.columns


def test_tables_are_made_on_first_use(spark):
    a = Analysis(spark, SF)
    a.win_loss.collect()
    assert set(a.warehouse.__dict__) & set(config.WAREHOUSE_TABLES) == {"team_stats_raw"}


def test_year_filter_reaches_the_partitions(small):
    plan = small.top_teams()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_year" in plan.replace("#", "") or "_year" in plan.split("PartitionFilters:")[1][:80]


def test_stored_warehouse_gives_the_same_results(spark, small, tmp_path):
    from boxstar.plans.warehouse import open_warehouse, write_warehouse

    write_warehouse(small.warehouse, str(tmp_path / "wh"))
    again = Analysis.from_warehouse(spark, str(tmp_path / "wh"), params=STANDIN)
    assert again.leaderboard().collect() == small.leaderboard().collect()
    assert again.win_loss.collect() == small.win_loss.collect()
    assert again.top_teams().collect() == small.top_teams().collect()
    assert open_warehouse(spark, str(tmp_path / "none")) == {}
    with pytest.raises(FileNotFoundError, match="dates"):
        Analysis.from_warehouse(spark, str(tmp_path / "none"))


def test_percentiles_in_range_and_roles(small):
    s = small.scored
    bad = s.where((F.col("historical_percentile_within_role") <= 0) | (F.col("historical_percentile_within_role") > 100)).count()
    assert bad == 0
    assert {r[0] for r in s.select("role").distinct().collect()} <= set(config.ROLE_ORDER)


def test_benchmarks_scaffold_and_monotone(small):
    rows = small.benchmarks.collect()
    assert len(rows) == 18
    for r in rows:
        if r["pool_size"]:
            assert r["p50"] <= r["p75"] <= r["p95"]


def test_strict_guards(spark):
    from dataclasses import replace

    with pytest.raises(ValueError):
        Analysis(spark, SF, replace(STANDIN, pool_min_minutes=10**9), strict=True).pool
    with pytest.raises(ValueError):
        Analysis(spark, SF, replace(STANDIN, active_min_minutes=10**9), strict=True).active


def test_csv_line_breaks_and_column_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"two\nlines"\n')
    (tmp_path / "b.csv").write_text("name,id\nplain,2\n")
    rows = sorted((r["id"], r["name"]) for r in read_box_csv(spark, str(tmp_path)).collect())
    assert rows == [("1", "two\nlines"), ("2", "plain")]
    (tmp_path / "c.csv").write_text("id,other\n3,x\n")
    with pytest.raises(ValueError, match="other"):
        read_box_csv(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        read_box_csv(spark, str(tmp_path / "missing.csv"))


def test_leaderboard_shape(small):
    lb = small.leaderboard().collect()
    assert lb and all(r["role_rank"] is not None for r in lb)
    per_role = {}
    for r in lb:
        per_role[r["role"]] = per_role.get(r["role"], 0) + 1
    assert max(per_role.values()) <= STANDIN.per_role


def test_contract_and_preview(spark, small):
    from boxstar.sources.contract import missing_inputs, require_inputs

    avail = {"players": small.players_raw, "teams": None}
    assert missing_inputs(avail, ["players", "teams", "games"]) == ["teams", "games"]
    with pytest.raises(FileNotFoundError, match="teams, games"):
        require_inputs(avail, ["players", "teams", "games"])
    prev = tiers.benchmark_preview(small.benchmarks, 9).collect()
    assert len(prev) == 9 and [r["metric_order"] for r in prev] == [0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_force_rebuild_switch(spark, tmp_path):
    from boxstar.sources.landing import read_table, write_table

    df = spark.createDataFrame([(1,), (2,)], "x int")
    path = str(tmp_path / "t")
    write_table(df, path, force_rebuild=True)
    write_table(df, path, force_rebuild=True)  # overwrite keeps two rows
    assert read_table(spark, path).count() == 2
    with pytest.raises(Exception):
        write_table(df, path, force_rebuild=False)


def test_tier_monotone_in_value(spark):
    from boxstar.functions.numeric import threshold_ladder

    vals = [float(v) for v in range(0, 40)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    ladder = [("95", F.lit(30.0)), ("75", F.lit(20.0)), ("50", F.lit(10.0))]
    rank = {"Low": 0, "50": 50, "75": 75, "95": 95}
    got = [rank[r[0]] for r in df.orderBy("v").select(threshold_ladder("v", ladder, "Low")).collect()]
    assert got == sorted(got)
