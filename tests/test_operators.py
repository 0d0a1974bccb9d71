"""Distributed order statistics agree with plain windows / pandas."""

import datetime as dt
import random
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from boxstar.operators import dense_key, dense_rank_by, exact_quantiles, latest_per_key, percentile_rank_by, top_n_per_group


def test_dense_key_nulls_last(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "k long")
    got = {r["k"]: r["key"] for r in dense_key(df, "k", "key", parts=2).collect()}
    assert got == {2: 2, None: 3, 1: 1}


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_dense_key_matches_row_number(spark, parts):
    rng = random.Random(7)
    rows = [(rng.randint(-500, 500) * 10000 + i,) for i in range(2000)] + [(None,)]
    df = spark.createDataFrame(rows, "k long").repartition(5)
    a = {r["k"]: r["key"] for r in dense_key(df, "k", "key", parts=parts).collect()}
    b = {r["k"]: r["key"] for r in dense_key(df, "k", "key", method="window").collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, len(rows) + 1))
    c = {r["k"]: r["key"] for r in dense_key(df, "k", "key", parts=parts, spread_ties=False).collect()}
    assert c == b


def test_dense_key_hot_value(spark):
    # a third of the rows share one key value; keys stay a permutation of 1..n
    rows = [(7, i) for i in range(1000)] + [(i, i) for i in range(2000)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k long, other long")
    got = dense_key(df, "k", "key", parts=4).collect()
    assert sorted(r["key"] for r in got) == list(range(1, len(rows) + 1))
    by_k = {}
    for r in got:
        by_k.setdefault(r["k"], []).append(r["key"])
    # every key value owns a contiguous block, in key order, NULLs last
    order = sorted((k for k in by_k if k is not None)) + [None]
    pos = 1
    for k in order:
        block = sorted(by_k[k])
        assert block == list(range(pos, pos + len(block)))
        pos += len(block)


def test_numbering_identical_rows_is_even(spark, monkeypatch):
    from boxstar.operators import numbered

    module, landed = sys.modules["boxstar.operators.ordered"], {}
    real = module.land
    monkeypatch.setattr(module, "land", lambda df, name, **k: landed.setdefault(name, real(df, name, **k)))

    # a third of the file is one and the same row
    rows = [(7, "same")] * 2000 + [(i, "x") for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, other string").repartition(6)
    got = numbered(df, [F.col("k").asc()], "n", parts=12)
    out = got.collect()
    assert sorted(r["n"] for r in out) == list(range(len(rows)))
    assert [r["k"] for r in sorted(out, key=lambda r: r["n"])] == sorted(k for k, _ in rows)
    files = landed["numbered"].groupBy("_metadata.file_name").count().collect()
    assert max(r["count"] for r in files) <= 2 * len(rows) / 12


def test_numbering_moves_whole_rows_once(spark, tmp_path):
    spark.range(5000).selectExpr("id % 50 AS k", "id", "repeat('x', 20) AS wide").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = dense_key(df, "k", "key", parts=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan.split("BroadcastExchange")[0] and "Window" not in plan
    want = {(r["k"]): r["c"] for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("c")).collect()}
    got = {}
    for r in out.collect():
        got.setdefault(r["k"], []).append(r["key"])
    pos = 1
    for k in sorted(want):
        assert sorted(got[k]) == list(range(pos, pos + want[k]))
        pos += want[k]
    assert dense_key(df.where("k > 99"), "k", "key").count() == 0


def test_dense_key_strings_and_timestamps(spark):
    names = ["b", "a", "ab", "é", "Z", "", "aa", None, "a b"]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = {r["s"]: r["key"] for r in dense_key(df, "s", "key", parts=3).collect()}
    want = {r["s"]: r["key"] for r in dense_key(df, "s", "key", method="window").collect()}
    assert got == want
    ts = [dt.datetime(2020, 1, 1) + dt.timedelta(hours=7 * i) for i in range(300)]
    tdf = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    got = {r["t"]: r["key"] for r in dense_key(tdf, "t", "key", parts=5).collect()}
    assert [got[t] for t in sorted(ts)] == list(range(1, 301))


def _pandas_pct(values, ascending=True):
    return (pd.Series(values, dtype="float64").rank(pct=True, method="average", ascending=ascending) * 100).tolist()


def test_percentile_rank_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,), (5.0,)], "v double").withColumn("g", F.lit("x"))
    for asc, want in ((True, [25.0, 62.5, 62.5, 100.0]), (False, [100.0, 62.5, 62.5, 25.0])):
        pct = percentile_rank_by(df, ["g"], "v", asc, "p", parts=2)
        got = {r["v"]: r["p"] for r in pct.collect()}
        assert [got[v] for v in (1.0, 2.0, 2.0, 5.0)] == want


def test_percentile_rank_matches_pandas_with_ties(spark):
    rng = np.random.default_rng(3)
    n = 3000
    g = rng.integers(0, 3, n)
    v = rng.integers(0, 40, n).astype(float)  # heavy ties
    v[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"g": g.astype(str), "v": v, "id": np.arange(n)})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g string, v double, id long")
    pct = percentile_rank_by(df, ["g"], "v", True, "p", parts=4)
    got = df.join(pct, ["g", "v"], "left").select("id", "p").toPandas().set_index("id")["p"].sort_index()
    want = pdf.groupby("g")["v"].rank(pct=True, method="average") * 100
    assert np.allclose(got.to_numpy(dtype=float), want.to_numpy(), equal_nan=True, rtol=0, atol=1e-12)


def test_dense_rank_matches_window(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,), (5.0,)], "v double").withColumn("g", F.lit(1))
    dr = dense_rank_by(df, ["g"], "v", True, "r", parts=2)
    got = {r["v"]: r["r"] for r in df.join(dr, ["g", "v"], "left").collect()}
    assert got == {1.0: 3, 2.0: 2, 5.0: 1, None: None}
    rng = random.Random(5)
    rows = [(rng.choice("abc"), float(rng.randint(0, 50))) for _ in range(2000)]
    big = spark.createDataFrame(rows, "g string, v double")
    ours = dense_rank_by(big, ["g"], "v", True, "r", parts=3)
    plain = big.distinct().withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())).cast("long"))
    assert sorted(ours.collect()) == sorted(plain.select("g", "v", "r").collect())


def test_exact_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v double").withColumn("g", F.lit("x"))
    row = exact_quantiles(df, ["g"], "v", [("p95", 0.95), ("p50", 0.5)], "n", parts=2).first()
    assert row["n"] == 4
    assert abs(row["p95"] - 8.95) < 1e-9
    assert row["p50"] == 2.5


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(11)
    rows = [(str(int(k)), float(x)) for k, x in zip(rng.integers(0, 4, 5000), np.round(rng.normal(50, 15, 5000), 1))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", [("a", 0.5), ("b", 0.75), ("c", 0.95)], "n", parts=5).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, part in pdf.groupby("g"):
        for name, q in (("a", 0.5), ("b", 0.75), ("c", 0.95)):
            assert abs(got[g][name] - part["v"].quantile(q)) < 1e-9
        assert got[g]["n"] == len(part)


def test_exact_quantiles_single_group_and_skew(spark):
    # a third of the rows share one value
    vals = [7.0] * 1000 + [float(i) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    row = exact_quantiles(df, [], "v", [("m", 0.5)], "n", parts=8).first()
    assert row["n"] == 3000 and row["m"] == float(np.quantile(vals, 0.5))


def test_results_stable_under_partitioning(spark):
    rng = random.Random(9)
    rows = [(rng.choice("xy"), float(rng.randint(0, 100))) for _ in range(1500)]
    base = spark.createDataFrame(rows, "g string, v double")
    a = sorted(percentile_rank_by(base, ["g"], "v", True, "p", parts=4).collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        b = sorted(percentile_rank_by(base.repartition(7), ["g"], "v", True, "p", parts=9).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_latest_per_key_and_top_n(spark):
    df = spark.createDataFrame(
        [(1, 2020, 500.0, 30), (1, 2021, 900.0, 40), (1, 2021, 800.0, 41), (2, 2019, 100.0, 2)],
        "k int, season int, minutes double, games int",
    )
    got = latest_per_key(df, ["k"], [F.col("season"), -F.col("minutes"), -F.col("games")]).orderBy("k").collect()
    assert [(r.k, r.season, r.minutes) for r in got] == [(1, 2021, 800.0), (2, 2019, 100.0)]
    top = top_n_per_group(df, ["k"], [F.col("minutes").desc()], 1).orderBy("k").collect()
    assert [(r.k, r.minutes) for r in top] == [(1, 900.0), (2, 100.0)]


INF = float("inf")


def test_nan_and_infinities_lose_no_rows(spark):
    vals = [float(i % 700) for i in range(3000)] + [INF, -INF, float("nan"), None, 1e300]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v double, i long").withColumn("g", F.lit("x"))
    pct = percentile_rank_by(df, ["g"], "v", True, "p", parts=6).collect()
    present = pd.Series([v for v in vals if v is not None and v == v])
    want = dict(zip(present, present.rank(pct=True, method="average") * 100))
    assert {r["v"]: r["p"] for r in pct} == pytest.approx(want)
    row = exact_quantiles(df, ["g"], "v", [("lo", 0.0), ("m", 0.5), ("hi", 1.0)], "n", parts=6).first()
    assert (row["lo"], row["hi"], row["n"]) == (-INF, INF, len(present)) and row["m"] == present.median()
    keys = [r["key"] for r in dense_key(df.select("v", "i"), "v", "key", parts=6).collect()]
    assert sorted(keys) == list(range(1, len(vals) + 1))


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 5.0)], "g string, v double")
    got = {(r["g"], r["v"]): r["p"] for r in percentile_rank_by(df, ["g"], "v", True, "p", parts=3).collect()}
    assert got == {(None, 1.0): 50.0, (None, 2.0): 100.0, ("a", 5.0): 100.0}


@pytest.mark.parametrize("kind", ["prefix", "outlier", "hot"])
def test_range_partitions_are_even(spark, kind):
    from boxstar.operators import ordered

    rows = {
        "prefix": [(f"Customer#{i:09d}",) for i in range(4000)],
        "outlier": [(i,) for i in range(3999)] + [(10**15,)],
        "hot": [(7,)] * 2000 + [(i,) for i in range(2000)],
    }[kind]
    df = spark.createDataFrame(rows, "k string" if kind == "prefix" else "k long")
    counts = df.groupBy("k").agg(F.count(F.lit(1)).alias("c"))
    o = ordered(counts, [], [F.col("k").asc()], {"before": F.col("c")}, parts=8)
    sizes = [r["count"] for r in o.rows.groupBy("_part").count().collect()]
    assert sum(sizes) == counts.count() and max(sizes) <= 2 * sum(sizes) / 8
    assert o.totals.first()["before"] == len(rows)
