"""Benchmark of the headline recipes.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Each recipe is run once to warm up, then BENCH_RUNS
times (cold ones without a warm-up and once less); the median is reported. Results are forced with the ``noop`` sink
(full computation, nothing collected).

* ``warehouse_build``: cold build from Parquet (land cleaned inputs and the
  four dimensions, compute both facts).
* each analysis is timed on top of the landed results of the step before it
  (warehouse -> player pool -> scored pool -> benchmarks -> tiers), like the
  original's build-once / analyse-many workflow.
* ``*_cold``: end to end from Parquet, nothing reused; ``leaderboard_cold`` is
  the flagship.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from boxstar.plans.recipes import Analysis  # noqa: E402
from boxstar.session import local_session  # noqa: E402


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int, warm_up: bool = True) -> float:
    if warm_up:
        fn()
    times = []
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="boxstar-bench")

    def fresh() -> Analysis:
        return Analysis(spark, sf_dir)

    def build():
        a = fresh()
        force(a.warehouse.player_stats_fact)
        force(a.warehouse.team_stats_fact)
        return a

    built = build()
    ready = Analysis(spark, sf_dir, warehouse=built.warehouse)
    ready.active_tiers  # every step landed once

    def after(*steps: str) -> Analysis:
        """Fresh analysis over the landed warehouse and the landed results of ``steps``."""
        b = Analysis(spark, sf_dir, warehouse=built.warehouse)
        b.__dict__.update({name: ready.__dict__[name] for name in steps})
        return b

    def audits_all():
        for df in after().audits().values():
            force(df)

    def tiers_and_board():
        b = after("season_rows", "pool", "scored", "benchmarks")
        force(b.leaderboard())
        force(b.tier_distribution())

    recipes = {
        "warehouse_build": build,
        "audits": audits_all,
        "win_loss_summary": lambda: force(after().win_loss),
        "top_teams": lambda: force(after().top_teams()),
        "team_profile": lambda: force(after().team_profile()),
        "player_pool": lambda: force(after().pool),
        "role_scores": lambda: after("season_rows", "pool").scored,
        "role_benchmarks": lambda: after("season_rows", "pool", "scored").benchmarks,
        "tiers_leaderboard": tiers_and_board,
        "win_loss_cold": lambda: force(fresh().win_loss),
        "top_teams_cold": lambda: force(fresh().top_teams()),
        "player_pool_cold": lambda: force(fresh().pool),
        "leaderboard_cold": lambda: force(fresh().leaderboard()),
    }
    # the cold recipes repeat steps that the others have warmed up
    results = {
        name: round(timed(fn, max(1, runs - 1), False) if name.endswith("_cold") else timed(fn, runs), 3)
        for name, fn in recipes.items()
    }
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "median_seconds_per_recipe_sum",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
