"""Print the physical plans of the headline recipes (scans, exchanges, joins).

usage: python tools/show_plans.py [sf_dir] [--full]
Shows, per recipe, the operators that matter at scale: file scans with
their ReadSchema / PushedFilters, exchanges (shuffles, broadcasts), joins,
aggregates and windows. ``--full`` prints ``explain("formatted")`` instead.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"Scan|Exchange|Join|Aggregate|Window|ReadSchema|PushedFilters|PartitionFilters|WindowGroupLimit|TakeOrdered")


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    full = "--full" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    from boxstar.plans import audits, pool
    from boxstar.plans.recipes import Analysis
    from boxstar.session import local_session

    spark = local_session(8)
    a = Analysis(spark, sf_dir)
    wh = a.warehouse
    recipes = {
        "win_loss_summary": a.win_loss,
        "top_teams": a.top_teams(),
        "player_stats_fact": wh.player_stats_fact,
        "season_aggregates": pool.season_aggregates(wh.player_stats_raw, wh.players, 150, 2),
        "active_multi_position": audits.active_multi_position(wh.players, wh.player_stats_raw, a.params.active_years),
        "leaderboard": a.leaderboard(),
    }
    for name, df in recipes.items():
        print(f"=== {name}")
        if full:
            df.explain("formatted")
            continue
        plan = df._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if KEEP.search(line):
                print("   ", line.strip()[:220])


if __name__ == "__main__":
    main()
