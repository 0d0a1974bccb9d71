"""Role inference (z-score signals, arg-max, interior override) and role scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstar import config
from boxstar.functions.numeric import arg_max, weighted_sum
from boxstar.operators.ordered import avg_tie_percentile, dense_position, percentile_rank_by, value_ranks
from boxstar.session import land

KEYS = ("season_end_year", "playerKey")


def assign_roles(pool: DataFrame) -> DataFrame:
    """Creator / Wing / Big from population z-scores; NULL when every signal is NULL."""
    stats = pool.agg(
        *[F.avg(m).alias(f"_mu_{m}") for m in config.ZSCORE_METRICS],
        *[F.stddev_pop(m).alias(f"_sd_{m}") for m in config.ZSCORE_METRICS],
    )
    df = pool.crossJoin(F.broadcast(stats))
    z = {}
    for m in config.ZSCORE_METRICS:
        sd = F.col(f"_sd_{m}")
        z[m] = (F.col(m) - F.col(f"_mu_{m}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    signal_cols = {}
    for role, terms in config.ROLE_SIGNALS:
        signal_cols[f"{role.lower()}_signal"] = weighted_sum([(z[m], w) for m, w in terms])
    df = df.withColumns(signal_cols)
    role = arg_max([(role, F.col(f"{role.lower()}_signal")) for role, _ in config.ROLE_SIGNALS])
    interior = (
        (F.col("_role") == "Wing")
        & (
            (F.col("dreb36") + F.col("oreb36") >= config.INTERIOR_REBOUNDS)
            | (F.col("blk36") >= config.INTERIOR_BLOCKS)
        )
        & (F.col("tpm36") < config.INTERIOR_MAX_TPM)
    )
    df = df.withColumn("_role", role).withColumn(
        "role", F.when(F.coalesce(interior, F.lit(False)), F.lit("Big")).otherwise(F.col("_role"))
    )
    return df.drop("_role", *[c for c in df.columns if c.startswith("_mu_") or c.startswith("_sd_")])


PCT_METRICS = ("pts36", "ast36", "tov36", "tpm36", "tp_pct", "stl36", "blk36", "dreb36", "oreb36")


def _pct_name(metric: str, ascending: bool) -> str:
    return f"_p_{metric}" if ascending else f"_pd_{metric}"


def score_roles(roles: DataFrame, stage=land, parts: int | None = None) -> DataFrame:
    """Pillars, role-weighted overall score, percentile and dense rank within role.

    Rows without a role are dropped (they still counted in the z-scores).
    ``stage(df, name)`` writes the scored rows before the two overall ranks:
    they are read three times, and the join on the score needs one copy of it.
    The nine percentile ranks are computed in one pass over a long
    (role, metric, value) frame -- 27 groups over range partitions -- and pivoted
    back to one row per player-season.
    """
    scored = roles.where(F.col("role").isNotNull())
    terms = {}
    for _, blend in config.PILLARS:
        for m, _, asc in blend:
            terms[_pct_name(m, asc)] = (m, asc)
    long = scored.select(
        *KEYS,
        "role",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("metric"), (F.col(m) if asc else -F.col(m)).alias("value"))
                    for name, (m, asc) in terms.items()
                ]
            )
        ).alias("_m"),
    ).select(*KEYS, "role", "_m.metric", "_m.value")
    pct = percentile_rank_by(long, ["role", "metric"], "value", True, "pct", parts)
    ranked = long.join(pct, ["role", "metric", "value"], "left")
    wide = ranked.groupBy(*KEYS).pivot("metric", list(terms)).agg(F.first("pct"))
    df = scored.join(wide, list(KEYS), "inner")
    pillar_cols = {}
    for pillar, blend in config.PILLARS:
        pillar_cols[pillar] = weighted_sum([(F.col(_pct_name(m, asc)), w) for m, w, asc in blend])
    df = df.withColumns(pillar_cols).drop(*terms)

    overall = None
    pillar_names = [p for p, _ in config.PILLARS]
    for i, name in enumerate(pillar_names):
        weight = None
        for role, weights in config.ROLE_WEIGHTS:
            cond = F.col("role") == role
            weight = F.when(cond, F.lit(weights[i])) if weight is None else weight.when(cond, F.lit(weights[i]))
        term = F.col(name) * weight
        overall = term if overall is None else overall + term
    df = df.withColumn("overall_score", overall)
    df = stage(df, "overall")

    # percentile (ascending) and dense rank (descending) of the overall score
    # from one ordered pass over the distinct (role, score) values
    ranks = value_ranks(df, ["role"], "overall_score", parts).select(
        "role",
        "overall_score",
        avg_tie_percentile(True).alias("historical_percentile_within_role"),
        dense_position(True).alias("historical_rank_within_role"),
    )
    sizes = df.groupBy("role").agg(F.count(F.lit(1)).alias("historical_pool_size"))
    return (
        df.join(ranks, ["role", "overall_score"], "left")
        .join(F.broadcast(sizes), "role", "inner")
        .withColumn("reb36", F.col("dreb36") + F.col("oreb36"))
    )
