"""Cleaning recipes for the three raw inputs (players, player stats, team stats)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstar import config
from boxstar.functions.cleaning import (
    flag_profile,
    mask_outside,
    mask_values,
    parse_minutes,
    parse_timestamp,
    to_double,
    to_flag,
)

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
FLAGS = ("guard", "forward", "center")


def _apply(df: DataFrame, steps: dict[str, Callable[[str], Column]]) -> DataFrame:
    """Replace each column by its cleaned form; absent columns are passed over."""
    cols = {c: step(c) for c, step in steps.items() if c in df.columns}
    return df.withColumns(cols) if cols else df


def clean_players(df: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    """Renames, flags, numbers, sentinels, plausible ranges, birth date.

    Every step runs only when its column is present. What a flag's text means
    depends on the whole column (see ``flag_profile``): one row of column
    profiles joins the players.
    """
    df = df.withColumnsRenamed({k: v for k, v in config.PLAYER_RENAMES.items() if k in df.columns})
    flags = [c for c in FLAGS if c in df.columns]
    if flags:
        profile = df.agg(*[flag_profile(c).alias(f"_is_{c}") for c in flags])  # one row
        df = df.crossJoin(F.broadcast(profile))
        df = df.withColumns({c: to_flag(c, F.col(f"_is_{c}")) for c in flags}).drop(*[f"_is_{c}" for c in flags])
    known_draft = lambda c: mask_values(to_double(c), config.DRAFT_SENTINELS)
    return _apply(
        df,
        {
            **dict.fromkeys(("draftYear", "draftRound", "draftNumber"), known_draft),
            "height": lambda c: mask_outside(to_double(c), *config.HEIGHT_RANGE),
            "bodyWeight": lambda c: mask_outside(to_double(c), *config.WEIGHT_RANGE),
            "birthdate": lambda c: parse_timestamp(c, date_format),
        },
    )


def clean_box_stats(df: DataFrame, ts_col: str = "gameDateTimeEst", ts_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Playing time text -> minutes; game time text -> zone-less timestamp."""
    return _apply(df, {"numMinutes": parse_minutes, ts_col: lambda c: parse_timestamp(c, ts_format)})


def with_year(df: DataFrame, ts_col: str = "gameDateTimeEst") -> DataFrame:
    """Add ``_year``, by which landed box rows are partitioned."""
    return df.withColumn("_year", F.year(F.col(ts_col)))
