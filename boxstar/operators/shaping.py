"""Row selection per key and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key_cols: Sequence[str], ordering: Sequence[Column]) -> DataFrame:
    """Keep, per key, the row with the largest ``ordering`` tuple (NULL smallest).

    ``row_number() = 1`` is planned with a group limit before the shuffle, so
    each map task forwards one row per key and a hot key costs no task more
    than its share. ``ordering`` must not tie within a key.
    """
    return top_n_per_group(df, key_cols, [c.desc_nulls_last() for c in ordering], 1)


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], ordering: Sequence[Column], n: int, rank_col: str = "_rn") -> DataFrame:
    """First ``n`` rows per group in ``ordering`` (rows, not ranks).

    ``row_number() <= n`` is planned as a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most n rows per group.
    """
    w = Window.partitionBy(*group_cols).orderBy(*ordering)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n).drop(rank_col)
