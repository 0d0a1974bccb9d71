"""Required-input contract: name what is missing before planning anything."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def missing_inputs(available: Mapping[str, DataFrame | None], required: Iterable[str]) -> list[str]:
    """Required names that are absent (or None) in ``available``."""
    return [name for name in required if available.get(name) is None]


def require_inputs(available: Mapping[str, DataFrame | None], required: Iterable[str]) -> None:
    """Raise FileNotFoundError listing every missing input."""
    missing = missing_inputs(available, required)
    if missing:
        raise FileNotFoundError("no data given for: " + ", ".join(missing))


def require_columns(name: str, df: DataFrame, required: Iterable[str]) -> None:
    """Raise ValueError listing the columns that input ``name`` lacks."""
    have = set(df.columns)
    missing = [c for c in required if c not in have]
    if missing:
        raise ValueError(f"input {name} lacks columns: " + ", ".join(missing))
