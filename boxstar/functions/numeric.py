"""Numeric expressions: guarded ratios, weighted sums, arg-max, ladders, rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den, scale: float | None = None) -> Column:
    """num / den, NULL when den is 0 or NULL; optionally times ``scale``."""
    num, den = _col(num), _col(den)
    r = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return r * F.lit(float(scale)) if scale is not None else r


def weighted_sum(terms: Sequence[tuple[Column, float]]) -> Column:
    """w1*x1 + w2*x2 + ... evaluated left to right in the given order."""
    out = None
    for c, w in terms:
        term = F.lit(float(w)) * c
        out = term if out is None else out + term
    return out


def arg_max(named: Sequence[tuple[str, Column]]) -> Column:
    """Name of the largest non-NULL column; the first wins ties; all NULL -> NULL."""
    best = F.greatest(*[c for _, c in named])
    expr = None
    for name, c in named:
        expr = F.when(c == best, F.lit(name)) if expr is None else expr.when(c == best, F.lit(name))
    return expr.otherwise(F.lit(None).cast("string"))


def threshold_ladder(value, cuts: Sequence[tuple[str, Column]], below: str) -> Column:
    """First label whose cut the value reaches (cuts from the highest down);
    NULL value, NULL cut or below every cut -> ``below``."""
    value = _col(value)
    expr = None
    for label, cut in cuts:
        cond = F.coalesce(value >= cut, F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(below))


def count_true(conds: Sequence[Column]) -> Column:
    """Number of conditions that hold (NULL counts as false)."""
    out = F.lit(0)
    for c in conds:
        out = out + F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0)
    return out


def round_half_away(c, places: int) -> Column:
    """Round half away from zero on the binary value: round(x * 10^p) / 10^p.

    This is the warehouse engine's rule for DOUBLE (so 1.005 -> 1.0 at two
    places); Spark's round(x, p) would first print the decimal (-> 1.01).
    """
    scale = float(10 ** places)
    return F.round(_col(c) * F.lit(scale), 0) / F.lit(scale)
