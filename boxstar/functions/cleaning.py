"""Cleaning expressions for messy box-score text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstar import config

# A number as Python's float() accepts it, without inf/nan/underscores.
_NUM = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
# (?U): \s matches Unicode whitespace too (no-break space, em space, ...),
# like str.strip.
_NUMBER = rf"(?U)^\s*({_NUM})\s*$"
# MM:SS split on the first colon; each side a number, whitespace allowed.
_MINUTES_SECONDS = rf"(?U)^\s*({_NUM})\s*:\s*({_NUM})\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_na_tokens(c: str | Column, tokens: Iterable[str] = config.NA_TOKENS) -> Column:
    """NULL when the raw field is one of the NA tokens (exact match)."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def to_double(c: str | Column) -> Column:
    """Numeric coercion: a strict number (surrounding whitespace allowed), else NULL.

    Spark's own cast would also accept ``12d``, ``0x1p3`` or ``Infinity``;
    the anchored pattern rejects them, and a number too large for a double
    (``1e999``) is NULL as well: no cleaned value is infinite.
    """
    s = _col(c).cast("string")
    return F.when(s.rlike(_NUMBER), _finite(F.regexp_extract(s, _NUMBER, 1).try_cast("double")))


def _finite(c: Column) -> Column:
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def to_whole(c: str | Column, kind: str = "int") -> Column:
    """Whole number from text: a strict number with an integral value (``1``,
    ``1.0``, ``1e2``) or a boolean word (1 / 0), else NULL; also NULL beyond ``kind``.

    The value is read as a decimal: a double would merge ids beyond 2 ** 53. The double only
    tells fractions too small for the decimal's 18 places."""
    c = _col(c)
    s = c.cast("string")
    exact = F.when(s.rlike(_NUMBER), F.regexp_extract(s, _NUMBER, 1).try_cast("decimal(38,18)"))
    n = to_double(s)
    word = F.lower(F.trim(s))
    return (
        F.when(word == "true", F.lit(1)).when(word == "false", F.lit(0))
        .when((n == F.floor(n)) & (exact == F.floor(exact)), exact.try_cast("decimal(20,0)")).try_cast(kind)
    )


def parse_minutes(c: str | Column) -> Column:
    """Playing time: ``MM:SS`` -> MM + SS/60, a plain number -> itself,
    blank or unparsable -> NULL. Split on the first colon only, so
    ``12:34:56`` is NULL. Anchored patterns with capture groups: at most
    two matches and two extracts per row, no per-branch re-stripping."""
    s = _col(c).cast("string")
    mm = F.regexp_extract(s, _MINUTES_SECONDS, 1).try_cast("double")
    ss = F.regexp_extract(s, _MINUTES_SECONDS, 2).try_cast("double")
    return (
        F.when(s.rlike(_MINUTES_SECONDS), _finite(mm + ss / F.lit(60.0)))
        .when(s.rlike(_NUMBER), _finite(F.regexp_extract(s, _NUMBER, 1).try_cast("double")))
        .otherwise(F.lit(None).cast("double"))
    )


def decode_flag(c: str | Column) -> Column:
    """Position flag text of a mixed column -> 1 / 0, anything else NULL."""
    c = _col(c).cast("string")
    return (
        F.when(c.isin(list(config.FLAG_TRUE)), F.lit(1))
        .when(c.isin(list(config.FLAG_FALSE)), F.lit(0))
        .otherwise(F.lit(None).cast("int"))
    )


def flag_profile(c: str | Column) -> Column:
    """Aggregate over a column of flag text: 'bool' when every value is a
    boolean word, 'number' when every value is a number, else 'text' -- the
    type that reading the column with type inference would give."""
    s = _col(c).cast("string")
    return F.when(F.bool_and(s.isin(list(config.FLAG_WORDS))), F.lit("bool")).when(
        F.bool_and(s.rlike(_NUMBER)), F.lit("number")
    ).otherwise(F.lit("text"))


def to_flag(c: str | Column, profile: Column) -> Column:
    """Position flag -> 1 / 0 given the column's :func:`flag_profile`."""
    n = to_double(c)
    return (
        F.when(profile == "bool", F.when(F.lower(_col(c)) == "true", F.lit(1)).otherwise(F.when(_col(c).isNotNull(), F.lit(0))))
        .when(profile == "number", F.when(n == 1, F.lit(1)).when(n == 0, F.lit(0)))
        .otherwise(decode_flag(c))
    )


def mask_values(c: str | Column, values: Iterable[float]) -> Column:
    """NULL where the value is one of the sentinels."""
    c = _col(c)
    return F.when(~c.isin(list(values)) | c.isNull(), c)


def mask_outside(c: str | Column, lo: float, hi: float) -> Column:
    """NULL outside [lo, hi]; bounds are kept."""
    c = _col(c)
    return F.when(c.between(lo, hi), c)


def _has_zone(fmt: str) -> bool:
    """Whether the format reads an offset or a zone (letters outside quotes)."""
    return any(c in "XxZzVvO" for c in "".join(fmt.split("'")[::2]))


def parse_timestamp(c: str | Column, fmt: str = config.TIMESTAMP_FORMATS[0]) -> Column:
    """Zone-less timestamp in one explicit format; other formats -> NULL.

    A text without an offset is the wall time that it says, a text with one (where ``fmt`` reads
    it) the wall time in UTC. The session's zone has no part in it: texts without
    an offset are parsed as UTC, and the instant is put together again without a zone."""
    text = _col(c).cast("string")
    if not _has_zone(fmt):
        text, fmt = F.concat(text, F.lit(" UTC")), f"{fmt} VV"
    seconds = F.unix_micros(F.try_to_timestamp(text, F.lit(fmt))).cast("decimal(20,0)") / F.lit(1_000_000)
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def pick_format(df: DataFrame, c: str, formats: Iterable[str] = config.TIMESTAMP_FORMATS) -> str | None:
    """The format of the column's first value that follows one of ``formats``
    (the first such format); None when no value does."""
    formats = list(formats)
    which = F.coalesce(*[F.when(parse_timestamp(c, f).isNotNull(), F.lit(i)) for i, f in enumerate(formats)])
    row = df.select(which.alias("i")).where("i IS NOT NULL").limit(1).collect()
    return formats[row[0]["i"]] if row else None


def normalize_game_type(c: str | Column) -> Column:
    """Blank -> NULL; known spellings -> canonical labels; else trimmed text."""
    c = _col(c)
    trimmed = F.trim(c)
    lowered = F.lower(trimmed)
    labels = config.GAME_TYPE_LABELS
    return (
        F.when(c.isNull() | (trimmed == ""), F.lit(None).cast("string"))
        .when(F.lower(F.replace(trimmed, F.lit(" "), F.lit(""))) == config.GAME_TYPE_PRESEASON, F.lit(labels["preseason"]))
        .when(lowered == config.GAME_TYPE_REGULAR, F.lit(labels["regular"]))
        .when(lowered.isin(list(config.GAME_TYPE_CUP)), F.lit(labels["cup"]))
        .otherwise(trimmed)
    )
