"""Order statistics without a single-partition window.

A global ``ROW_NUMBER() OVER (ORDER BY k)`` or a percentile over a handful
of groups puts every row through one task. Here rows are cut into range
partitions of equal size by the data's own order (``repartitionByRange`` on
group and sort key), written once, and

* what all earlier partitions of a group hold is a small table (at most
  partitions + groups rows) whose running sum gives each partition's offset,
* the order inside a partition is a window partitioned by (partition, group).

Average-tie percentile ranks, dense ranks and exact quantiles are derived from
:func:`ordered`. Rows that are only numbered (surrogate keys) need no window
either: :func:`numbered` reads the numbers off the sorted files. Ties are collapsed into (value, count)
rows before ordering, so a value held by a third of all rows is a single row
here, and no partition depends on how values are spread, on a common text
prefix or on outliers.

NULL groups are groups like any other. NaN counts as missing, as NULL does,
where values are ranked; infinities stand at the ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxstar.session import land


def default_parts(df: DataFrame) -> int:
    """Range partitions: as many as the session's shuffle partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@dataclass(frozen=True)
class Ordered:
    """``rows`` with running sums; ``offsets`` per (group, ``_part``); ``totals`` per group."""

    rows: DataFrame
    offsets: DataFrame
    totals: DataFrame


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], prefix: str) -> list[Column]:
    return [left[n].eqNullSafe(right[f"{prefix}{n}"]) for n in names]


def join_groups(df: DataFrame, small: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``names``, NULLs equal; with no names ``small`` is one row."""
    if not names:
        return df.crossJoin(F.broadcast(small))
    renamed = small.withColumnsRenamed({n: f"_j_{n}" for n in names})
    return df.join(renamed, _same(df, renamed, names, "_j_"), how).drop(*[f"_j_{n}" for n in names])


def ordered(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], weights: dict[str, Column], parts: int | None = None
) -> Ordered:
    """For each (name, weight): the sum of the weight over the rows before each
    row of its group, in ``order_cols`` order (ties in arbitrary order).

    ``order_cols`` should tell rows apart: rows with equal keys share a range
    partition. Rows out equal rows in.
    """
    group_cols = list(group_cols)
    inner = {name: f"_w{i}" for i, name in enumerate(weights)}
    weighted = df.withColumns({inner[k]: v.cast("long") for k, v in weights.items()})
    by = [*[F.col(g).asc_nulls_first() for g in group_cols], *order_cols]
    ranged = weighted.repartitionByRange(parts or default_parts(df), *by).withColumn("_part", F.spark_partition_id())
    ranged = land(ranged, "ranged")
    places = [*group_cols, "_part"]
    sums = ranged.groupBy(*places).agg(*[F.sum(w).alias(f"_t{w}") for w in inner.values()])
    earlier = (Window.partitionBy(*group_cols) if group_cols else Window).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumns({f"_o{w}": F.coalesce(F.sum(f"_t{w}").over(earlier), F.lit(0)) for w in inner.values()})
    offsets = land(offsets, "offsets")
    before = Window.partitionBy(*places).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumns({f"_i{w}": F.coalesce(F.sum(w).over(before), F.lit(0)) for w in inner.values()})
    first = offsets.select(*places, *[f"_o{w}" for w in inner.values()])
    if group_cols:
        rows = join_groups(rows, first, places)
    else:
        rows = rows.join(F.broadcast(first), "_part")  # one row per range partition
    rows = rows.withColumns({name: (F.col(f"_o{w}") + F.col(f"_i{w}")).cast("long") for name, w in inner.items()})
    rows = rows.drop(*[c for w in inner.values() for c in (w, f"_o{w}", f"_i{w}")])
    totals = offsets.groupBy(*group_cols).agg(*[F.sum(f"_t{w}").alias(name) for name, w in inner.items()])
    spans = offsets.select(
        *places, *[F.col(f"_o{w}").alias(f"{name}_from") for name, w in inner.items()],
        *[(F.col(f"_o{w}") + F.col(f"_t{w}")).alias(f"{name}_to") for name, w in inner.items()],
    )
    return Ordered(rows, spans, totals)


def prefix_before(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], weights: dict[str, Column], parts: int | None = None
) -> DataFrame:
    """``df`` with the running sums of :func:`ordered`."""
    return ordered(df, group_cols, order_cols, weights, parts).rows.drop("_part")


def with_position(df: DataFrame) -> DataFrame:
    """``df`` with ``_at``, a hash of where each row stands in the Parquet files it
    is read from: the same whenever a task runs again, and another one for each of
    many identical rows. What is not a plain scan of such files is landed first.
    """
    at = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_at")
    try:
        return df.select("*", at)
    except AnalysisException:
        return land(df, "placed").select("*", at)


def numbered(
    df: DataFrame, order_cols: Sequence[Column], number: str, parts: int | None = None, spread_ties: bool = True, name: str = "numbered"
) -> DataFrame:
    """``df`` landed in ``order_cols`` order, with ``number`` counting the rows from 0.

    One range exchange of the rows, which are then written in order, a file for
    each range partition. A row's number is its place in its file, which the reader
    knows, and what the files before hold: a table with a row per file. No window
    and no join meets the rows, and nothing depends on how often a key or a whole
    row repeats: tied rows are dealt by their position (:func:`with_position`).
    Their order is arbitrary. ``spread_ties=False`` is for frames whose keys are
    unique by construction; it takes no position.
    """
    by = list(order_cols)
    if spread_ties:
        df = with_position(df)
        by.append(F.col("_at").asc())
    ranged = df.repartitionByRange(parts or default_parts(df), *by).sortWithinPartitions(*by)
    rows = land(ranged.drop("_at"), name)
    placed = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # files are named by their partition, and by a count where one partition fills several
    turn = [F.regexp_extract("_file", r"part-(\d+)", 1).cast("long"), F.length("_file"), F.col("_file")]
    before = Window.orderBy(*turn).rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_c"))
    first = land(files.select("_file", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first")), "files")
    out = placed.join(F.broadcast(first), "_file")
    return out.select(*rows.columns, (F.col("_first") + F.col("_row")).cast("long").alias(number))


def dense_key(
    df: DataFrame, order_col: str, key_name: str, method: str = "ranged", spread_ties: bool = True, parts: int | None = None
) -> DataFrame:
    """Surrogate key 1..n in ``order_col`` order, NULLs last (ROW_NUMBER semantics),
    numbered by :func:`numbered`. ``method="window"`` is the plain
    single-partition form, kept for checks.
    """
    order = F.col(order_col).asc_nulls_last()
    if method == "window":
        return df.withColumn(key_name, F.row_number().over(Window.orderBy(order)).cast("long"))
    out = numbered(df, [order], "_before", parts, spread_ties)
    return out.select(*df.columns, (F.col("_before") + 1).alias(key_name))


def present(df: DataFrame, value_col: str) -> Column:
    """Neither NULL nor NaN."""
    c = F.col(value_col)
    if isinstance(df.schema[value_col].dataType, T.FloatType | T.DoubleType):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def _value_counts(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    # map-side combine: a value shared by many rows becomes one row early
    return df.where(present(df, value_col)).groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_cnt"))


def value_ranks(df: DataFrame, group_cols: Sequence[str], value_col: str, parts: int | None = None) -> DataFrame:
    """Per distinct present (group, value): ``_cnt`` rows with the value,
    ``_rows_before`` / ``_vals_before`` rows / distinct values smaller in the
    group, ``_n`` rows and ``_d`` distinct values in the group.

    One ascending pass; descending positions follow exactly from the totals.
    """
    group_cols = list(group_cols)
    counts = _value_counts(df, group_cols, value_col)
    o = ordered(counts, group_cols, [F.col(value_col).asc()], {"_rows_before": F.col("_cnt"), "_vals_before": F.lit(1)}, parts)
    totals = o.totals.withColumnsRenamed({"_rows_before": "_n", "_vals_before": "_d"})
    return join_groups(o.rows.drop("_part"), totals, group_cols)


def avg_tie_percentile(ascending: bool = True) -> Column:
    """Percentile rank with average ties from :func:`value_ranks` columns:
    (rows ordered before + (ties + 1) / 2) / present rows * 100."""
    before = F.col("_rows_before") if ascending else F.col("_n") - F.col("_rows_before") - F.col("_cnt")
    avg_rank = (before + F.lit(1)).cast("double") + (F.col("_cnt") - F.lit(1)).cast("double") / F.lit(2.0)
    return avg_rank / F.col("_n").cast("double") * F.lit(100.0)


def dense_position(descending: bool = True) -> Column:
    """Dense rank (1 = first) from :func:`value_ranks` columns."""
    if descending:
        return (F.col("_d") - F.col("_vals_before")).cast("long")
    return (F.col("_vals_before") + 1).cast("long")


def percentile_rank_by(
    df: DataFrame, group_cols: Sequence[str], value_col: str, ascending: bool = True, out: str = "pct", parts: int | None = None
) -> DataFrame:
    """Per distinct (group, value): percentile rank with average ties, in (0, 100].

    pct = (rows ordered before + (ties + 1) / 2) / present rows * 100.
    Returns (group_cols..., value_col, out); join it back on (group, value).
    """
    r = value_ranks(df, group_cols, value_col, parts)
    return r.select(*group_cols, value_col, avg_tie_percentile(ascending).alias(out))


def dense_rank_by(
    df: DataFrame, group_cols: Sequence[str], value_col: str, descending: bool = True, out: str = "dense_rank", parts: int | None = None
) -> DataFrame:
    """Per distinct (group, value): dense rank (1 = first), missing values excluded."""
    r = value_ranks(df, group_cols, value_col, parts)
    return r.select(*group_cols, value_col, dense_position(descending).alias(out))


def exact_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[tuple[str, float]],
    size_col: str | None = "pool_size",
    parts: int | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group (missing values ignored).

    For n values sorted v[0..n-1] and probability q: rn = (n - 1) * q,
    result = v[floor(rn)] + (v[ceil(rn)] - v[floor(rn)]) * (rn - floor(rn)).
    Each order statistic's range partition is found in the small offsets
    table; only rows of such partitions meet it. Groups without values
    produce no row.
    """
    group_cols = list(group_cols)
    counts = _value_counts(df, group_cols, value_col)
    o = ordered(counts, group_cols, [F.col(value_col).asc()], {"_before": F.col("_cnt")}, parts)
    totals = o.totals.withColumnRenamed("_before", "_n")
    spec = F.array(*[F.struct(F.lit(name).alias("_q"), F.lit(float(q)).alias("_p")) for name, q in probs])
    rn = (F.col("_n") - 1).cast("double") * F.col("_t._p")
    sides = F.array(
        F.struct(F.lit("lo").alias("_side"), (F.floor("_rn") + 1).alias("_pos")),
        F.struct(F.lit("hi").alias("_side"), (F.ceil("_rn") + 1).alias("_pos")),
    )
    targets = (
        totals.select(*group_cols, "_n", F.explode(spec).alias("_t"))
        .select(*group_cols, "_n", F.col("_t._q").alias("_q"), rn.alias("_rn"))
        .select(*group_cols, "_n", "_q", (F.col("_rn") - F.floor("_rn")).alias("_frac"), F.explode(sides).alias("_s"))
        .select(*group_cols, "_n", "_q", "_frac", "_s._side", "_s._pos")
    )
    located = join_groups(targets, o.offsets, group_cols) if group_cols else targets.join(
        F.broadcast(o.offsets), (F.col("_pos") > F.col("_before_from")) & (F.col("_pos") <= F.col("_before_to"))
    )
    located = located.where((F.col("_pos") > F.col("_before_from")) & (F.col("_pos") <= F.col("_before_to")))
    located = located.drop("_before_from", "_before_to")
    hits = join_groups(o.rows, located, [*group_cols, "_part"]).where(
        (F.col("_pos") > F.col("_before")) & (F.col("_pos") <= F.col("_before") + F.col("_cnt"))
    )
    picked = hits.groupBy(*group_cols, "_n", "_q").agg(
        F.max(F.when(F.col("_side") == "lo", F.col(value_col))).alias("_lv"),
        F.max(F.when(F.col("_side") == "hi", F.col(value_col))).alias("_hv"),
        F.max("_frac").alias("_frac"),
    )
    # equal ends stay themselves, so that an infinite value does not become NaN
    value = F.when(F.col("_lv") == F.col("_hv"), F.col("_lv")).otherwise(
        F.col("_lv") + (F.col("_hv") - F.col("_lv")) * F.col("_frac")
    )
    picked = picked.select(*group_cols, "_n", "_q", value.alias("_val"))
    names = [name for name, _ in probs]
    wide = picked.groupBy(*group_cols, "_n").pivot("_q", names).agg(F.first("_val"))
    return wide.withColumnRenamed("_n", size_col) if size_col else wide.drop("_n")
