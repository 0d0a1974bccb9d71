"""Sharding along a Hilbert curve, for files that can be pruned by several columns.

Each row is a point in a grid whose axes are metadata columns. An axis is quantised
to ``2 ** bits`` cells that hold about as many rows each (a value is never split, so one
that a third of the rows share fills its cell alone). The Hilbert index of the point is
computed level by level with integer columns; rows are put in the order of the
index, the order is cut into runs of equal count, and a run is a shard. Neighbours on the curve are
neighbours in the grid, so a shard covers a narrow range of every axis, and a filter on any of them
needs few shards (:func:`shard_ranges`, :func:`shards_for`).

All of it is DataFrame functions. Jobs: cells of an axis come from counts of its values
(numbers are first put on a fine scale of at most 65,537 steps), whose exact ranks are taken over range
partitions; at most ``2 ** bits`` cell borders an axis reach the driver. The order is one
range exchange; a row's place is read off the sorted files (``operators.numbered``), so neither a
hot value, nor a hot cell, nor a row that repeats meets in one task.

Law ``rows``: shard counts differ by one at most. Copies of a text are ordered like other rows.

Defined cases: a NULL text is empty (size 8, CRC 0); a NULL source or language is "" on its
axis; a NULL doc_id stands before the others; equal keys are ordered arbitrarily, which only
copies of one (doc_id, text) can tell; repeated rows each have a slot; with fewer
rows than shards some shards are empty; an empty table gives an empty result.
Further columns are left out, or kept by :func:`write_shards`, where input columns named
``size``, ``text_crc32``, ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstar.llm.common import land
from boxstar.operators.ordered import numbered, value_ranks
from boxstar.session import ensure_checkpoint_dir

SHARDS = 24
BITS = 5
#: Axes: column and kind. Text is ordered as it is, sizes by their logarithm, numbers evenly.
AXES = (("source", "text"), ("lang", "text"), ("size", "size"), ("doc_id", "number"))
#: Steps of the fine scales from which the cells of a number axis are made.
SIZE_STEPS, NUMBER_STEPS = 64, 1 << 16


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def _trailing_ones(i: int) -> int:
    return (~i & (i + 1)).bit_length() - 1


def curve_rules(dims: int) -> tuple[list[int], list[int], list[int]]:
    """For each of the ``2 ** dims`` corners of a cube, numbered along the curve: the
    inverse of the Gray code, the corner at which its sub-curve starts, and the axis along
    which that one runs."""
    corners = range(1 << dims)
    inverse = [0] * (1 << dims)
    for i in corners:
        inverse[_gray(i)] = i
    entry = [0 if w == 0 else _gray(2 * ((w - 1) // 2)) for w in corners]
    axis = [0 if w == 0 else _trailing_ones(w if w % 2 else w - 1) % dims for w in corners]
    return inverse, entry, axis


def hilbert_index(df: DataFrame, cells: Sequence[str], bits: int, out: str) -> DataFrame:
    """``df`` with ``out``: the index on the curve of the integer columns ``cells``, each
    below ``2 ** bits``."""
    n = len(cells)
    if n * bits > 62:
        raise ValueError(f"{n} axes of {bits} bits do not fit an index")
    mask = (1 << n) - 1
    inverse, entry, axis = ([F.lit(v) for v in rule] for rule in curve_rules(n))

    def right(x: Column, by: Column) -> Column:
        return F.call_function("shiftright", x, by)

    def left(x: Column, by: Column) -> Column:
        return F.call_function("shiftleft", x, by)

    def rotated(x: Column, by: Column) -> Column:
        """``x`` rotated left by 1 to n places within n bits."""
        return (left(x, by).bitwiseOR(right(x, F.lit(n) - by))).bitwiseAND(F.lit(mask))

    start, turn, corner, index = "_h_start", "_h_turn", "_h_corner", out
    df = df.withColumns({start: F.lit(0), turn: F.lit(0), index: F.lit(0).cast("long")})
    for level in reversed(range(bits)):
        point = F.lit(0)
        for k, c in enumerate(cells):
            point = point.bitwiseOR(left(right(F.col(c), F.lit(level)).bitwiseAND(F.lit(1)), F.lit(k)))
        seen = rotated(point.bitwiseXOR(F.col(start)), F.lit(n - 1) - F.col(turn))  # to the right by turn + 1
        df = df.withColumn(corner, F.get(F.array(*inverse), seen))
        df = df.withColumns({
            index: left(F.col(index), F.lit(n)).bitwiseOR(F.col(corner).cast("long")),
            start: F.col(start).bitwiseXOR(rotated(F.get(F.array(*entry), F.col(corner)), F.col(turn) + 1)),
            turn: (F.col(turn) + F.get(F.array(*axis), F.col(corner)) + 1) % n,
        })
    return df.drop(start, turn, corner)


def _scale(rows: DataFrame, axes: Sequence[tuple[str, str]]) -> dict[str, Column]:
    """Each axis as text whose order is the order of the axis."""
    numbers = [c for c, kind in axes if kind == "number"]
    ends = rows.agg(F.lit(0), *[f(c).cast("double").alias(f"{f.__name__}_{c}") for c in numbers for f in (F.min, F.max)]).first()
    out = {}
    for c, kind in axes:
        if kind == "text":
            out[c] = F.coalesce(F.col(c).cast("string"), F.lit(""))
            continue
        if kind == "size":
            step = F.floor(F.log2(F.greatest(F.col(c), F.lit(1))) * SIZE_STEPS)
        else:
            low, high = ends[f"min_{c}"], ends[f"max_{c}"]
            width = max((high or 0.0) - (low or 0.0), 1.0)
            step = F.floor((F.col(c).cast("double") - F.lit(low)) / F.lit(width) * NUMBER_STEPS) + 1
        out[c] = F.lpad(F.coalesce(step, F.lit(0)).cast("string"), 8, "0")
    return out


def _not_above(borders: Column, value: Column) -> Column:
    return F.size(F.filter(borders, lambda b: b <= value))


def cell_columns(rows: DataFrame, axes: Sequence[tuple[str, str]], bits: int) -> dict[str, Column]:
    """The cell of each axis (0 to ``2 ** bits`` - 1), by exact ranks of its values."""
    scale = _scale(rows, axes)
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), v.alias("value")) for c, v in scale.items()])).alias("p")).select("p.*")
    ranks = value_ranks(long, ["axis"], "value")
    cell = F.floor(F.col("_rows_before") * F.lit(1 << bits) / F.col("_n")).cast("int")
    borders = ranks.groupBy("axis", cell.alias("cell")).agg(F.min("value").alias("least")).collect()  # axes x 2 ** bits rows at most
    out = {}
    for c, value in scale.items():
        mine = sorted((r["cell"], r["least"]) for r in borders if r["axis"] == c)
        if not mine:
            out[c] = F.lit(0)
            continue
        passed = _not_above(F.array(*[F.lit(v) for _, v in mine]), value)
        out[c] = F.get(F.array(*[F.lit(k) for k, _ in mine]), passed - 1)
    return out


def place(rows: DataFrame, shards: int = SHARDS, axes: Sequence[tuple[str, str]] = AXES, bits: int = BITS, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` (written tables only, as they are read several times) with ``shard`` and
    ``slot``: runs along the curve, counts at most one apart."""
    n, kept = rows.count(), [c for c in rows.columns if c not in ("shard", "slot")]
    cells = {f"_h_{k}": c for k, c in enumerate(cell_columns(rows, axes, bits).values())}
    points = hilbert_index(rows.select(*kept, *[c.alias(k) for k, c in cells.items()]), list(cells), bits, "_h_index").drop(*cells)
    order = ["_h_index", *dict(axes), *ties]
    ranked = numbered(points, [F.col(c).asc_nulls_first() for c in order], "_h_rank", name="curve")
    out = ranked.withColumn("shard", F.expr(f"_h_rank * {shards}L div {max(n, 1)}L"))
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")  # the least rank of the shard
    return out.select(*kept, F.col("shard").cast("int").alias("shard"), (F.col("_h_rank") - first).alias("slot"))


def with_size(docs: DataFrame) -> DataFrame:
    """``docs`` with size (UTF-8 bytes of the text plus 8) and text_crc32."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"size": (F.octet_length(text) + 8).cast("long"), "text_crc32": F.crc32(F.encode(text, "UTF-8"))})


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    ensure_checkpoint_dir(docs.sparkSession)
    keys = with_size(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "size", "text_crc32")
    placed = place(land(keys, "shard_keys"), shards, bits=bits, ties=["text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Write whole documents under ``path``, a folder for each shard, rows in curve order;
    returns :func:`shard_ranges` of what is there."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    placed = place(land(with_size(docs), "shard_rows"), shards, bits=bits, ties=["text_crc32"])
    placed.write.partitionBy("shard").parquet(path)  # the files read are in curve order: a task meets a shard or two
    return shard_ranges(spark.read.parquet(path))


def shard_ranges(placed: DataFrame, columns: Sequence[str] = tuple(dict(AXES))) -> DataFrame:
    """Per shard: rows, and the least and greatest value of each column."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)


def shards_for(ranges: DataFrame, wanted: Mapping[str, tuple]) -> DataFrame:
    """The shards that may hold rows with every column of ``wanted`` in its closed range."""
    for c, (low, high) in wanted.items():
        ranges = ranges.where((F.col(f"max_{c}") >= F.lit(low)) & (F.col(f"min_{c}") <= F.lit(high)))
    return ranges.select("shard")
