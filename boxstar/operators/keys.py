"""Looking up keys for whole rows through their key columns alone."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstar.operators.ordered import default_parts
from boxstar.session import land

#: A row's place: the hash of its file's path (tables have far fewer than 2 ** 32 files) and its number there.
PLACE = ("_file", "_row")

#: Up to so many partitions Spark deals rows out without sorting them (spark.shuffle.sort.bypassMergeThreshold).
FEW_PARTS = 200
#: Rows whose added columns one task holds in memory (some 150 bytes each).
PART_ROWS = 1_500_000


def with_place(df: DataFrame) -> DataFrame:
    """``df`` with the place of each row in the Parquet files it is read from; what is not
    a plain scan of such files is landed first."""
    place = [F.xxhash64("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1])]
    try:
        return df.select("*", *place)
    except AnalysisException:
        return land(df, "placed").select("*", *place)


def place_parts(rows: int, parts: int) -> int:
    """Partitions in which rows meet by their place: ``parts``, but few enough that a task that deals
    out whole rows writes a file for each without collecting them, and enough for ``PART_ROWS`` rows in each."""
    return max(min(parts, FEW_PARTS), -(-rows // PART_ROWS))


def through_keys(
    df: DataFrame, columns: Mapping[str, Column], resolve: Callable[[DataFrame], DataFrame],
    beside: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``df`` joined with what ``resolve`` makes of ``columns``.

    ``resolve`` gets a frame with ``columns`` and the rows' places and may join it as often as it
    likes; only these few columns are dealt out for its joins. It must keep the place columns, and may
    repeat or leave out rows. Then the whole rows are dealt out once, by their place, to meet the
    columns that it has added -- whatever the number of joins. Columns of ``df`` win over added ones of
    the same name. ``beside`` gets the whole rows with their places before they are dealt out, for joins that
    do not move them; what it leaves out need not move.

    Places are spread evenly, so a partition of the added columns is small enough to be looked up
    in memory, and whole rows stream past it unsorted.
    """
    placed = with_place(df)
    found = resolve(placed.select(*PLACE, *[c.alias(n) for n, c in columns.items()]))
    new = [c for c in found.columns if c not in {*df.columns, *columns, *PLACE}]
    parts = place_parts(placed.count(), default_parts(df))
    whole = (beside(placed) if beside else placed).repartition(parts, *PLACE)
    found = found.select(*PLACE, *new).repartition(parts, *PLACE)
    return whole.join(found.hint("shuffle_hash"), list(PLACE)).drop(*PLACE)
