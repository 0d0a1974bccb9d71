"""Packing by cutting-stock column generation (operator 10).

Documents become token pieces of at most ``capacity`` tokens; the pieces'
length histogram is a cutting-stock problem: a linear program over patterns
(how many pieces of each length class share one sequence) is solved by column
generation, where a knapsack dynamic program prices new patterns. The
patterns are rounded down, what is left over is filled greedily, and pieces,
ranked within their length class, take the patterns' places.

The program sees only the histogram, at most ``capacity / unit`` counts at any
corpus size; pieces never leave the executors. A class that holds a large
share of all pieces is ranked in ``buckets`` parts.

Defined results: a NULL text is empty and still has the closing id; an empty
table gives an empty result; repeated rows are packed once per row; further
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxstar.llm.common import land, parallelism, prepare

CAPACITY = 4096
UNIT = 16
CLOSING_ID = 2

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _pieces(path: str, capacity: int, closing: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        from boxstar.llm.wordbpe import encoder

        enc = encoder(path)
        end = np.array([closing], dtype="<u4").tobytes()
        wide = 4 * capacity
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows: list[tuple[int | None, int, int, int, int]] = []
            for doc, ids in zip(ids_of, enc.ids_many(texts)):
                ids += end
                n = len(ids) // 4
                for a in range(0, len(ids), wide):
                    part = ids[a : a + wide]
                    rows.append((doc, a // 4, len(part) // 4, crc32(part), n))
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    return run


def best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of sizes within ``room`` of largest total price."""
    best = np.zeros(room + 1)
    pick = np.full(room + 1, -1)
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        k = int(np.searchsorted(sizes, c, side="right"))
        if k:
            worth = prices[:k] + best[c - sizes[:k]]
            j = int(np.argmax(worth))
            if worth[j] > best[c] + 1e-12:
                best[c], pick[c] = worth[j], j
    counts = np.zeros(len(sizes))
    c = room
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[pick[c]] += 1
            c -= sizes[pick[c]]
    return float(best[room]), counts


def cutting_patterns(sizes: np.ndarray, demand: np.ndarray, room: int, max_rounds: int = 20_000) -> list[tuple[np.ndarray, int]]:
    """Patterns with multiplicities that serve ``demand`` pieces of each size exactly.

    Revised simplex over the pattern columns; each round's entering column is
    the best knapsack at the current dual prices. Stops when no pattern prices
    above its cost. The fractional optimum is rounded down; the remainder
    (less than one sequence per basic pattern) is filled largest size first.
    """
    order = np.argsort(sizes)
    sizes, demand = sizes[order], demand[order].astype(float)
    m = len(sizes)
    columns = np.diag((room // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    level = inverse @ demand
    for _ in range(max_rounds):
        prices = inverse.sum(axis=0)
        worth, column = best_pattern(np.maximum(prices, 0.0), sizes, room)
        if worth <= 1.0 + 1e-7:
            break
        step = inverse @ column
        usable = step > 1e-9
        ratio = np.full(m, np.inf)
        ratio[usable] = level[usable] / step[usable]
        r = int(np.argmin(ratio))
        amount = ratio[r]
        level = level - amount * step
        level[r] = amount
        row = inverse[r] / step[r]
        inverse -= np.outer(step, row)
        inverse[r] = row
        columns[:, r] = column
    out: list[tuple[np.ndarray, int]] = []
    left = demand.astype(np.int64)
    for j in np.argsort(-level):
        counts = columns[:, j].astype(np.int64)
        used = counts > 0
        times = min(int(np.floor(level[j] + 1e-7)), int((left[used] // counts[used]).min()))
        if times > 0:
            out.append((counts, times))
            left = left - times * counts
    while left.any():
        counts, space = np.zeros(m, dtype=np.int64), room
        for i in range(m - 1, -1, -1):
            k = min(int(left[i]), space // int(sizes[i]))
            counts[i], space = k, space - k * int(sizes[i])
        used = counts > 0
        times = int((left[used] // counts[used]).min())
        out.append((counts, times))
        left = left - times * counts
    back = np.argsort(order)
    return [(counts[back], times) for counts, times in out]


def _places(path_counts: list[tuple[np.ndarray, int]], classes: np.ndarray):
    """(class, rank) ranges -> sequences: sorted starting keys and, for each
    range, its first rank, first sequence, sequences and first slot."""
    taken = np.zeros(len(classes), dtype=np.int64)
    rows: list[tuple[int, int, int, int]] = []
    sequence = 0
    for counts, times in path_counts:
        slot = 0
        for i in np.flatnonzero(counts):
            rows.append(((int(classes[i]) << 44) + int(taken[i]), sequence, times, slot))
            taken[i] += times * int(counts[i])
            slot += int(counts[i])
        sequence += times
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows))


def _assign(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, sequence, times, slot = places
        for batch in batches:
            if not batch.num_rows:
                continue
            key = (batch["class"].to_numpy() << 44) + batch["rank"].to_numpy()
            at = np.searchsorted(first, key, side="right") - 1
            k = key - first[at]
            cols = [batch[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            cols += [pa.array(sequence[at] + k % times[at]), pa.array(slot[at] + k // times[at])]
            yield pa.RecordBatch.from_arrays(
                cols, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"]
            )

    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, closing_id: int = CLOSING_ID) -> DataFrame:
    """Pieces of every document: full sequences from its start, then the rest."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(_pieces(path, capacity, closing_id), _PIECES)


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    unit: int = UNIT,
    closing_id: int = CLOSING_ID,
    buckets: int | None = None,
) -> DataFrame:
    """Pack every document's ids into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and ``padded_length``, the sequence's length in
    training: ``capacity``, or its own token count where that is a power of two.
    ``unit`` is the width of a length class (a power of two dividing
    ``capacity``); at most ``unit - 1`` tokens a piece are lost to it.
    """
    spark = docs.sparkSession
    pieces = land(token_pieces(docs, path, capacity, closing_id), "pieces")
    parts = buckets or parallelism(spark)
    classed = pieces.withColumns(
        {
            "class": F.ceil(F.col("length") / F.lit(unit)).cast("long"),
            "part": F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)),
        }
    )
    per_part = classed.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = per_part.groupBy("class").agg(F.sum("n").alias("n")).collect()  # capacity / unit rows at most
    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long"
    if not histogram:
        placed = spark.createDataFrame([], names)
    else:
        classes = np.array([r["class"] for r in histogram], dtype=np.int64)
        demand = np.array([r["n"] for r in histogram], dtype=np.int64)
        places = _places(cutting_patterns(classes, demand, capacity // unit), classes)
        before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        first = per_part.select("class", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
        # capacity / unit x parts rows
        inside = Window.partitionBy("class", "part").orderBy("doc_id", "start", "ids_crc32")
        ranked = classed.withColumn("at", F.row_number().over(inside) - 1).join(F.broadcast(first), ["class", "part"])
        placed = (
            ranked.withColumn("rank", (F.col("first") + F.col("at")).cast("long"))
            .drop("first", "at", "part")
            .mapInArrow(_assign(places), names)
        )
    whole = Window.partitionBy("sequence_id")
    filled = whole.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("length").over(whole)
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("length").over(filled), F.lit(0)).cast("long").alias("offset"),
        F.when(total.bitwiseAND(total - 1) == 0, total).otherwise(F.lit(capacity)).cast("long").alias("padded_length"),
    )
