"""Data-parallel training by parameter averaging.

Every training task starts from the same parameters, works through its own
share of all rows, and returns its parameters cut into blocks; the blocks are
averaged by the executors, weighted by the rows behind them. The driver sees
the averaged parameters only, whose size does not depend on the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from boxstar.llm.common import parallelism

BLOCK = 1024
_SCHEMA = "block int, weight double, part binary"


def _average(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    weight = table["weight"].to_numpy()
    total = np.zeros(len(table["part"][0].as_py()) // 4)
    for w, part in zip(weight, table["part"]):
        total += w * np.frombuffer(part.as_py(), dtype=np.float32)
    mean = (total / weight.sum()).astype(np.float32)
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "weight": [float(weight.sum())], "part": [mean.tobytes()]})


def train_averaged(
    rows: DataFrame, start: np.ndarray, work: Callable[[Iterator[pa.RecordBatch], np.ndarray], tuple[float, np.ndarray]]
) -> np.ndarray:
    """Average of the parameters that ``work(batches, parameters)`` returns in
    each task, weighted by the amount of work that it reports. Without any work
    the result is ``start``. ``start`` is a flat float32 vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, params = work(batches, start.copy())
        if weight > 0:
            flat = np.asarray(params, dtype=np.float32)
            parts = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([float(weight)] * len(parts)), pa.array(parts, pa.binary())],
                names=["block", "weight", "part"],
            )

    # one set of parameters a task: at most as many as the session has shuffle partitions
    shared = rows.coalesce(parallelism(rows.sparkSession)).mapInArrow(run, _SCHEMA)
    averaged = shared.groupBy("block").applyInArrow(_average, _SCHEMA).collect()
    out = start.astype(np.float32).copy()
    for r in averaged:
        part = np.frombuffer(r["part"], dtype=np.float32)
        out[r["block"] * BLOCK : r["block"] * BLOCK + len(part)] = part
    return out
