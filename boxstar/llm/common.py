"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from boxstar.session import ensure_checkpoint_dir
from boxstar.session import land as land  # re-exported: one way to cut lineage

#: Rows per Arrow batch: documents may be long, so a batch stays at a few MB.
ARROW_ROWS = 512

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make the session ready for the Arrow operators.

    Sets the shared checkpoint folder, lowers the rows per Arrow batch so that
    long texts do not pile up in one batch, and ships this package to the
    workers once per application (they may not see the driver's folders).
    """
    ensure_checkpoint_dir(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(ARROW_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="boxstar-code-")), "boxstar.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        p = os.path.join(folder, n)
                        z.write(p, os.path.join("boxstar", os.path.relpath(p, root)))
        spark.sparkContext.addPyFile(target)
        _SHIPPED.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session (the unit for choosing bucket counts)."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
