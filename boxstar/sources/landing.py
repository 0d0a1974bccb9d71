"""Written tables that are replaced in one step.

A table, or a set of tables, lives in a folder of its version; a small pointer table beside
it names the version that counts. A rebuild writes a new folder and adds its row to the
pointer last: one file, committed by one rename. Until then, and if the rebuild fails,
readers see the former version, whole. The version before the current one is kept for readers
that have opened it; older ones are removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from boxstar.session import remove_path, unsorted_partitions

POINTER = "current"
KEPT = 2


def _path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


class VersionedFolder:
    """The versions under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def history(self) -> list[str]:
        """Names of the published versions, the current one last."""
        try:
            rows = self.spark.read.schema("version long, folder string").parquet(f"{self.root}/{POINTER}").collect()
        except AnalysisException as error:
            if _path_missing(error):
                return []
            raise
        return [r.folder for r in sorted(rows, key=lambda r: (r.version, r.folder))]

    def current(self) -> str | None:
        """Path of the current version."""
        names = self.history()
        return f"{self.root}/{names[-1]}" if names else None

    def replace(self, write: Callable[[str], None], force_rebuild: bool = True) -> str:
        """Let ``write`` fill a new folder and make it the current one. Where a version is there already,
        ``force_rebuild=False`` raises FileExistsError. If ``write`` fails, its folder goes and the
        current version stays."""
        names = self.history()
        if names and not force_rebuild:
            raise FileExistsError(f"{self.root} holds a version already")
        name = f"v{len(names) + 1:06d}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{name}"
        try:
            write(path)
        except BaseException:
            remove_path(self.spark, path)
            raise
        row = self.spark.createDataFrame([(len(names) + 1, name)], "version long, folder string")
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/{POINTER}")
        for old in [*names, name][:-KEPT]:
            remove_path(self.spark, f"{self.root}/{old}")
        return path


def write_files(df: DataFrame, path: str, partition_by: Iterable[str] | None = None) -> None:
    """Write Parquet files to a folder that must not be there yet."""
    w = df.write.mode("errorifexists")
    with unsorted_partitions(df.sparkSession):
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_table(df: DataFrame, path: str, force_rebuild: bool = True, partition_by: list[str] | None = None) -> str:
    """Write a table; ``force_rebuild`` replaces it in one step, otherwise an existing one is an error."""
    VersionedFolder(df.sparkSession, path).replace(lambda folder: write_files(df, folder, partition_by), force_rebuild)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Reopen a written table (read only), or plain Parquet files."""
    return spark.read.parquet(VersionedFolder(spark, path).current() or path)
