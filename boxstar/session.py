"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "boxstar") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BOXSTAR_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must name a folder that all executors
    share; without it this raises. Only a local master (tests) gets a fresh
    folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="boxstar-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once an application: they may not see the driver's folders."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="boxstar-code-")), "boxstar-package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in (n for n in names if n.endswith(".py")):
                p = os.path.join(folder, n)
                z.write(p, os.path.join("boxstar", os.path.relpath(p, root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/boxstar-{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder in any store that Spark writes to; nothing happens if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Files that one task of a partitioned write keeps open; rows of further partitions are sorted first.
OPEN_WRITERS = 64


@contextmanager
def unsorted_partitions(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep a file open for each partition value that a task meets,
    instead of sorting its whole rows by that value."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    former = spark.conf.get(name, None)
    spark.conf.set(name, str(OPEN_WRITERS))
    try:
        yield
    finally:
        spark.conf.unset(name) if former is None else spark.conf.set(name, former)


_ACTIVE: ContextVar[Scratch | None] = ContextVar("boxstar_scratch", default=None)


class Scratch:
    """The tables that one owner has landed.

    While :meth:`active`, :func:`land` notes its tables here, however deep it is called;
    :meth:`close` removes them. What others have landed, or what lies in the checkpoint folder
    otherwise, is left alone.
    """

    def __init__(self):
        self.landed: list[tuple[SparkSession, str]] = []

    @contextmanager
    def active(self) -> Iterator[Scratch]:
        token = _ACTIVE.set(self)
        try:
            yield self
        finally:
            _ACTIVE.reset(token)

    def close(self) -> None:
        """Remove the landed tables; frames that read them can be used no more."""
        while self.landed:
            remove_path(*self.landed.pop())


def land(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back.

    Same guarantees as a reliable checkpoint (durable, lineage cut), plus
    columnar storage: later scans read only the columns they use, push
    filters down, and give the planner real sizes for join choices. An active
    :class:`Scratch` owns the table; without one it stays in the checkpoint folder until
    that is cleaned. A write that fails leaves nothing. With ``partition_by`` every task writes
    its rows where they are: they are neither dealt out nor sorted by the partition value.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    try:
        with unsorted_partitions(spark):
            writer.parquet(path)
    except BaseException:
        remove_path(spark, path)
        raise
    owner = _ACTIVE.get()
    if owner is not None:
        owner.landed.append((spark, path))
    return spark.read.schema(df.schema).parquet(path) if partition_by else spark.read.parquet(path)
