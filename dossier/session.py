"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder used to cut lineage and stage intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_RUN_DIRS: dict[str, str] = {}
_COLLECTING: list[list[str]] = []


def half_memory() -> str:
    """Half of the machine's memory, 16 GB at most: the rest is for Python workers."""
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    return f"{max(1024, min(16 << 10, total // (2 << 20)))}m"


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "dossier") -> SparkSession:
    """Session for tests and the bench. On a cluster, the cluster's own
    settings win: ``getOrCreate`` returns the running session unchanged."""
    master = master or os.environ.get("DOSSIER_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DOSSIER_DRIVER_MEMORY") or half_memory())
        .config("spark.speculation", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of
    the session or its context, else a folder in the session's warehouse,
    which every executor can reach too. Never a machine-local one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if not named and current.isDefined():
        return current.get()
    named = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    if not current.isDefined():
        sc.setCheckpointDir(named)
    return named


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete one table folder through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _run_dir(spark: SparkSession) -> str:
    """This process's own folder under the shared one, removed when the
    process ends while its session is still up."""
    base = checkpoint_dir(spark).rstrip("/")
    if base not in _RUN_DIRS:
        path = _RUN_DIRS[base] = f"{base}/run-{uuid.uuid4().hex[:12]}"

        def clean() -> None:
            with contextlib.suppress(Exception):  # the session may be gone
                delete_path(spark, path)
        atexit.register(clean)
    return _RUN_DIRS[base]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh table path in this run's part of the shared folder."""
    path = f"{_run_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    for paths in _COLLECTING:
        paths.append(path)
    return path


@contextlib.contextmanager
def collected_paths(into: list[str]) -> Iterator[None]:
    """Also notes in ``into`` the paths handed out meanwhile, for their later deletion."""
    _COLLECTING.append(into)
    try:
        yield
    finally:
        _COLLECTING.remove(into)


def materialize(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and read it back. The plan above runs in exactly one job, so a slow or
    paid step (or a non-deterministic one) is never re-run by later
    actions, and lost executors recompute from the table, not the source."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    # the schema is known, so reading back needs no footer-reading job
    return spark.read.schema(df.schema).parquet(path)
