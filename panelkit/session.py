"""Session helpers: a session with the settings the jobs assume, and a place for shared files."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


_local_dirs: dict[str, str] = {}  # of local sessions without the setting, by application


def build_session(app: str = "panelkit", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session does not,
    because a folder on one machine is lost with the machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="panelkit-")
        path = _local_dirs[app]
    return path.rstrip("/")


_owners: list[list[str]] = []  # of the stored tables, innermost last


@contextmanager
def owned_tables(spark: SparkSession):
    """Deletes at its end what was stored inside. What a job returns has to be read from its own tables by then."""
    paths: list[str] = []
    _owners.append(paths)
    try:
        yield
    finally:
        _owners.remove(paths)
        for path in paths:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/panelkit-{name}-{uuid.uuid4().hex[:12]}"
    if _owners:
        _owners[-1].append(path)
    return path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once into the shared folder and read them back.

    Later jobs and lost executors reread the files instead of recomputing what led to them, and
    the planner sees the table's real size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The same with the number of rows, counted while writing.

    Tasks that are run again after a lost executor count again, so the number is never too low but
    may be too high: fit for choosing a safe plan, not for reporting.
    """
    rows = Observation()
    stored = store(df.observe(rows, F.count(F.lit(1)).alias("n")), name)
    return stored, rows.get["n"]


def spread(stored: DataFrame) -> DataFrame:
    """A stored table in at least as many partitions as there are cores.

    A small file is read by one task, which is right for cheap work but not before Python or
    model code; a large table has more splits than cores already and is left alone.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    return stored.repartition(cores) if stored.rdd.getNumPartitions() < cores else stored
