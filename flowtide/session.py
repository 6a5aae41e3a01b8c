"""Session settings and the shared folder for tables a job has to write on its way."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Windows and days are cut in UTC whatever the zone of the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Distinct destinations per source can outgrow the heap, so keyed state lives in RocksDB.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the library relies on to a running session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_job: ContextVar[str | None] = ContextVar("job", default=None)


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the current job's, or else below the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    base = _job.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="flowtide-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def job_tables(spark: SparkSession) -> Iterator[str]:
    """Everything written on the way inside lies in one folder, which is removed at the end.

    Results are read from those tables, so they have to be written or collected inside.
    """
    folder = new_folder(spark, "job")
    token = _job.set(folder)
    try:
        yield folder
    finally:
        _job.reset(token)
        remove_folder(spark, folder)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Used before iterative work: later passes scan a column file instead of repeating the
    aggregation, and a lost executor costs nothing but its own tasks.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(table: DataFrame) -> None:
    """Remove a table of :func:`materialize` once nothing will read it again."""
    remove_folder(table.sparkSession, table.written_to)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of :func:`new_folder` with all it holds."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
