"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    # all times are UTC instants; text without a zone is read as UTC
    "spark.sql.session.timeZone": "UTC",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("broadsheet")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach, named by ``spark.checkpoint.dir``.

    On one machine, where every path is shared, the warehouse serves if the setting is absent.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared root."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _file_system(spark, path)
    return files.exists(where)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern."""
    where, files = _file_system(spark, pattern)
    return [s.getPath().toString() for s in files.globStatus(where) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, wherever Spark can write."""
    where, files = _file_system(spark, path)
    files.delete(where, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write rows to a table under the shared root and read them back.

    Cuts the lineage without depending on any executor, and gives the planner
    the true size of the rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the duration of a block; a query started in it keeps them."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_settings(partitions: int | None = None) -> dict[str, str]:
    """Settings for a stateful stream: state in RocksDB, in as many partitions as asked for (else the session's)."""
    values = {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # counting the keys costs a look-up per written key
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    }
    if partitions:
        values["spark.sql.shuffle.partitions"] = str(partitions)
    return values
