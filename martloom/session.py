"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # Event times have no zone in the sources, so the session must not shift them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Running counters hold one entry per key; keep them off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting (tests) gets a temporary folder. A
    cluster without it is refused: a machine-local folder would lose data with
    the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="martloom-")
    return _local_fallback[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder, never used by an earlier run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark can reach; nothing happens if it is gone."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system Spark can reach; none if it is not there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(jvm_path))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so that several
    readers scan only the columns they need instead of recomputing it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
