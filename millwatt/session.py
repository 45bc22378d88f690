"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that can be changed on a running session; every job sets them before planning.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows of captured tables and readings compress about tenfold: a task that sorts or hashes a partition of this size needs
    # a few hundred MB however large the table is. The default of 64 MB takes four times that.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Split a skewed join partition even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of code. Wide map-to-column projections
    # exceed that as one stage; past the limit Spark generates them as several small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def get_session(app: str = "millwatt", master: str | None = None, **extra: str) -> SparkSession:
    """Create or reuse a session; ``master`` is left to the cluster unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {"spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


_local_root: list[str] = []
_made: list[str] = []


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for ``purpose`` under the shared folder named by ``spark.checkpoint.dir``.

    Only a session that runs in one process on one machine, as in unit tests, may leave the setting out; it
    gets a local folder that goes with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="run-"))
            atexit.register(shutil.rmtree, _local_root[0], ignore_errors=True)
        root = _local_root[0]
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` under the shared folder now and read it again, for frames that several branches of a plan need."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove the folders this process asked for; call it when no frame built on them is needed any more."""
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
