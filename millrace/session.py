"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC and adaptive execution with
    skew-join splitting. On a cluster, leave `master` to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in `spark.checkpoint.dir`.

    Where the setting is missing, a local session gets a temporary folder; a cluster session is
    refused, since a machine-local folder would be lost with its machine."""
    context = spark.sparkContext
    root = context.getConf().get(CHECKPOINT_CONF) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(root)
    return root


def working_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared root, for a stream's checkpoint or an intermediate table."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [s.getPath().toString() for s in found or []]


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there already; of several writers at once only one gets true."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place.getParent())
    try:
        files.create(place, False).close()
    except Py4JJavaError:
        if files.exists(place):
            return False
        raise
    return True


def delete_file(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write a frame to a table under the shared root and read it back: computed once, even if
    executors are lost later, and read by column. Batch."""
    path = working_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
