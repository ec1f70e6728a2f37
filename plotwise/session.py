"""Session defaults and staged tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for; the cluster's own values win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of code; wide projections are then faster as separate expressions.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "plotwise", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may fall
    back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="plotwise-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative training cut its lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder in the shared one, deleted with the staged tables."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not _STAGED:
        atexit.register(drop_staged, spark)
    _STAGED.append(path)
    return path


# Tasks for each core that a pass of wide row work is cut into, where the files are large enough (4 MB a task).
TURNS = 4


@contextmanager
def row_work(spark: SparkSession) -> Iterator[None]:
    """Settings for writing tables by wide projections, in sessions that ``get_session`` did not make, too.

    Methods stay small enough for the JVM to compile, and compressed files are read in more tasks than cores, as their rows
    take long for their bytes. A task holds the files of up to eight folders open, so rows that go into a few are not sorted by them. Values that the session has are kept; where it has none, it has none afterwards.
    """
    wanted = {"spark.sql.codegen.hugeMethodLimit": DEFAULTS["spark.sql.codegen.hugeMethodLimit"],
              "spark.sql.files.minPartitionNum": str(TURNS * spark.sparkContext.defaultParallelism),
              "spark.sql.maxConcurrentOutputFileWriters": "8"}
    unset = [name for name in wanted if spark.conf.get(name, None) is None]
    try:
        for name in unset:
            spark.conf.set(name, wanted[name])
        yield
    finally:
        for name in unset:
            spark.conf.unset(name)


def staged(df: DataFrame, name: str = "stage", compression: str | None = None, by: str | None = None, block: int | None = None) -> DataFrame:
    """Write a table once and read it back, in a folder for each value of ``by`` if that is given.

    For inputs that several passes read: the lineage is cut, later passes prune
    columns and push filters into the files, and a lost executor costs nothing.
    A file can be read in parts of about ``block`` bytes (128 MB if that is not given).
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    (df.write if block is None else df.write.option("parquet.block.size", block)).parquet(path, partitionBy=by, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


_STAGED: list[str] = []


def drop_staged(spark: SparkSession) -> None:
    """Delete the tables staged by this process so far; tables read from them must not be used any more.

    Called when the driver ends. A service that runs many jobs calls it between them.
    """
    while _STAGED:
        path = _STAGED.pop()
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the JVM may be gone by now
            _STAGED.clear()
