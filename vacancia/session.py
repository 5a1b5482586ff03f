"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "vacancia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Shuffle partitions are left to the cluster unless given: AQE coalesces small ones and splits
    skewed ones, so a generous number is the safe choice at scale.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Plans are built from many small expressions; recording a call site for each is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A folder for checkpoints and cut lineage, below the shared folder the cluster names.

    A machine-local folder is only ever used by a local session that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return os.path.join(tempfile.mkdtemp(prefix="run-"), name)


#: Values of the columns written by, whose files a task keeps open; one that meets more sorts its rows.
OPEN_FILES = 32


@contextmanager
def _writers(spark: SparkSession, files: int) -> Iterator[None]:
    """Lets a task write several files at a time, so that its rows needn't be sorted by the file they go to."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    if files:
        spark.conf.set(name, files)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut_lineage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For results that several later steps read: they are computed once, and a lost executor costs a
    read instead of the computation. The files stay until :func:`clear_work`. A step that wants one value
    of the columns ``by`` opens only the files of that one.
    """
    application = df.sparkSession.sparkContext.applicationId
    path = work_folder(df.sparkSession, f"{application}/{name}-{uuid.uuid4().hex}")
    with _writers(df.sparkSession, OPEN_FILES if by else 0):
        df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def clear_work(spark: SparkSession) -> None:
    """Delete what this application's :func:`cut_lineage` calls have written to the shared folder.

    To be called when no frame that was read back is needed any more.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
