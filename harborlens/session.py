"""Session factory and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", app: str = "harborlens", **conf: str) -> SparkSession:
    """A session with the settings every query here assumes: UTC, ANSI, adaptive execution."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": "32m",  # bodies of many megabytes occur
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Where the setting is absent and the master is local (tests, single machines), a temporary folder is made and
    set as the checkpoint folder; on a cluster the absence is an error, for executors would not share that folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="harborlens-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, read without a job; '' where there is none."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return ""
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small text file by one rename, so that readers see the old text or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, new = file_system(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(new, file_system(spark, path)[1], options)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Renames a file or folder to a name that isn't taken; a rename that the file system refuses is an error."""
    fs, source = file_system(spark, old)
    target = file_system(spark, new)[1]
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"{old} was not moved to {new}")


_made: list[tuple[object, object]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. Results may still read from it, so it goes when the application ends, or by ``clear_scratch``."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(file_system(spark, path))
    return path


@atexit.register
def clear_scratch() -> None:
    """Removes what scratch_path gave out. Frames that read from there can't be used any more."""
    while _made:
        fs, path = _made.pop()
        with suppress(Exception):  # the JVM may be gone
            fs.delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Materialise df with checkpoint() in the shared folder, so that later stages survive the loss of executors."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: like ``cut``, but what follows is planned by the size it has."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
