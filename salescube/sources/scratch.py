"""Intermediate tables that outlive a lost executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


#: By application: the folder of a one-process session that names none, removed when the process ends.
_OWN: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.

    Only a session whose executors are threads of the driver may leave it unset; it gets one folder of its own.
    """
    context = spark.sparkContext
    shared = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if shared:
        return shared.rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="salescube-")
        atexit.register(shutil.rmtree, _OWN[context.applicationId], ignore_errors=True)
    return _OWN[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many: cuts the lineage with a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def release(staged: DataFrame) -> None:
    """Remove the files of a staged table once its last reader has finished."""
    spark = staged.sparkSession
    folder = scratch_dir(spark)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    home = jvm.org.apache.hadoop.fs.Path(folder)
    home = home.getFileSystem(conf).makeQualified(home).toString()
    for parent in {file.rsplit("/", 1)[0] for file in staged.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        files = path.getFileSystem(conf)
        if files.makeQualified(path.getParent()).toString() == home:
            files.delete(path, True)
