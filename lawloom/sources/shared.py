"""The folder that all executors share, for tables that outlive a query and tables that cut lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset and Spark runs on this machine alone, a folder of this process. RuntimeError on a cluster that names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="lawloom-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/lawloom/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()).exists(where)
