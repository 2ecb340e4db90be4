"""Shared-folder tables that cut lineage, and small helpers of the corpus operators.

Every table written here lies below ``spark.checkpoint.dir`` (read from the
session), so it survives the loss of an executor and is visible to all of them.
Only where that setting is absent and Spark runs on this machine alone, as in
unit tests, a folder of this process is made and announced to Spark.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. RuntimeError on a cluster that names none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and (at := spark.sparkContext.getCheckpointDir()):
        found = at
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
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(run: Callable) -> Callable:
    """A task's function over Arrow batches that gives back unused memory when it ends: workers are used again, and what one task freed would still count for the next."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only some systems have it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` wrote and that nothing reads any more. What is already gone is no error."""
    for df in tables:
        files = df.inputFiles()
        if files:
            context = df.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): label is the least node that ``edges`` (a, b) reach from node.

    Alternating large-star and small-star contraction: each round is two shuffles
    of the edge list, whose size never grows; rounds are about the logarithm of
    the longest chain. Each round is written to the shared folder. Self loops and
    null ends are ignored. An empty edge list gives an empty result. RuntimeError if
    ``max_rounds`` do not settle the labels.
    """
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    e = stored(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.distinct()
        first = low.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            low.join(first, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
            .select(F.col("x.v").alias("u"), F.col("x.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        e = stored(small, "cc")
        now = e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return (
        e.groupBy("u")
        .agg(F.min("v").alias("label"))
        .select(F.col("u").alias("node"), "label")
        .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
    )


def least_of_components(labels: DataFrame, names: DataFrame) -> DataFrame:
    """(node, component): the smallest ``least`` that ``names`` (node, least) has for the nodes of each node's component, for the nodes of ``labels`` (node, label)."""
    smallest = labels.join(names, "node").groupBy("label").agg(F.min("least").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
