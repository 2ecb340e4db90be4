"""Incremental runs as file streams that end when nothing is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lawloom.operators import chunking, versions
from lawloom.sources.shared import path_exists


BUCKETS, FEW = 256, 100


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def _least(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """For each key its row of least ``order``, rows of equal order by their other columns; the same whatever way the rows came in."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = df.groupBy(*keys).agg(F.min(F.struct(*[c for c in order if c not in keys], *rest)).alias("_r"))
    return first.select(*keys, "_r.*").select(*df.columns)


def new_records(spark: SparkSession, folder: str, schema: str, keys: list[str], order: list[str], known_path: str, checkpoint: str) -> StreamingQuery:
    """Record files by key: of each key the row of least ``order`` counts (``known_records``), however the files are split into batches.

    The least row of each key is state of the stream, kept by key in its state store for good; a batch reads its own files
    only, and writes the keys that it touches to a folder of its own, which a retry replaces. Null keys are
    equal to each other. Columns must have an order (no maps).
    """

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{known_path}/batch={number}")

    stream = _least(spark.readStream.schema(schema).json(folder), keys, order)
    return stream.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def known_records(spark: SparkSession, known_path: str, keys: list[str], order: list[str]) -> DataFrame:
    """The records that ``new_records`` has found, a row a key: what a later batch knows better takes the place of what an earlier one wrote."""
    return _least(spark.read.parquet(known_path).drop("batch"), keys, order)


def chunk_new_versions(spark: SparkSession, folder: str, schema: str, chunks_path: str, checkpoint: str, **budget: int) -> StreamingQuery:
    """Chunk version files once: versions that have no chunks in the table at ``chunks_path`` get theirs; kept chunks are not touched. A retried batch replaces its own folder."""

    def batch(df: DataFrame, number: int) -> None:
        rows = _least(df, ["version_id"], [])
        known = _table(spark, chunks_path)
        if known is not None:
            rows = rows.join(known.where(F.col("batch") != number).select("version_id").distinct(), "version_id", "left_anti")
        chunking.build_chunks(chunking.chunkable(rows), None, **budget).write.mode("overwrite").parquet(f"{chunks_path}/batch={number}")

    return _run(spark.readStream.schema(schema).json(folder), batch, checkpoint)


def relink_versions(spark: SparkSession, folder: str, schema: str, versions_path: str, links_path: str, checkpoint: str) -> StreamingQuery:
    """Version files that come in any order: all versions of a touched document are linked anew, so a late, older one takes its place in the chain.

    Versions lie in folders by a hash of their document, sorted by document; a batch opens only the folders of the
    documents it touches, and in them only the parts that hold these (``touched_versions``). Links lie in a folder a
    batch; of a version's links those of the last batch count (``current_links``). Of rows with one version_id the
    least counts, so rows that are there already change nothing.
    """

    def batch(df: DataFrame, number: int) -> None:
        rows = _least(df, ["version_id"], []).withColumn("bucket", _bucket(F.col("document_id")))
        rows.repartition("bucket").sortWithinPartitions("bucket", "document_id").write.mode("overwrite").partitionBy("bucket").parquet(f"{versions_path}/batch={number}")
        every = _least(touched_versions(spark, versions_path, df).drop("batch", "bucket"), ["version_id"], [])
        linked = versions.version_chain(every)
        linked.select("version_id", "document_id", "previous_version_id", "next_version_id", "position").write.mode("overwrite").parquet(f"{links_path}/batch={number}")

    return _run(spark.readStream.schema(schema).json(folder), batch, checkpoint)


def _bucket(document: Column) -> Column:
    return F.pmod(F.xxhash64(document), F.lit(BUCKETS)).cast("int")


def touched_versions(spark: SparkSession, versions_path: str, rows: DataFrame) -> DataFrame:
    """Stored versions of the documents of ``rows``. Folders are chosen by their numbers (at most ``BUCKETS``); documents prune within them while they are few, and by a join always."""
    documents = rows.select("document_id").distinct()
    found = spark.read.parquet(versions_path).where(F.col("bucket").isin([r.b for r in documents.select(_bucket(F.col("document_id")).alias("b")).distinct().collect()]))
    few = documents.limit(FEW + 1).collect()
    if len(few) <= FEW:
        found = found.where(F.col("document_id").isin([r.document_id for r in few]))
    return found.join(documents, "document_id", "left_semi")


def current_links(spark: SparkSession, links_path: str) -> DataFrame:
    """The links of each version as the last batch that touched its document has them."""
    rows = spark.read.parquet(links_path)
    return rows.groupBy("version_id").agg(F.max_by(F.struct("document_id", "previous_version_id", "next_version_id", "position"), "batch").alias("x")).select("version_id", "x.*")
