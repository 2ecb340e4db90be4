"""Substring search by an index of trigrams.

Every position of a text begins a trigram (two signs that no text has fill the
end), so a part of three signs or more occurs only in texts that have all of its
trigrams, and a shorter one only in texts with a trigram that begins with it.
The rarest trigrams of a part give candidates, which the text itself confirms.
"""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from lawloom.operators.postings import Segment, bucket_number, in_blocks
from lawloom.sources.shared import path_exists
from lawloom.sources.snapshots import get_text, put_text

FILL = "\x00\x00"
BLOCK = 1024
BUCKETS = 64
RAREST = 4


@F.pandas_udf(ArrayType(StringType()))
def trigrams(text: pd.Series) -> pd.Series:
    """The different trigrams of a text, one from each position; none of an empty one or null."""
    return text.map(lambda t: [] if not t else list({(t + FILL)[i : i + 3] for i in range(len(t))}))


def _bucket(gram: Column) -> Column:
    """By the first sign, so that trigrams with a common beginning lie together."""
    return (F.crc32(F.substring(gram, 1, 1).cast("binary")) % BUCKETS).cast("int")


def write_trigrams(rows: DataFrame, key: str, fields: list[str], path: str) -> None:
    """(field, gram, n, keys) in blocks of at most 1,024 keys at ``path``/grams, in folders by the first sign, sorted by gram."""
    found = rows.select(key, F.explode(F.array(*[F.struct(F.lit(i).cast("tinyint").alias("field"), trigrams(F.col(f)).alias("g")) for i, f in enumerate(fields)])).alias("x"))
    found = found.select(key, "x.field", F.explode("x.g").alias("gram"))
    blocks = in_blocks(found.withColumn("bucket", _bucket(F.col("gram"))), ["bucket", "field", "gram"], [F.col(key)], BLOCK, [key])
    blocks = blocks.select("field", "gram", "block", "n", F.transform("members", lambda x: x[key]).alias("keys"), "bucket")
    blocks.write.mode("overwrite").partitionBy("bucket").option("compression", "zstd").parquet(f"{path}/grams")
    put_text(rows.sparkSession, f"{path}/grams.json", json.dumps({"fields": fields, "schema": json.loads(blocks.drop("bucket").schema.json())}))


def _read(spark: SparkSession, segments: list[Segment], field: str, signs: set[str]) -> DataFrame | None:
    """Blocks of a field whose gram begins with one of these signs; a ValueError for a segment without this index."""
    parts = []
    for s in segments:
        shape = get_text(spark, f"{s.path}/grams.json")
        if shape is None:
            raise ValueError(f"no trigrams at {s.path}")
        shape = json.loads(shape)
        paths = [p for b in sorted({bucket_number(c, BUCKETS) for c in signs}) if path_exists(spark, p := f"{s.path}/grams/bucket={b}")]
        if paths:
            parts.append(spark.read.schema(StructType.fromJson(shape["schema"])).parquet(*paths).where(F.col("field") == shape["fields"].index(field)))
    return reduce(DataFrame.unionByName, parts) if parts else None


def candidates(spark: SparkSession, segments: list[Segment], key: str, field: str, part: str) -> DataFrame | None:
    """(key) of the rows whose ``field`` may hold ``part``, dead rows among them: all that do, and few others. None where the index cannot tell, as for an empty part."""
    if not part:
        return None
    if len(part) < 3:
        blocks = _read(spark, segments, field, {part[0]})
        empty = None if blocks is not None else spark.createDataFrame([], f"{key} string")
        return empty if blocks is None else blocks.where(F.col("gram").startswith(part)).select(F.explode("keys").alias(key)).distinct()
    grams = sorted({part[i : i + 3] for i in range(len(part) - 2)})
    blocks = _read(spark, segments, field, {g[0] for g in grams})
    if blocks is None:
        return spark.createDataFrame([], f"{key} string")
    blocks = blocks.where(F.col("gram").isin(grams))
    often = {r.gram: r.n for r in blocks.groupBy("gram").agg(F.sum("n").alias("n")).collect()}  # a row a trigram of the part
    if len(often) < len(grams):
        return spark.createDataFrame([], f"{key} {blocks.schema['keys'].dataType.elementType.simpleString()}")
    rare = sorted(grams, key=lambda g: (often[g], g))[:RAREST]
    return blocks.where(F.col("gram").isin(rare)).select(F.explode("keys").alias(key)).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") == len(rare)).select(key)


def holding(spark: SparkSession, segments: list[Segment], rows: DataFrame, key: str, parts: list[tuple[str, str]]) -> DataFrame:
    """``rows`` that hold a part in its field, for one of ``parts`` (field, part): candidates of the index, confirmed on their texts."""
    confirmed = reduce(lambda a, b: a | b, [F.col(f).contains(p) for f, p in parts])
    found = [candidates(spark, segments, key, f, p) for f, p in parts]
    if any(c is None for c in found) or not segments:
        return rows.where(confirmed)
    keys = reduce(DataFrame.unionByName, found).distinct()
    return rows.join(keys, key, "left_semi").where(confirmed)
