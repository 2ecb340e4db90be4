"""Tables with a tree of digests, so that two of them are compared where they differ only.

Rows are dealt over leaves by a hash of their key. A leaf's digest is the sum of
its rows' digests, word by word, and a node's that of its children: order does
not matter, repeated rows count, and no task holds a leaf's rows. Comparing
descends from the root along nodes that differ; of the rows only those of leaves
that differ are read.
"""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lawloom.sources.shared import stored
from lawloom.sources.snapshots import get_text, put_text

WORDS, FAN = 8, 4
ROWS_A_LEAF, MOST_BITS = 1 << 12, 28
FOLDERS_BITS, FEW = 8, 1000


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row's values by name, as JSON with nulls."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def _words(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(WORDS)]


def _node(leaf: Column, bits: int, level: int) -> Column:
    """The node above a leaf: level 0 is the root, each level has FAN more bits."""
    return F.shiftright(leaf, max(0, bits - FAN * level))


def write_digested(df: DataFrame, key: str, path: str, bits: int | None = None) -> None:
    """The rows of ``df`` at ``path``/rows, in folders by a hash of their key and sorted by leaf, and their tree at ``path``/tree.

    Tables are comparable when their leaves have the same number of ``bits``; by default it follows from the rows.
    """
    if bits is None:
        bits = min(MOST_BITS, max(FAN, FAN * math.ceil(math.log2(max(1, df.count() / ROWS_A_LEAF)) / FAN)))
    leaf = F.shiftrightunsigned(F.xxhash64(key), 64 - bits)
    rows = df.select("*", leaf.alias("_leaf"), F.shiftright(leaf, max(0, bits - FOLDERS_BITS)).cast("int").alias("_folder"))
    rows.repartition("_folder", F.shiftright("_leaf", max(0, bits - FOLDERS_BITS - 4))).sortWithinPartitions("_folder", "_leaf").write.mode("overwrite").partitionBy("_folder").option("compression", "zstd").parquet(f"{path}/rows")
    put_text(df.sparkSession, f"{path}/shape.json", json.dumps({"bits": bits, "key": key, "columns": df.columns, "schema": json.loads(rows.schema.json())}))
    kept, sums = _rows(df.sparkSession, path), [f"w{i}" for i in range(WORDS)]
    level = kept.select(F.col("_leaf").alias("node"), *[w.alias(s) for w, s in zip(_words(row_digest(df.columns)), sums, strict=True)]).groupBy("node").agg(F.count("*").alias("n"), *[F.sum(s).alias(s) for s in sums])
    leaves = stored(level, "leaves")
    levels = [leaves.groupBy(_node(F.col("node"), bits, i).alias("node")).agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums]).withColumn("level", F.lit(i)) for i in range(bits // FAN)]
    tree = reduce(DataFrame.unionByName, [*levels, leaves.withColumn("level", F.lit(bits // FAN))])
    tree.repartitionByRange("level", "node").sortWithinPartitions("level", "node").write.mode("overwrite").parquet(f"{path}/tree")


def _shape(spark: SparkSession, path: str) -> dict:
    found = get_text(spark, f"{path}/shape.json")
    if found is None:
        raise ValueError(f"no tree at {path}")
    return json.loads(found)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(StructType.fromJson(_shape(spark, path)["schema"])).parquet(f"{path}/rows")


def _differing(spark: SparkSession, a: str, b: str, level: int, among: list[int] | DataFrame) -> DataFrame:
    """(node) of a level whose digests differ, among the children of the given nodes of the level above."""
    sums = ["n", *[f"w{i}" for i in range(WORDS)]]

    def side(path: str, mark: str) -> DataFrame:
        tree = spark.read.parquet(f"{path}/tree").where(F.col("level") == level)
        parent = F.shiftright("node", FAN)
        if isinstance(among, list):
            tree = tree.where(parent.isin(among)) if level else tree
        else:
            tree = tree.withColumn("_p", parent).join(among.withColumnRenamed("node", "_p"), "_p", "left_semi")
        return tree.select("node", F.struct(*sums).alias(mark))

    both = side(a, "x").join(side(b, "y"), "node", "full")
    return both.where(~F.col("x").eqNullSafe(F.col("y"))).select("node")


def differing_leaves(spark: SparkSession, a: str, b: str) -> DataFrame:
    """(node) of the leaves in which two written tables differ. ValueError where their leaves are not the same ranges."""
    one, two = _shape(spark, a), _shape(spark, b)
    if (one["bits"], one["key"], sorted(one["columns"])) != (two["bits"], two["key"], sorted(two["columns"])):
        raise ValueError("the tables have other leaves, keys or columns")
    among: list[int] | DataFrame = []
    for level in range(one["bits"] // FAN + 1):
        found = stored(_differing(spark, a, b, level, among), "nodes")
        few = found.limit(FEW + 1).collect()
        if not few:
            return found
        among = [r.node for r in few] if len(few) <= FEW else found
    return found


def differences(spark: SparkSession, a: str, b: str) -> DataFrame:
    """The rows that one table has more often than the other, as often as it does, with ``side`` a or b.

    Folders, and within them leaves while they are few, are chosen before rows are read.
    """
    shape, leaves = _shape(spark, a), differing_leaves(spark, a, b)
    bits, columns = shape["bits"], shape["columns"]
    folders = [r.f for r in leaves.select(F.shiftright("node", max(0, bits - FOLDERS_BITS)).cast("int").alias("f")).distinct().collect()]  # 256 at most
    few = leaves.limit(FEW + 1).collect()

    def side(path: str) -> DataFrame:
        rows = _rows(spark, path).where(F.col("_folder").isin(folders))
        rows = rows.where(F.col("_leaf").isin([r.node for r in few])) if len(few) <= FEW else rows.join(leaves.withColumnRenamed("node", "_leaf"), "_leaf", "left_semi")
        return rows.select(columns)

    x, y = side(a), side(b)
    return x.exceptAll(y).withColumn("side", F.lit("a")).unionByName(y.exceptAll(x).withColumn("side", F.lit("b")))
