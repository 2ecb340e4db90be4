"""Row numbers over ordered groups of any size, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lawloom.sources.shared import stored


def row_numbers(df: DataFrame, group: list[str], order: list, name: str = "n") -> DataFrame:
    """Adds the row's number from 1 within its group by ``order`` (names, or columns such as descending ones).

    Rows are dealt over ranges of group and order and numbered where they lie; the number of a group's rows
    in the ranges before is added, from a table with a row for each range and group.
    """
    place = (1 << 33) - 1
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    rows = stored(ranged.withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id().bitwiseAND(F.lit(place))}), "ranges")
    parts = rows.groupBy("_p", *group).agg(F.min("_i").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]
    parts = parts.select(F.col("_p").alias("_q"), *keys, "_first", "_before")
    same = F.col("_p") == F.col("_q")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    found = rows.join(parts, same)
    return found.withColumn(name, F.col("_i") - F.col("_first") + F.col("_before") + 1).select(*df.columns, name)
