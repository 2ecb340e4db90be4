"""Exact set-similarity join by rare elements.

The overlap of two sets is what they share over the smaller of them. Of the
smaller set, ``need`` elements must be shared, so at least ``seen`` of its first
``size - need + seen`` elements are, whatever their order. In order of rarity
these prefixes meet few other sets: an inverted index of prefixes is joined with
all elements, shared elements are counted by pair while they are shuffled, and
only pairs with enough of them are compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.functions.text import overlap_ratio
from lawloom.sources.shared import stored

#: Ratios are compared with six decimals.
ROUNDING = 5e-7


def needed(size: Column, least: float) -> Column:
    """How many elements a set of this size must share as the smaller of two."""
    return F.greatest(F.lit(1), F.ceil((F.lit(least) - ROUNDING) * size)).cast("int")


def _elements(sets: DataFrame) -> DataFrame:
    """(part, id, size, e): a row for each element, as a hash. Equal elements have equal hashes, so none is lost; whole sets are compared at last."""
    return sets.select("part", "id", F.size("items").alias("size"), F.explode(F.transform("items", lambda x: F.xxhash64(x))).alias("e"))


def candidate_pairs(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of one part that share enough rare elements of the smaller set; left and right are (part, id, items), ids unique in a side.

    No pair with an overlap of ``least`` or more is left out. Elements are shuffled by part and element, so a
    large part is no single task.
    """
    both = stored(_elements(left).withColumn("side", F.lit(0)).unionByName(_elements(right).withColumn("side", F.lit(1))), "elements")
    often = both.groupBy("part", "e").agg(F.count_if(F.col("side") == 0).alias("l"), F.count_if(F.col("side") == 1).alias("r"))
    # what only one side has is rarest, and joins nothing
    ranked = both.join(often, ["part", "e"]).withColumn("pairs", F.col("l") * F.col("r"))
    place = F.row_number().over(Window.partitionBy("side", "part", "id").orderBy("pairs", "e"))
    need = needed(F.col("size"), least)
    seen = F.greatest(F.lit(1), F.floor(need / 4)).cast("int")
    ranked = stored(ranked.withColumn("place", place).withColumn("seen", seen).where("pairs > 0").select("side", "part", "id", "size", "e", "seen", (F.col("place") <= F.col("size") - need + seen).alias("prefix")), "ranked")
    side = lambda n, mark: ranked.where(F.col("side") == n).select("part", "e", *[F.col(c).alias(f"{mark}_{c}") for c in ("id", "size", "seen", "prefix")])
    # the smaller set's prefix against all elements of the other; of two equal sizes the left one is the smaller
    met = side(0, "a").join(side(1, "b"), ["part", "e"]).where(F.when(F.col("a_size") <= F.col("b_size"), F.col("a_prefix")).otherwise(F.col("b_prefix")))
    counted = met.groupBy("a_id", "b_id").agg(F.count("*").alias("n"), F.min(F.when(F.col("a_size") <= F.col("b_size"), F.col("a_seen")).otherwise(F.col("b_seen"))).alias("seen"))
    return counted.where("n >= seen").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))


def overlap_join(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b, score) of all pairs of one part whose overlap, to six decimals, is ``least`` or more; ``least`` is over 0.

    Sides are (part, id, items) with items an array of different values. Null parts, and empty or null sets, meet nothing.
    """
    if least <= ROUNDING:
        raise ValueError("pairs without a common element cannot be found by their elements")
    pairs = candidate_pairs(left, right, least)
    whole = pairs.join(left.select(F.col("id").alias("a"), F.col("items").alias("x")), "a").join(right.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    return whole.select("a", "b", overlap_ratio(F.col("x"), F.col("y")).alias("score")).where(F.col("score") >= least)
