"""Mixing sources to target weights with hash thresholds, in DataFrame operations only.

Each source's target is a multiple of its size: whole copies of everything, and
one more copy of a part. That part is what hashes below a threshold: words are
summed by source and hash bucket, the bucket in which the budget ends is found
from the sums, and only its rows are summed again by the next bits of the hash.
After three rounds of 12 bits the last bucket, a document or a few, gives the
words that are missing, in proportion. Rows are never sorted, and a row's place
depends on its hash alone, so thresholds of a larger budget include those of a
smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = (52, 40, 28)
BITS = 4095


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(key, source_size, target) from (key, source, source_size).

    Sources in code-point order, null last, take the weights in turn and share the sum of all sizes;
    no target exceeds ``most`` times its source's size, and what is over goes to the others by weight.
    Taken in the order of size for weight, the sources at their limit come first, so one running sum finds them.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    w = sizes.withColumn("weight", turn).withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("total", F.sum("source_size").over(every).cast("double")).withColumn("all_weight", F.sum("weight").over(every))
    w = w.withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    w = w.withColumn("full", F.col("left") >= F.col("ratio") * F.col("left_weight"))
    free = w.withColumn("used", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)).withColumn("used_weight", F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0.0)).over(every))
    share = (F.col("total") - F.col("used")) * F.col("weight") / (F.col("all_weight") - F.col("used_weight"))
    return free.select("key", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(share).alias("target"))


def _hashed() -> dict[str, Column]:
    """size, key and h of a document, from its own columns."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return {"__size": size, "__key": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")), "__h": F.xxhash64("doc_id", "text")}


def _bucket(shift: int) -> Column:
    return F.shiftrightunsigned("__h", shift).bitwiseAND(F.lit(BITS))


def mixing_plan(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row a source: whole copies, the words still needed and the bucket of each round at which they end; rows have __size, __key, __h and source."""
    sizes = rows.groupBy(F.col("__key").alias("key")).agg(F.max("source").alias("source"), F.sum("__size").alias("source_size"))
    plan = source_targets(sizes, weights, most)
    copies = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long")
    plan = plan.withColumn("copies", copies).withColumn("need", F.greatest(F.lit(0), F.round("target").cast("long") - F.col("copies") * F.col("source_size")))
    plan = plan.withColumn("below", F.lit(0).cast("long"))
    at_boundary = F.lit(True)
    for i, shift in enumerate(LEVELS):
        here = rows.join(plan.select(F.col("key").alias("__key"), *[f"b{j}" for j in range(i)]), "__key").where(at_boundary) if i else rows
        sums = here.groupBy(F.col("__key").alias("key"), _bucket(shift).alias("b")).agg(F.sum("__size").alias("words"))
        run = Window.partitionBy("key").orderBy("b")
        level = sums.withColumn("upto", F.sum("words").over(run)).join(plan.select("key", "need", "below"), "key")
        ends = level.where(F.col("below") + F.col("upto") > F.col("need")).groupBy("key").agg(F.min(F.struct("b", "upto", "words")).alias("x"))
        plan = plan.join(ends, "key", "left").withColumn(f"b{i}", F.coalesce(F.col("x.b"), F.lit(BITS + 1)))
        plan = plan.withColumn("below", F.when(F.col("x").isNotNull(), F.col("below") + F.col("x.upto") - F.col("x.words")).otherwise(F.col("need"))).withColumn("words", F.coalesce("x.words", F.lit(0))).drop("x")
        plan = stored(plan, "mix-plan")
        at_boundary = at_boundary & (_bucket(shift) == F.col(f"b{i}"))
    return plan


def _planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with their source's __source_size and __target and the words __taken of each. The plan, a row a source, is broadcast if Spark finds it small, else joined."""
    marked = plan.select(F.col("key").alias("__key"), *[F.col(c).alias(f"__{c}") for c in plan.columns if c != "key"])
    taken = F.when(F.col("__words") > 0, F.floor((F.col("__need") - F.col("__below")) * F.col("__size") / F.col("__words"))).otherwise(0)
    for i, shift in reversed(list(enumerate(LEVELS))):
        taken = F.when(_bucket(shift) < F.col(f"__b{i}"), F.col("__size")).when(_bucket(shift) == F.col(f"__b{i}"), taken).otherwise(0)
    return rows.join(marked, "__key").withColumn("__taken", (F.col("__copies") * F.col("__size") + taken).cast("long"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every document.

    size counts the words of the whole text (null and empty: 0); taken is how many of its words the mix
    takes, whole copies and a part counted, never over ``most`` times its size. The sum of a source's
    taken words is within a word for each row of its last bucket of the target. Equal rows get equal
    values, as do reruns. Null sources are a source of their own; an empty table gives no rows. Other
    columns are not read.
    """
    rows = stored(docs.select("doc_id", "source", "text").withColumns(_hashed()).drop("text"), "mix-rows")
    found = _planned(rows, mixing_plan(rows, weights, most))
    return found.select("doc_id", "source", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__taken").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``docs`` with each row as often as the mix takes it.

    The one part of a document counts as a copy if it is half of it or more. Rows without words (null and
    empty texts too) go. Repeated rows each come as often. An empty table stays empty. Texts are not
    moved: each row finds its copies from its own hash and its source's plan.
    """
    rows = stored(docs.select("doc_id", "source", "text").withColumns(_hashed()).drop("text"), "mix-rows")
    found = _planned(docs.withColumns(_hashed()), mixing_plan(rows, weights, most)).where("__size > 0")
    copies = F.round(F.col("__taken") / F.col("__size")).cast("int")
    return found.withColumn("__n", copies).where("__n > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(docs.columns)
