"""Interaction of text filters by permutation-trie execution.

All orders of the filters form a trie. It is walked depth first: a filter is
applied to the survivors of the filters before it, which are a persisted
DataFrame of flags, and every edge counts the rows that it really removes. What
survives does not depend on the order of the filters before, so a node of the
trie is its unordered set of filters, kept in a memo: n filters have 2^n states
and n * 2^(n-1) edges, not n! paths. The orders are put together from the edges.
"""

from __future__ import annotations

import itertools

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.scratch import new_path, stored

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = "[#$%&*|]"
COPY = "E"
SALTS = 16


def text_failures(text: Column) -> dict[str, Column]:
    """Whether a text fails filters A to D: under 200 words, under half of them different, over 3 % capital letters, any of ``#$%&*|``."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike(SIGNS),
    }


def filter_flags(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, good, toxic, A, B, C, D, E) of every document, stored: the table that all filters run on, without texts.

    E: the text is that of a smaller doc_id. Only digests of texts are shuffled. Groups of copies are summed
    before the shuffle, and the join that brings a group's least doc_id back to its members is salted, as one
    group may hold a large part of all rows.
    """
    filled = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), filled.alias("text"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(n) for n, c in text_failures(F.col("text")).items()])
    rows = stored(rows, "audit-rows")
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    dealt = copies.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(dealt, ["digest", "salt"], "left")
    known = labels.groupBy("doc_id").agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = rows.join(known, "doc_id", "left")
    flag = lambda c: F.coalesce(c, F.lit(False))
    return stored(rows.select("part", flag(F.col("good")).alias("good"), flag(F.col("toxic")).alias("toxic"), *"ABCD", flag(F.col("first") < F.col("doc_id")).alias(COPY)), "audit-flags")


def state_counts(flags: DataFrame, filters: str) -> DataFrame:
    """(part, state, n, x): rows that survive the filters of ``state`` (``-`` and their letters), and for each filter those that it would remove next.

    The states are visited depth first. A state's survivors are persisted while its children filter them and given
    back when the walk leaves it, so one state of each depth is held. A child that another path has reached is in
    the memo and not executed again. Each state's counts are written, a row a part; parts without survivors have none.
    """
    path = new_path(flags.sparkSession, "audit-states")
    # the same columns for all states, so that they share one compiled plan; filters applied before count 0
    lost = [F.struct(F.lit(f).alias("filter"), F.count_if(f).alias("removed"), F.count_if(F.col(f) & F.col("good")).alias("good_lost"), F.count_if(F.col(f) & F.col("toxic")).alias("toxic_lost")) for f in filters]
    sums = [F.count("*").alias("n"), F.array(*lost).alias("x")]
    memo: set[str] = set()

    def visit(state: str, survivors: DataFrame) -> None:
        memo.add(state)
        children = [f for f in filters if f not in state and len(state) + 1 < len(filters)]
        if any("".join(sorted(state + f)) not in memo for f in children):
            survivors = survivors.persist(StorageLevel.MEMORY_AND_DISK)
        survivors.groupBy("part").agg(*sums).write.parquet(f"{path}/state=-{state}")
        for f in children:
            child = "".join(sorted(state + f))
            if child not in memo:
                visit(child, survivors.where(~F.col(f)))
        survivors.unpersist()

    visit("", flags)
    return flags.sparkSession.read.schema("part string, n long, x array<struct<filter:string,removed:long,good_lost:long,toxic_lost:long>>, state string").parquet(path)


def audit_filters(docs: DataFrame, labels: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    A row for each value of lang (null and empty: the empty string), order of the filters and step. removed: rows that
    the step's filter takes from the survivors of those before; redundant: rows failing it that were gone
    already; unique_fails: rows failing no other filter; good_lost and toxic_lost: removed rows that ``labels``
    calls so; shapley: the filter's removed rows, summed over all orders. Null texts are empty; repeated rows
    each count; several labels of a doc_id count as one, which holds what any of them says; a null doc_id has
    no label and no smaller doc_id. An empty table gives no rows. Other columns are not read.
    """
    filters = "".join(sorted(filters))
    flags = filter_flags(docs, labels)
    alone = lambda f: F.count_if(F.col(f) & ~F.greatest(F.lit(False), *[F.col(g) for g in filters if g != f], F.lit(False)))
    whole = flags.groupBy("part").agg(F.array(*[F.struct(F.lit(f).alias("filter"), F.count_if(f).alias("failing"), alone(f).alias("unique_fails")) for f in filters]).alias("x")).select("part", F.inline("x"))
    steps = [("".join(o), i + 1, "-" + "".join(sorted(o[:i])), f) for o in itertools.permutations(filters) for i, f in enumerate(o)]
    orders = flags.sparkSession.createDataFrame(steps, "filter_order string, step int, state string, filter string")
    edges = state_counts(flags, filters).select("part", "state", "n", F.inline("x"))
    out = whole.join(F.broadcast(orders), "filter").join(edges, ["part", "state", "filter"], "left").na.fill(0, ["n", "removed", "good_lost", "toxic_lost"])
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))  # a row an order
    return out.select("part", "filter_order", "step", "filter", (F.col("n") - F.col("removed")).alias("kept"), "removed", (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"))
