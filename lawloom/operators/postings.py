"""An inverted index in blocks, and the best rows of a query without reading all of them.

A term's postings lie in blocks of 128, those with the greatest share of a score
first. A block carries the greatest weighted frequency and the least length in
it, which bound the share of any of its rows. Once the k-th best score so far is
known, a block whose bound, with the greatest shares of the other terms, stays
below it cannot hold a part of any better row, and is not read.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, IntegerType, LongType, StringType, StructField, StructType

from lawloom.sources.shared import path_exists
from lawloom.sources.snapshots import get_text, put_text

# Ranking constants.
K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
BLOCK = 128
FIRST_BLOCKS, MORE = 4, 8
SMALL = 64
POSTINGS_A_BUCKET, MOST_BUCKETS = 4_000_000, 4096


@dataclass
class Segment:
    """One immutable part of an index: where it lies, its statistics, and where its dead rows and their terms are listed, if any are."""

    path: str
    stats: dict
    dead: str | None = None


@dataclass
class Ranking:
    """rows (key, score, found); of ``blocks`` with a term that is asked for, ``read`` were needed for the last pass."""

    rows: DataFrame
    blocks: int
    read: int


def bucket_of(term: Column, buckets: int) -> Column:
    return (F.crc32(term.cast("binary")) % buckets).cast("int")


def bucket_number(term: str, buckets: int) -> int:
    """``bucket_of`` of one value."""
    return zlib.crc32(term.encode("utf-8")) % buckets


def share(f: Column, dl: Column, avgdl: float) -> Column:
    """The part of a score that the frequency of a term gives; it grows with the frequency and falls with the length."""
    return f * (K1 + 1) / (f + K1 * (1 - B + B * dl / avgdl))


def in_blocks(rows: DataFrame, group: list[str], order: list[Column], size: int, members: list[str]) -> DataFrame:
    """(group, block, n, members): neighbours of one group in ``order`` as a list of structs, at most ``size`` of them; numbers of blocks grow with the order.

    Rows are shuffled once. A group of any size is dealt over tasks; a block lies in one task, as ``size`` is a power
    of two, and is gathered where it lies.
    """
    placed = rows.select(*group, *members).repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    placed = placed.withColumn("block", F.floor(F.monotonically_increasing_id() / size)).select(*group, "block", *members)
    head = len(group) + 1

    def gathered(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        columns = [c.combine_chunks() for c in t.columns]
        held = pa.StructArray.from_arrays(columns[head:], names=members)
        ends = np.append(starts, t.num_rows).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends), held)
        return pa.RecordBatch.from_arrays([*[c.take(pa.array(starts)) for c in columns[:head]], pa.array(np.diff(ends), pa.int64()), listed], names=[*group, "block", "n", "members"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last block, which may go on
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            codes = [t.column(i).combine_chunks().dictionary_encode().indices.to_numpy() for i in range(head)]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
            if len(new):
                yield gathered(t.slice(0, new[-1]), np.append(0, new[:-1]))
                t = t.slice(new[-1])
            rest = t
        if rest is not None and rest.num_rows:
            yield gathered(rest, np.array([0]))

    kinds = placed.schema
    inner = StructType([kinds[m] for m in members])
    out = StructType([*[kinds[g] for g in group], kinds["block"], StructField("n", LongType()), StructField("members", ArrayType(inner))])
    return placed.mapInArrow(run, out)


def by_term(rows: DataFrame, key: str, fields: list[str], size: int = 500) -> DataFrame:
    """(term, key, dl, places) of the different terms of each row (key, dl, an array of terms for each field), places (field, position) in order; nothing is shuffled."""
    place = StructType([StructField("field", ByteType()), StructField("at", IntegerType())])

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        lengths = [pc.fill_null(pc.list_value_length(b.column(f)), 0).to_numpy() for f in fields]
        code = pa.concat_arrays([b.column(f).flatten() for f in fields]).dictionary_encode()
        row = np.concatenate([np.repeat(np.arange(b.num_rows), n) for n in lengths])
        field = np.repeat(np.arange(len(fields)), [n.sum() for n in lengths])
        at = np.concatenate([np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) for n in lengths])
        term = code.indices.to_numpy()
        order = np.lexsort((at, field, term, row))
        row, term = row[order], term[order]
        starts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (term[1:] != term[:-1]))) if len(row) else np.array([], int)
        held = pa.StructArray.from_arrays([pa.array(field[order].astype(np.int8)), pa.array(at[order].astype(np.int32))], names=["field", "at"])
        places = pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)).astype(np.int32)), held)
        first = pa.array(row[starts])
        return pa.RecordBatch.from_arrays([code.dictionary.take(pa.array(term[starts])), b.column(key).take(first), b.column("dl").take(first), places], names=["term", key, "dl", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, size):
                yield cut(b.slice(i, size))

    return rows.mapInArrow(run, StructType([StructField("term", StringType()), rows.schema[key], rows.schema["dl"], StructField("places", ArrayType(place))]))


def weighted(places: Column, weights: list[float]) -> Column:
    return F.aggregate(places, F.lit(0.0), lambda a, x: a + F.element_at(F.array(*map(F.lit, weights)), x["field"].cast("int") + 1))


def write_postings(cut: DataFrame, key: str, fields: list[str], path: str, weights: list[float] | None = None) -> None:
    """The index of ``cut`` (key, an array of terms for each of ``fields``) at ``path``: folders by a hash of the term, files sorted by term and block.

    A block has (n, f, dl, share, posts): its number of rows, bounds, and (key, dl, places) of each; places are (field,
    position). The number of folders follows the number of postings. ``stats.json`` has the sums ranking needs.
    """
    weights = weights or [1.0] * len(fields)
    sized = cut.withColumn("dl", reduce(lambda a, b: a + b, [F.size(f) for f in fields]))
    total = sized.agg(F.count("*").alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("dl")).first()
    buckets = min(MOST_BUCKETS, max(16, -(-total.dl // POSTINGS_A_BUCKET)))
    found = by_term(sized, key, fields).withColumn("f", weighted(F.col("places"), weights))
    found = found.withColumn("share", share(F.col("f"), F.col("dl"), total.dl / max(1, total.n) or 1.0)).withColumn("bucket", bucket_of(F.col("term"), buckets))
    blocks = in_blocks(found, ["bucket", "term"], [F.negative("share"), F.col(key)], BLOCK, [key, "dl", "places", "f", "share"])
    each = lambda name: F.transform("members", lambda x: x[name])
    posts = F.array_sort(F.transform("members", lambda x: F.struct(x[key].alias(key), x["dl"].alias("dl"), x["places"].alias("places"))))
    blocks = blocks.select("term", "block", "n", F.array_max(each("f")).alias("f"), F.array_min(each("dl")).alias("dl"), F.array_max(each("share")).alias("share"), posts.alias("posts"), "bucket")
    blocks.write.mode("overwrite").partitionBy("bucket").option("compression", "zstd").parquet(f"{path}/postings")
    put_text(cut.sparkSession, f"{path}/stats.json", json.dumps({"n": total.n, "dl": total.dl, "buckets": buckets, "weights": weights, "schema": json.loads(blocks.drop("bucket").schema.json())}))


def segment_at(spark: SparkSession, path: str, dead: str | None = None) -> Segment | None:
    """The segment at ``path``, None where no postings are."""
    found = get_text(spark, f"{path}/stats.json")
    return None if found is None else Segment(path, json.loads(found), dead)


def _blocks(spark: SparkSession, s: Segment, terms: list[str]) -> DataFrame | None:
    """Blocks of the terms: only their folders are opened. None where there is none."""
    paths = [p for b in sorted({bucket_number(t, s.stats["buckets"]) for t in terms}) if path_exists(spark, p := f"{s.path}/postings/bucket={b}")]
    if not paths:
        return None
    return spark.read.schema(StructType.fromJson(s.stats["schema"])).parquet(*paths).where(F.col("term").isin(terms))


def _dead(spark: SparkSession, s: Segment, what: str) -> DataFrame | None:
    return spark.read.parquet(f"{s.dead}/{what}") if s.dead else None


def statistics(segments: list[Segment]) -> tuple[int, float]:
    """(live rows, average length)."""
    n = sum(s.stats["n"] - s.stats.get("dead_n", 0) for s in segments)
    dl = sum(s.stats["dl"] - s.stats.get("dead_dl", 0) for s in segments)
    return n, dl / n if n and dl else 1.0


def _all_blocks(spark: SparkSession, segments: list[Segment], terms: list[str]) -> DataFrame | None:
    """Blocks of the terms in all segments with the number of the segment and ``bound``, which no row's share exceeds.

    Shares were taken at the segment's own average length; at a greater one they grow by its ratio at most.
    """
    avgdl = statistics(segments)[1]
    grown = lambda s: max(1.0, avgdl / (s.stats["dl"] / max(1, s.stats["n"]) or 1.0))
    bound = lambda s: F.least(share(F.col("f"), F.col("dl"), avgdl), F.col("share") * F.lit(grown(s)))
    found = [b.withColumns({"seg": F.lit(i), "bound": bound(s)}) for i, s in enumerate(segments) if (b := _blocks(spark, s, terms)) is not None]
    return reduce(DataFrame.unionByName, found) if found else None


def _scored(spark: SparkSession, segments: list[Segment], blocks: DataFrame, key: str, phrases: list[list[str]], weights: list[float], idf: dict[int, float] | None) -> DataFrame:
    """(key, score, found) from the given blocks; scores are whole for rows all of whose postings are among them."""
    n, avgdl = statistics(segments)
    posts = blocks.select("seg", "term", F.explode("posts").alias("x")).select("seg", "term", F.col(f"x.{key}").alias(key), "x.dl", "x.places")
    for i, s in enumerate(segments):
        gone = _dead(spark, s, "keys")
        if gone is not None:
            posts = posts.join(gone.select(key).withColumn("seg", F.lit(i)), ["seg", key], "left_anti")
    asked = sorted({t for p in phrases for t in p})
    at = lambda t: F.coalesce(F.flatten(F.collect_list(F.when(F.col("term") == t, F.col("places")))), F.array().cast(posts.schema["places"].dataType))
    rows = posts.groupBy(key, "dl").agg(*[at(t).alias(f"t{i}") for i, t in enumerate(asked)])
    moved = lambda t, by: F.transform(F.col(f"t{asked.index(t)}"), lambda x: F.struct(x["field"].alias("field"), (x["at"] - by).alias("at")))
    rows = rows.withColumns({f"p{i}": reduce(F.array_intersect, [moved(t, by) for by, t in enumerate(phrase)]) for i, phrase in enumerate(phrases)})
    rows = rows.where(reduce(lambda a, b: a | b, [F.size(f"p{i}") > 0 for i in range(len(phrases))])).select(key, "dl", *[f"p{i}" for i in range(len(phrases))])
    if idf is None:  # the rows of a phrase are known only now
        counts = rows.agg(*[F.count_if(F.size(f"p{i}") > 0).alias(f"n{i}") for i in range(len(phrases))])
        rows = rows.join(F.broadcast(counts))  # a table of one row
    score = F.lit(0.0)
    for i in range(len(phrases)):
        weight = F.lit(idf[i]) if idf is not None else F.greatest(F.ln((n - F.col(f"n{i}") + 0.5) / (F.col(f"n{i}") + 0.5)), F.lit(LEAST_IDF))
        score = score - weight * share(weighted(F.col(f"p{i}"), weights), F.col("dl"), avgdl)
    named = lambda i: F.transform(f"p{i}", lambda x: F.struct(F.lit(i).alias("phrase"), x["field"].cast("int").alias("field"), x["at"].alias("at")))
    return rows.select(key, score.alias("score"), F.concat(*map(named, range(len(phrases)))).alias("found"))


def nothing(spark: SparkSession, key: str, kind: str = "string") -> DataFrame:
    return spark.createDataFrame([], f"{key} {kind}, score double, found array<struct<phrase:int,field:int,at:int>>")


def _key_type(segments: list[Segment], key: str) -> str:
    posts = StructType.fromJson(segments[0].stats["schema"])["posts"].dataType.elementType
    return posts[key].dataType.simpleString()


def every_row(spark: SparkSession, segments: list[Segment], key: str, phrases: list[list[str]], weights: list[float]) -> DataFrame:
    """(key, score, found) of all rows that hold a phrase; lower is better. found has (phrase, field, position) of each occurrence."""
    blocks = _all_blocks(spark, segments, sorted({t for p in phrases for t in p})) if phrases and segments else None
    return nothing(spark, key, _key_type(segments, key) if segments else "string") if blocks is None else _scored(spark, segments, blocks, key, phrases, weights, None)


def top_rows(spark: SparkSession, segments: list[Segment], key: str, phrases: list[list[str]], weights: list[float], k: int, chosen: DataFrame | None = None) -> Ranking:
    """The rows that can be among the first ``k`` of ``chosen`` (key; of all by default), with their whole scores: those of the k-th best score and better.

    With several terms fewer blocks can be left out, as a block of one may hold a row that is among the best of another.
    Phrases of several terms count their rows while they are read, so a query with one reads all its blocks, as
    does one with ``SMALL`` blocks or fewer. ``weights`` must be those of the index.
    """
    asked = sorted({t for p in phrases for t in p})
    blocks = _all_blocks(spark, segments, asked) if phrases and segments else None
    if blocks is None:
        return Ranking(nothing(spark, key, _key_type(segments, key) if segments else "string"), 0, 0)
    if any(s.stats["weights"] != weights for s in segments):
        raise ValueError("the index was built for other weights")
    n, bound = statistics(segments)[0], F.col("bound")
    # a row a term; of a block only its bounds are read
    known = {r.term: r for r in blocks.groupBy("term").agg(F.sum("n").alias("n"), F.max(bound).alias("most"), F.count("*").alias("blocks")).collect()}
    total = sum(r.blocks for r in known.values())
    if total <= SMALL or any(len(p) > 1 for p in phrases):
        return Ranking(_scored(spark, segments, blocks, key, phrases, weights, None), total, total)
    fewer = {}
    for s in segments:
        gone = _dead(spark, s, "terms")
        for r in gone.where(F.col("term").isin(asked)).groupBy("term").agg(F.sum("n").alias("n")).collect() if gone is not None else ():
            fewer[r.term] = fewer.get(r.term, 0) + r.n
    count = lambda t: known[t].n - fewer.get(t, 0) if t in known else 0
    idf = {i: max(math.log((n - count(p[0]) + 0.5) / (count(p[0]) + 0.5)), LEAST_IDF) for i, p in enumerate(phrases)}
    of_term = {t: sum(idf[i] for i, p in enumerate(phrases) if p[0] == t) for t in asked}
    most = {t: of_term[t] * known[t].most if t in known else 0.0 for t in asked}

    def of_blocks(part: DataFrame) -> DataFrame:
        found = _scored(spark, segments, part, key, phrases, weights, idf)
        return found if chosen is None else found.join(chosen.select(key), key, "left_semi")

    many = FIRST_BLOCKS
    while True:
        first = [blocks.where(F.col("term") == t).orderBy(F.desc(bound), "seg", "block").limit(many) for t in known]
        best = of_blocks(reduce(DataFrame.unionByName, first)).orderBy("score").select("score").limit(k).collect()
        if len(best) == k or many >= max(r.blocks for r in known.values()):
            break
        many *= MORE
    # scores of a part of the postings are no greater than the whole ones, so the k-th of them is a safe limit
    limit = -best[-1].score * (1 - 1e-12) if len(best) == k else 0.0
    others = sum(most.values())
    may = reduce(lambda a, b: a | b, [(F.col("term") == t) & (of_term[t] * bound + (others - most[t]) >= limit) for t in known])
    needed = blocks.where(may)
    read = needed.groupBy().count().first()[0]
    return Ranking(of_blocks(needed).where(F.col("score") <= -limit), total, read)
