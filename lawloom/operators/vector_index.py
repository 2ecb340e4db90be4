"""The nearest vectors by cosine, from folders by nearest centre.

Vectors of length one lie in the folder of their nearest centre; a folder knows
its radius. By the triangle inequality no vector of a folder is nearer to a query
than the query's distance to the centre less the radius, so folders are opened
from the nearest bound on, and none is opened whose bound is beyond the k-th
distance found. The result is that of a scan.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from lawloom.operators.search import cosine_top
from lawloom.sources.shared import path_exists
from lawloom.sources.snapshots import get_text, put_text

#: Rows that centres are fitted on at most; every row is assigned, whatever this is.
SAMPLE, ROUNDS = 20_000, 10
ROUNDING = 1e-6


def fit_centres(x: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """``k`` centres of length one of the rows of ``x`` (of length one), by rounds of spherical k-means from random rows."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-300), centres)
    return centres


def write_vectors(vectors: DataFrame, key: str, column: str, path: str, centres: int | None = None) -> None:
    """The rows of ``vectors`` at ``path`` in folders by nearest centre, with centres and radii.

    Centres (the root of the number of rows, at most 4,096) are fitted on ``SAMPLE`` rows at most, drawn by a hash of
    the key. Null, empty, zero and non-finite vectors have no direction: they are left out, as a scan leaves them
    out. ValueError where vectors have different sizes.
    """
    spark = vectors.sparkSession
    x = F.col(column).cast("array<double>")
    size = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v))
    good = vectors.withColumn("_n", size).where((F.col("_n") > 0) & (F.col("_n") < float("inf")))
    shape = good.agg(F.count("*").alias("n"), F.min(F.size(column)).alias("low"), F.max(F.size(column)).alias("high")).first()
    if shape.low != shape.high:
        raise ValueError("vectors of different sizes")
    k = centres or min(4096, max(1, math.isqrt(shape.n)))
    share = min(1.0, SAMPLE / max(1, shape.n))
    drawn = good.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30))).select(column).limit(2 * SAMPLE).collect()
    sample = np.array([r[0] for r in drawn], np.float64).reshape(len(drawn), shape.low or 1)
    found = fit_centres(sample / np.linalg.norm(sample, axis=1, keepdims=True), k) if len(sample) else np.zeros((1, shape.low or 1))

    names = [*vectors.columns, "centre", "far"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = np.array(b.column("_x").to_pylist(), np.float64).reshape(b.num_rows, found.shape[1])
            y /= np.linalg.norm(y, axis=1, keepdims=True)
            near = (y @ found.T).argmax(axis=1) if b.num_rows else np.empty(0, np.int64)
            far = np.linalg.norm(y - found[near], axis=1)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(b.num_columns - 1)] + [pa.array(near, pa.int32()), pa.array(far, pa.float64())], names=names)

    kinds = StructType([*vectors.schema.fields]).add("centre", IntegerType()).add("far", DoubleType())
    placed = good.drop("_n").withColumn("_x", x).mapInArrow(assign, kinds)
    placed.repartition("centre", F.pmod(F.xxhash64(key), F.lit(8))).write.mode("overwrite").partitionBy("centre").parquet(f"{path}/vectors")
    radii = {r.centre: (r.far, r.n) for r in spark.read.parquet(f"{path}/vectors").groupBy("centre").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()} if shape.n else {}  # a row a centre
    folders = [{"centre": c, "at": found[c].tolist(), "radius": far, "rows": n} for c, (far, n) in sorted(radii.items())]
    put_text(spark, f"{path}/centres.json", json.dumps({"folders": folders, "schema": json.loads(kinds.json())}))


def nearest(spark: SparkSession, path: str, key: str, column: str, query: list[float], limit: int) -> tuple[DataFrame, int]:
    """(rows, folders): the ``limit`` rows (key, cosine) of greatest cosine with ``query``, ties by key, as ``cosine_top`` has them, and how many folders were opened."""
    shape = json.loads(get_text(spark, f"{path}/centres.json") or '{"folders": []}')
    norm = math.sqrt(sum(v * v for v in query))
    if not shape["folders"] or not norm:
        return spark.createDataFrame([], f"{key} long, cosine double"), 0
    q = np.array(query, np.float64) / norm
    bounds = sorted((max(0.0, float(np.linalg.norm(q - np.array(f["at"]))) - f["radius"]), f["centre"], f["rows"]) for f in shape["folders"])
    schema = StructType.fromJson({**shape["schema"], "fields": [f for f in shape["schema"]["fields"] if f["name"] != "centre"]})
    read, held, rows = 0, 0, None
    while read < len(bounds):
        # the nearest folders that hold enough rows, then all whose bound the k-th distance does not exclude
        while read < len(bounds) and held < limit:
            held, read = held + bounds[read][2], read + 1
        rows = spark.read.schema(schema).parquet(*[p for b in bounds[:read] if path_exists(spark, p := f"{path}/vectors/centre={b[1]}")])
        top = cosine_top(rows, key, column, query, limit).collect()
        reach = math.sqrt(max(0.0, 2 - 2 * top[-1].cosine)) + ROUNDING if len(top) == limit else math.inf
        more = sum(b[0] <= reach for b in bounds)
        if more <= read:
            break
        read, held = more, limit
    return cosine_top(rows, key, column, query, limit), read
