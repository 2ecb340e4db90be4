"""Near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on random directions, the projections are
quantised with a random shift, and several of them together name a bucket in
each of many tables. Members of a bucket are compared by exact cosine in double
precision; a pair counts in the first table that brings it together, so no pair
is written out or counted twice. Equal vectors are one representative with a
count. Large buckets are dealt over pairs of blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.scratch import connected_components, least_of_components, shuffle_width, stored

BUCKET_WIDTH = 2.0
BLOCK_ROWS = 1024


def collision(distance: float, width: float) -> float:
    """The chance that one quantised projection of two points at this distance agrees."""
    c = width / distance
    return 1 - math.erfc(c / math.sqrt(2)) - math.sqrt(2 / math.pi) / c * (1 - math.exp(-c * c / 2))


def table_shape(n: int, cosine: float, miss: float = 1e-3) -> tuple[int, int]:
    """(projections a table, tables): about one strange pair in 20 vectors a table, at most ``miss`` of the pairs at the threshold lost."""
    near, far = collision(math.sqrt(2 - 2 * cosine), BUCKET_WIDTH), collision(math.sqrt(2), BUCKET_WIDTH)
    k = max(6, math.ceil(math.log(20 * max(n, 2)) / -math.log(far)))
    return k, max(1, math.ceil(math.log(miss) / math.log1p(-(near**k))))


def _hash_rows(k: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}
        for b in batches:
            ids, vectors = b.column("rep").to_pylist(), b.column("vec").to_pylist()
            for at in range(0, len(ids), 500):
                part = [np.asarray(v, np.float64) for v in vectors[at : at + 500]]
                keys = np.empty((len(part), tables), np.int64)
                for dim in {len(v) for v in part}:
                    if dim not in known:
                        rng = np.random.default_rng([seed, dim])
                        known[dim] = rng.standard_normal((dim, tables * k)), rng.uniform(0, BUCKET_WIDTH, tables * k), rng.integers(0, 1 << 64, (tables, k), np.uint64) | np.uint64(1), np.uint64(dim)
                    direction, shift, mix, salt = known[dim]
                    rows = [i for i, v in enumerate(part) if len(v) == dim]
                    x = np.stack([part[i] for i in rows])
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    cell = np.floor((x @ direction + shift) / BUCKET_WIDTH).astype(np.int64).view(np.uint64).reshape(len(rows), tables, k)
                    mixed = (cell * mix).sum(axis=2, dtype=np.uint64) + salt
                    keys[rows] = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + 500], pa.int64()), pa.array(list(keys >> 32), pa.list_(pa.int64())).cast(pa.list_(pa.int32()))], names=["rep", "keys"])

    return run


def _class_rows(single: bool):
    """A digest of each vector that can be compared, null for null, zero and non-finite ones; vectors of single precision stay so, others are scaled."""
    kind = pa.float32() if single else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, vectors = [], []
            for v in b.column("vec"):
                x = None if not v.is_valid else v.as_py()
                good = x is not None and len(x) > 0 and None not in x
                y = np.asarray(x, np.float64) + 0.0 if good else None
                if good and np.isfinite(y).all() and y.any():
                    scaled = y / np.abs(y).max()  # neither the squares of tiny components nor those of huge ones leave the range
                    digests.append(hashlib.blake2b(scaled.tobytes(), digest_size=16).digest())
                    vectors.append(y.astype(np.float32) if single else scaled)
                else:
                    digests.append(None)
                    vectors.append(None)
            yield pa.RecordBatch.from_arrays([b.column("vec_id").cast(pa.int64()), pa.array(digests, pa.binary()), pa.array(vectors, pa.list_(kind))], names=["vec_id", "digest", "vec"])

    return run


def _compare(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def group(reps: list, counts: list, vecs: list, keys: list, table: int, side: list, cross: bool) -> None:
            dims = {len(v) for v in vecs}
            for dim in dims:
                rows = [i for i, v in enumerate(vecs) if len(v) == dim]
                if len(rows) < 2:
                    continue
                x = np.stack([vecs[i] for i in rows]).astype(np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                linked = x @ x.T >= cosine
                np.fill_diagonal(linked, False)
                who = np.array(side)[rows]
                if cross:
                    linked &= who[:, None] != who[None, :]
                if not linked.any():
                    continue
                a, b = np.nonzero(linked)
                k = np.stack([keys[i] for i in rows])
                fresh = ~(k[a] == k[b]).any(axis=1) if table else np.ones(len(a), bool)
                a, b = a[fresh], b[fresh]
                if not len(a):
                    continue
                n = np.bincount(b, np.array(counts)[rows][a], len(rows)).astype(np.int64)
                label, before = np.arange(len(rows)), None
                while before is None or (label != before).any():
                    before = label.copy()
                    np.minimum.at(label, a, before[b])
                    label = label[label]
                for i in np.flatnonzero(n):
                    out.append((reps[rows[i]], reps[rows[label[i]]], int(n[i])))

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "n"])

        held: list[tuple] = []
        last = None
        for b in batches:
            vecs, keys = b.column("vec"), b.column("keys")
            flat, step = (vecs.flatten().to_numpy(), vecs.offsets.to_numpy() - vecs.offsets[0].as_py()) if len(vecs) else (None, None)
            kflat, kstep = (keys.flatten().to_numpy(), keys.offsets.to_numpy() - keys.offsets[0].as_py()) if len(vecs) else (None, None)
            cols = [b.column(c).to_pylist() for c in ("bucket", "tab", "p", "q", "side", "rep", "copies")]
            for i, (bucket, tab, p, q, side, rep, n) in enumerate(zip(*cols, strict=True)):
                now = (bucket, tab, p, q)
                if now != last and held:
                    if len(held) > 1:
                        group([h[0] for h in held], [h[1] for h in held], [h[2] for h in held], [h[3] for h in held], last[1], [h[4] for h in held], last[2] != last[3])
                    held = []
                last = now
                held.append((rep, n, flat[step[i] : step[i + 1]], kflat[kstep[i] : kstep[i + 1]], side))
            yield batch()
        if len(held) > 1:
            group([h[0] for h in held], [h[1] for h in held], [h[2] for h in held], [h[3] for h in held], last[1], [h[4] for h in held], last[2] != last[3])
        yield batch()

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, miss: float = 1e-3, seed: int = 4) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    n_links counts the other vectors at a cosine of at least ``cosine``, copies included; component_id
    is the least vec_id reachable by links; kept is vec_id = component_id. Vectors that are null, empty,
    zero or hold null or non-finite components, and rows without a vec_id, are linked with nothing.
    Vectors of different sizes are not linked. Rows that repeat a vec_id are vectors of their own: each comes
    back with the other rows linked to it, and with the least vec_id of those it reaches.
    """
    spark, width = vectors.sparkSession, shuffle_width(vectors.sparkSession)
    kind = "float" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "double"
    rows = stored(vectors.select("vec_id", F.col("embedding").alias("vec")).mapInArrow(_class_rows(kind == "float"), f"vec_id long, digest binary, vec array<{kind}>"), "vectors")
    useful = rows.where("digest is not null and vec_id is not null")
    classes = useful.groupBy("digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    # a number for each different vector: ids may repeat, digests do not
    reps = useful.join(classes, "digest").where("vec_id = least").dropDuplicates(["digest"]).select(F.monotonically_increasing_id().alias("rep"), "digest", "least", "copies", "vec")
    reps = stored(reps, "vector-reps")
    k, tables = table_shape(reps.count(), cosine, miss)
    hashed = stored(reps.select("rep", "vec").mapInArrow(_hash_rows(k, tables, seed), "rep long, keys array<int>"), "vector-keys")
    cells = hashed.select("rep", F.posexplode("keys").alias("tab", "bucket"))
    full = cells.groupBy("tab", "bucket").agg(F.count("*").alias("m")).where("m > 1")
    placed = cells.join(full, ["tab", "bucket"]).withColumn("parts", F.ceil(F.col("m") / BLOCK_ROWS).cast("int"))
    placed = placed.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.select("rep", "tab", "bucket", "side", F.least("side", "o").alias("p"), F.greatest("side", "o").alias("q"))
    # of the keys only those of earlier tables go along: they tell whether a pair has met before
    loaded = placed.join(reps.select("rep", "copies", "vec"), "rep").join(hashed, "rep").withColumn("keys", F.slice("keys", F.lit(1), F.col("tab")))
    loaded = loaded.repartition(width, "tab", "bucket", "p", "q").sortWithinPartitions("tab", "bucket", "p", "q")
    found = stored(loaded.select("bucket", "tab", "p", "q", "side", "rep", "copies", "vec", "keys").mapInArrow(_compare(cosine), "a long, b long, n long"), "vector-links")
    links = found.groupBy("a").agg(F.sum("n").alias("n"))
    labels = least_of_components(connected_components(found.select("a", "b")), reps.select(F.col("rep").alias("node"), "least"))
    named = reps.select("rep", "digest", "least", "copies").join(labels.withColumnRenamed("node", "rep"), "rep", "left").join(links.withColumnRenamed("a", "rep"), "rep", "left")
    named = named.select("digest", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("links"), F.coalesce("component", "least").alias("component"))
    out = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest")).join(named, "digest", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
