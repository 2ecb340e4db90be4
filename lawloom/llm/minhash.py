"""Near-duplicate documents by one-permutation MinHash.

One hash of each word shingle gives all bins of a signature; empty bins borrow
from a bin drawn by a fixed random order of their own (optimal densification).
Documents with equal shingle sets are one representative with members. Bands of
bins make buckets, and a bucket gives candidate edges from chosen hubs to its
members only. An edge counts when the full shingle sets confirm it. Buckets that
still hold members of different components after that are compared block by
block inside tasks, on the full sets and between components only; so links are
not lost to the choice of a hub, and no pairs are written out for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.scratch import connected_components, least_of_components, released, shuffle_width, stored
from lawloom.llm.suffix import UNBASE, mixed, powers, prefix_sums

BINS, ROWS, BANDS = 256, 6, 42
HUB_ORDERS, BLOCK = 8, 256
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.random.default_rng(5102).integers(0, 1 << 64, 256, np.uint64)
LOWER[ord("A") : ord("Z") + 1] = LOWER[ord("a") : ord("z") + 1]
ORDERS = np.argsort(np.random.default_rng(77).random((BINS, BINS)), axis=1)
BAND_MIX = np.random.default_rng(911).integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)
STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles.

    Words are runs of other bytes than space and 09 to 0D, A-Z lower-cased; a text with fewer than
    ``words`` words has the whole sequence as its only shingle, one without words has none.
    """
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts], edge[ends] = True, True
    begin = np.flatnonzero(solid & (edge[:-1] | np.concatenate([[True], ~solid[:-1]])))
    end = np.flatnonzero(solid & (edge[1:] | np.concatenate([~solid[1:], [True]]))) + 1
    sums = prefix_sums(data, LOWER)
    word = mixed((sums[end] - sums[begin]) * powers(UNBASE, len(data) + 1)[begin] + (end - begin).astype(np.uint64))
    n = len(word) - words + 1
    if n > 0:
        grams = word[:n].copy()
        for i in range(1, words):
            grams = grams * STEP + word[i : i + n]
        grams = mixed(grams)
    lo, hi = np.searchsorted(begin, starts), np.searchsorted(begin, ends)
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        if b - a >= words:
            x = np.sort(grams[a : b - words + 1])
            yield x[np.append(True, x[1:] != x[:-1])]
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in word[a:b]:
                    whole = whole * STEP + w
            yield mixed(np.array([whole]))
        else:
            yield np.empty(0, np.uint64)


def signature(found: np.ndarray) -> np.ndarray:
    """Least hash of each bin; empty bins take the value of the first filled one in their own order."""
    bins = (found >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    sig = np.zeros(BINS, np.uint64)
    full = np.zeros(BINS, bool)
    sig[bins[first]], full[bins[first]] = found[first], True
    empty = np.flatnonzero(~full)
    if len(empty):
        order = ORDERS[empty]
        sig[empty] = sig[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = mixed(sig)[: BANDS * ROWS].reshape(BANDS, ROWS)
    return mixed((rows * BAND_MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def _texts(b: pa.RecordBatch, batch_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    texts = b.column("text").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + batch_bytes, "right")) - 1)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i:j] - offsets[i], offsets[i + 1 : j + 1] - offsets[i]
        i = j


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, starts, ends in _texts(b):
                n, digest, keys = [], [], []
                for x in shingle_sets(data, starts, ends, words):
                    n.append(len(x))
                    digest.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                    keys.append(band_keys(signature(x)).view(np.int64) if len(x) else None)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[i:j].cast(pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "digest", "bands"]
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, starts, ends in _texts(b):
                sets = [x.view(np.int64) for x in shingle_sets(data, starts, ends, words)]
                digest = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[i:j].cast(pa.int64()), pa.array(digest, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "digest", "hashes"])

    return run


def _compare(percent: int):
    """Rows of a block, sorted by block: exact comparison of the sets of different labels; found links as a forest (a, b)."""

    def solve(rows: list[tuple]) -> list[tuple[int, int]]:
        labels = np.array([r[1] for r in rows])
        if len(rows) < 2 or (labels == labels[0]).all():
            return []
        size = np.array([len(r[2]) for r in rows], np.int64)
        value, column = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), size)
        often = np.bincount(column, minlength=len(value)) > 1
        keep = often[column]
        column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
        by = np.argsort(column, kind="stable")
        column, owner, step = column[by], owner[by], 8192
        common = np.zeros((len(rows), len(rows)), np.float32)
        for lo in range(0, int(often.sum()), step):
            i, j = np.searchsorted(column, [lo, lo + step])
            part = np.zeros((len(rows), step), np.float32)
            part[owner[i:j], column[i:j] - lo] = 1
            common += part @ part.T
        common = common.astype(np.int64)
        linked = (100 * common >= percent * (size[:, None] + size[None, :] - common)) & (labels[:, None] != labels[None, :])
        x, y = np.nonzero(linked)
        least, before = np.arange(len(rows)), None
        while before is None or (least != before).any():
            before = least.copy()
            np.minimum.at(least, x, before[y])
        return [(rows[i][0], rows[k][0]) for i, k in enumerate(least.tolist()) if i != k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for b in batches:
            out = []
            sets = b.column("hashes")
            flat, at = (sets.flatten().to_numpy(), sets.offsets.to_numpy() - sets.offsets[0].as_py()) if len(sets) else (None, None)
            keys = zip(*[b.column(c).to_pylist() for c in ("band", "kind", "p", "q")], strict=True)
            for i, (key, who, label) in enumerate(zip(keys, b.column("id").to_pylist(), b.column("label").to_pylist(), strict=True)):
                if key != last:
                    out += solve(held)
                    held, last = [], key
                held.append((who, label, flat[at[i] : at[i + 1]].copy()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
        out = solve(held)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _open_blocks(members: DataFrame, hub: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, kind, p, q, id, label) of buckets that still hold members of different components, hubs left out.

    The largest component of a bucket and the rest are dealt over blocks; blocks of the rest meet
    those of the largest (kind 0) and each other (kind 1), and members of one component need not meet.
    """
    rest = members.join(hub.select("band", F.col("hub").alias("id")), ["band", "id"], "left_anti")
    rest = rest.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    counted = rest.groupBy("band", "label").agg(F.count("*").alias("c"))
    shape = counted.groupBy("band").agg(F.max(F.struct("c", F.negative("label").alias("x"))).alias("top"), F.sum("c").alias("m"), F.count("*").alias("kinds")).where("kinds > 1")
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    shape = shape.select("band", F.negative("top.x").alias("major"), blocks(F.col("top.c")).alias("nc"), blocks(F.col("m") - F.col("top.c")).alias("ns"))
    placed = stored(rest.join(shape, "band"), "open").withColumn("r", F.xxhash64("id", F.lit(3)))
    core, minor = placed.where("label = major"), placed.where("label <> major").withColumn("mine", F.pmod("r", "ns").cast("int"))
    pick = ["band", "kind", "p", "q", "id", "label"]
    zero, one = F.lit(0).alias("kind"), F.lit(1).alias("kind")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = core.select("band", zero, F.pmod("r", "nc").cast("int").alias("p"), span("ns").alias("q"), "id", "label")
    b = minor.select("band", zero, span("nc").alias("p"), F.col("mine").alias("q"), "id", "label")
    c = minor.select("band", one, "mine", span("ns").alias("o"), "id", "label").withColumns({"p": F.least("mine", "o"), "q": F.greatest("mine", "o")})
    return a.select(pick).unionByName(b.select(pick)).unionByName(c.select(pick))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents are linked when 100 * intersection >= percent * union of their sets of ``words``-word
    shingles. component_id is the least doc_id reachable by links; kept is doc_id = component_id.
    Null, empty and wordless texts have 0 shingles and are linked with nothing. Documents without a
    doc_id are linked with nothing either (component_id null, kept true). Rows that repeat a doc_id are
    documents of their own: each comes back with the least doc_id of those it reaches. Other columns are not read. A pair at exactly 0.8 is missed with a chance of 3 in a
    million (42 bands of 6 bins).
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(texts.mapInArrow(released(_sketch(words)), "doc_id long, n_shingles long, digest binary, bands array<long>"), "sketch")
    classes = rows.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("least"))
    # a number for each different set: ids may repeat, digests do not
    reps = rows.join(classes, "digest").where("doc_id = least").dropDuplicates(["digest"]).select(F.monotonically_increasing_id().alias("rep"), "digest", "least", "n_shingles", "bands")
    reps = stored(reps, "reps")
    exploded = reps.select(F.col("rep").alias("id"), F.posexplode("bands").alias("tab", "band")).distinct()
    shared = exploded.groupBy("band").agg(F.count("*").alias("m")).where("m > 1").select("band")
    members = stored(exploded.join(shared, "band").select("band", "tab", "id"), "members")
    which = reps.join(members.select(F.col("id").alias("rep")).distinct(), "rep", "left_semi").select("rep", "least", "digest")
    cut = texts.join(which, texts.doc_id == which.least, "left_semi").mapInArrow(released(_sets(words)), "id long, digest binary, hashes array<long>")
    sets = stored(cut.drop("id").join(which.select("digest", F.col("rep").alias("id")), "digest").select("id", "hashes").dropDuplicates(["id"]), "sets")

    # a star in each bucket: its hub is the least by one of eight orders, so members of a large group meet several hubs
    order = F.struct(F.xxhash64("id", F.col("tab") % HUB_ORDERS).alias("o"), F.col("id").alias("hub"))
    hub = stored(members.groupBy("band").agg(F.min(order).alias("x")).select("band", "x.hub"), "hubs")
    pairs = members.join(hub, "band").where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    sizes = reps.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"))
    fits = pairs.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
    fits = fits.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b")
    one = fits.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b")
    both = one.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), "a")
    common = F.size(F.array_intersect("x", "y"))
    links = stored(both.where(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b"), "links")

    blocks = _open_blocks(members.select("band", "id"), hub, connected_components(links))
    loaded = blocks.join(sets, "id").repartition(shuffle_width(docs.sparkSession), "band", "kind", "p", "q").sortWithinPartitions("band", "kind", "p", "q")
    more = stored(loaded.mapInArrow(released(_compare(percent)), "a long, b long"), "links")
    labels = least_of_components(connected_components(links.unionByName(more)), reps.select(F.col("rep").alias("node"), "least"))
    named = reps.select("rep", "digest", "least").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "least").alias("component"))
    out = rows.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
