"""Hard negatives by a vector-approximation file.

Vectors of small integers are dealt into blocks, and each block is stored with
its approximation: every dimension is cut into cells between quantiles of the
block, two cells in a byte. For an anchor, a table a dimension pair holds the
least and the greatest share of the score that a pair of cells can give, so sums
of looked-up shares bound every score of the block. Only vectors whose bounds
may enter the first five of a label, or a window below a positive's score, are
scored exactly. Each block gives its own first few; these are merged by anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.scratch import released, shuffle_width, stored

CELLS = 16
BLOCK_ROWS, LEAST_BLOCK, MOST_BLOCKS = 1 << 16, 2048, 64
LIMIT = 1 << 24
CHUNK_CELLS = 1 << 22
BLOCK_COLUMNS = "block int, dim int, ids binary, labels binary, vectors binary, cells binary, edges binary"
FOUND = "akey long, window int, score long, vec_id long"


def integer_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, q) of the rows that take part: a vec_id, a label, and a vector whose components are all finite.

    Where vec_id is divisible by 7, label becomes (label + 1) modulo 10. A component x becomes floor(256 x); beyond
    2^24 it stays there, so that scores of up to 2^14 dimensions fit a long.
    """
    x = F.col("embedding").cast("array<double>")
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~F.exists(x, odd))
    whole = F.transform(x, lambda v: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(256 * v))).cast("int"))
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"), whole.alias("q"))


def cells_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cells, edges): the cell of each component, two to a byte, and for each dimension the least and greatest component of each cell."""
    n, dim = x.shape
    cuts = np.quantile(x, np.arange(1, CELLS) / CELLS, axis=0, method="lower") if n else np.zeros((CELLS - 1, dim))
    cells = np.zeros((n, dim + dim % 2), np.uint8)
    edges = np.zeros((2, dim + dim % 2, CELLS), np.int64)
    for d in range(dim):
        c = np.searchsorted(cuts[:, d], x[:, d], "left")
        cells[:, d] = c
        low, high = np.full(CELLS, np.iinfo(np.int64).max), np.full(CELLS, np.iinfo(np.int64).min)
        np.minimum.at(low, c, x[:, d])
        np.maximum.at(high, c, x[:, d])
        edges[0, d], edges[1, d] = np.where(low > high, 0, low), np.where(low > high, 0, high)
    return cells[:, 0::2] * CELLS + cells[:, 1::2], edges


def approximation_file(rows: DataFrame, blocks: int) -> DataFrame:
    """The vectors in ``blocks`` blocks by a hash of vec_id, a row for each block and vector size, with cells and edges; stored."""

    def pack(block: int, held: list[tuple]) -> Iterator[tuple]:
        for dim in sorted({len(h[2]) for h in held}):
            part = [h for h in held if len(h[2]) == dim]
            x = np.stack([h[2] for h in part]).astype(np.int64)
            cells, edges = cells_of(x)
            yield block, dim, np.array([h[0] for h in part], np.int64).tobytes(), np.array([h[1] for h in part], np.int32).tobytes(), x.astype(np.int32).tobytes(), cells.tobytes(), edges.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for b in batches:
            flat, at = b.column("q").flatten().to_numpy(), b.column("q").offsets.to_numpy() - (b.column("q").offsets[0].as_py() if b.num_rows else 0)
            for i, (block, vec_id, label) in enumerate(zip(*(b.column(c).to_pylist() for c in ("block", "vec_id", "label")), strict=True)):
                if block != last and held:
                    yield _batch(pack(last, held), BLOCK_COLUMNS)
                    held = []
                last = block
                held.append((vec_id, label, flat[at[i] : at[i + 1]].copy()))
        if held:
            yield _batch(pack(last, held), BLOCK_COLUMNS)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(13)), F.lit(blocks)).cast("int"))
    dealt = dealt.repartition(max(blocks, 1), "block").sortWithinPartitions("block").select("block", "vec_id", "label", "q")
    return stored(dealt.mapInArrow(released(run), BLOCK_COLUMNS), "va-file")


def _batch(rows: Iterator[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


class Block:
    """One block's vectors and the bounds of their scores."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, vectors: bytes, cells: bytes, edges: bytes):
        self.dim, self.ids, self.labels = dim, np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int32)
        self.x = np.frombuffer(vectors, np.int32).reshape(len(self.ids), dim)
        pairs = (dim + 1) // 2
        self.cells = np.ascontiguousarray(np.frombuffer(cells, np.uint8).reshape(len(self.ids), pairs).T)
        self.edges = np.frombuffer(edges, np.int64).reshape(2, 2 * pairs, CELLS)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the scores of each anchor with each vector, by looking up pairs of cells."""
        q = np.pad(q.astype(np.int64), ((0, 0), (0, 2 * len(self.cells) - self.dim)))
        one, two = q[:, :, None] * self.edges[0], q[:, :, None] * self.edges[1]
        out = []
        for share in (np.minimum(one, two), np.maximum(one, two)):
            table = (share[:, 0::2, :, None] + share[:, 1::2, None, :]).reshape(len(q), len(self.cells), CELLS * CELLS)
            small = np.abs(table).max(initial=0) * max(1, len(self.cells)) < 1 << 31
            table = table.astype(np.int32 if small else np.int64)
            total = np.zeros((len(q), len(self.ids)), table.dtype)
            for pair, cell in enumerate(self.cells):
                total += np.take(table[:, pair], cell, axis=1)
            out.append(total)
        return out[0], out[1]

    def exact(self, q: np.ndarray, a: np.ndarray, i: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", q[a].astype(np.int64), self.x[i].astype(np.int64))


def kth(values: np.ndarray, mask: np.ndarray, k: int) -> np.ndarray:
    """For each row the k-th greatest value under the mask, the least long where there are fewer."""
    least = np.iinfo(np.int64).min
    if values.shape[1] < k:
        return np.full(len(values), least)
    shown = np.where(mask, values, least)
    return np.partition(shown, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def best(score: np.ndarray, ids: np.ndarray, anchor: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each anchor, by score from above, then by id."""
    order = np.lexsort((ids, -score, anchor))
    start = np.searchsorted(anchor[order], anchor[order])
    return order[np.arange(len(order)) - start < k]


def _scan(k: int, windows: bool, low: int, high: int):
    """For each block its first ``k`` for each anchor: of the anchor's label, or of other labels within each of the anchor's windows (positive scores)."""

    def meet(block: Block, anchors: list[tuple]) -> Iterator[tuple]:
        step = max(1, CHUNK_CELLS // max(1, len(block.ids)))
        for at in range(0, len(anchors), step):
            part = anchors[at : at + step]
            q = np.stack([a[3] for a in part])
            labels, own = np.array([a[2] for a in part]), np.array([a[1] for a in part])
            lower, upper = block.bounds(q)
            same = block.labels[None, :] == labels[:, None]
            if not windows:
                may = same & (block.ids[None, :] != own[:, None])
                a, i = np.nonzero(may & (upper >= kth(lower, may, k)[:, None]))
                score = block.exact(q, a, i)
                for j in best(score, block.ids[i], a, k):
                    yield part[a[j]][0], 0, int(score[j]), int(block.ids[i[j]])
                continue
            most = max(len(a[4]) for a in part)
            for w in range(most):
                p = np.array([a[4][w] if len(a[4]) > w else -1 for a in part], np.int64)
                # a window of a negative score is empty: low percent of it lie above it
                may = ~same & (p >= 0)[:, None] & (high * lower.astype(np.int64) <= high * p[:, None]) & (high * upper.astype(np.int64) >= low * p[:, None])
                sure = may & (upper <= p[:, None]) & (high * lower.astype(np.int64) >= low * p[:, None])
                a, i = np.nonzero(may & (upper >= kth(lower, sure, k)[:, None]))
                score = block.exact(q, a, i)
                inside = (score <= p[a]) & (high * score >= low * p[a])
                a, i, score = a[inside], i[inside], score[inside]
                for j in best(score, block.ids[i], a, k):
                    yield part[a[j]][0], w, int(score[j]), int(block.ids[i[j]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Block] = {}
        last = None
        for b in batches:
            rows = {c: b.column(c).to_pylist() for c in b.schema.names}
            waiting: dict[int, list[tuple]] = {}

            def flush(waiting: dict[int, list[tuple]] = waiting) -> pa.RecordBatch:
                found = [x for dim, anchors in waiting.items() if dim in held for x in meet(held[dim], anchors)]
                waiting.clear()
                return _batch(iter(found), FOUND)

            for i in range(b.num_rows):
                if rows["block"][i] != last:
                    yield flush()
                    held, last = {}, rows["block"][i]
                if rows["akey"][i] is None:
                    held[rows["dim"][i]] = Block(rows["dim"][i], *(rows[c][i] for c in ("ids", "labels", "vectors", "cells", "edges")))
                else:
                    waiting.setdefault(rows["dim"][i], []).append((rows["akey"][i], rows["anchor_id"][i], rows["label"][i], np.frombuffer(rows["q"][i], np.int32), rows["scores"][i]))
            yield flush()

    return run


def _with_blocks(file: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Each block's rows, and after them all anchors, so that a task holds a block and streams the anchors past it."""
    copied = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = file.withColumn("side", F.lit(0)).unionByName(copied.withColumn("side", F.lit(1)), allowMissingColumns=True)
    width = min(blocks, max(shuffle_width(file.sparkSession), 1))
    return both.repartition(width, "block").sortWithinPartitions("block", "side").drop("side")


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows, labels and integer vectors are those of ``integer_rows``. Anchors: vec_id divisible by ``every``. An
    anchor's positives are the first other rows of its label by score, ties by vec_id. For each positive the
    first rows of other labels with ``low`` * positive_score <= ``high`` * score <= ``high`` * positive_score.
    Vectors of another size than the anchor's are not met. Rows that repeat a vec_id are rows of their own, but
    none of them is another row to an anchor of that id; equal anchor rows are one anchor. No positive or no negative: no
    row; an empty table gives none. Other columns are not read.

    Blocks hold 65,536 rows at most on average (a 64th of a smaller table); anchors, a fixed share of the rows, are copied to each block, and
    a block gives at most ``positives`` * ``negatives`` rows for each.
    """
    rows = stored(integer_rows(vectors), "integer-vectors")
    n = rows.count()
    blocks = max(1, -(-n // min(BLOCK_ROWS, max(LEAST_BLOCK, n // MOST_BLOCKS))))
    file = approximation_file(rows, blocks)
    key = F.xxhash64("vec_id", "label", "q")
    anchors = rows.where(F.col("vec_id") % every == 0).select(key.alias("akey"), F.col("vec_id").alias("anchor_id"), "label", "q").dropDuplicates(["akey"])
    anchors = stored(anchors.mapInArrow(_packed, "akey long, anchor_id long, label int, dim int, q binary"), "anchors")
    columns = ["block", "dim", "ids", "labels", "vectors", "cells", "edges", "akey", "anchor_id", "label", "q", "scores"]
    first = lambda df, k: df.agg(F.slice(F.array_sort(F.collect_list(F.struct(F.negative("score").alias("o"), "vec_id"))), 1, k).alias("x"))

    met = _with_blocks(file, anchors.withColumn("scores", F.array().cast("array<long>")), blocks).select(columns).mapInArrow(released(_scan(positives, False, low, high)), FOUND)
    near = stored(first(met.groupBy("akey"), positives), "positives")
    asked = anchors.join(near.select("akey", F.transform("x", lambda y: F.negative(y["o"])).alias("scores")), "akey")
    found = _with_blocks(file, asked, blocks).select(columns).mapInArrow(released(_scan(negatives, True, low, high)), FOUND)
    hard = first(found.groupBy("akey", "window"), negatives).select("akey", "window", F.posexplode("x").alias("place", "n"))
    named = anchors.select("akey", "anchor_id").join(near.select("akey", F.posexplode("x").alias("window", "p")), "akey")
    out = named.join(hard, ["akey", "window"])
    return out.select("anchor_id", F.col("p.vec_id").alias("positive_id"), (F.col("place") + 1).alias("rank"), F.col("n.vec_id").alias("negative_id"), F.negative("p.o").alias("positive_score"), F.negative("n.o").alias("negative_score"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        vectors = [np.array(v, np.int32) for v in b.column("q").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("akey"), b.column("anchor_id"), b.column("label"), pa.array([len(v) for v in vectors], pa.int32()), pa.array([v.tobytes() for v in vectors], pa.binary())], names=["akey", "anchor_id", "label", "dim", "q"])
