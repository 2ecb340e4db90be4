"""Token-id files compressed by a Re-Pair grammar.

A file holds consecutive documents of one shard: the ids are rewritten round by
round, each round replacing the most frequent pairs by new symbols, and the
rules are stored with their expansion lengths, so that any document can be
decoded alone. Pairs never cross the end of a document.

Layout (little endian): magic, counts, doc ids (int64), symbols before each
document (int64, one more), ids before each document (int64, one more), rules
(two uint32 each), expansion lengths (uint32), symbols (uint16 or uint32).
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lawloom.llm.encode import encoded_rows
from lawloom.llm.scratch import new_path, shuffle_width

MAGIC = b"RPG1"
MULTIPLIERS = np.random.default_rng(303).integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)
CACHED_WORDS = 1_200_000
FILES = "shard long, file_no long, first_doc long, n_docs long, n_ids long, content binary"


def repair(ids: np.ndarray, last: np.ndarray, base: int, pairs: int = 2048, least: int = 8, rounds: int = 12, gain: float = 0.01) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, last): symbols below ``base`` are ids, the others index ``rules``.

    last marks the final id of a document. A round replaces up to ``pairs`` pairs that occur at least
    ``least`` times; where chosen pairs overlap, every other one from the left is taken. Pairs are counted
    in a hash table with one pair a slot: of two in one slot one waits for a later round, which hashes
    anew. Rounds end when one shortens the sequence by less than ``gain``.
    """
    s, last, rules = ids.astype(np.uint32), last.copy(), np.empty((0, 2), np.uint32)
    room = 65536 - base if base < 65536 - pairs else 1 << 20
    for turn in range(rounds):
        pairs_now = min(pairs, room - len(rules))
        if len(s) < 2 or pairs_now <= 0:
            break
        bits = min(20, max(12, len(s).bit_length()))
        size = 1 << bits
        key = (s[:-1].astype(np.uint64) << np.uint64(32)) | s[1:]
        slot = ((key * MULTIPLIERS[turn % len(MULTIPLIERS)]) >> np.uint64(64 - bits)).astype(np.int64)
        slot[last[:-1]] = size
        seen = np.bincount(slot, minlength=size + 1)
        seen[size] = 0
        often, floor = seen[seen >= least], least
        if len(often) > 2 * pairs_now:
            floor = max(least, int(np.partition(often, -2 * pairs_now)[-2 * pairs_now]) // 2)
        at = np.flatnonzero(seen[slot] >= floor)
        if not len(at):
            break
        slot, key = slot[at], key[at]
        owner = np.zeros(size, np.uint64)
        owner[slot] = key
        mine = owner[slot] == key
        n = np.bincount(slot[mine], minlength=size)
        good = np.flatnonzero(n >= least)
        if len(good) > pairs_now:
            good = good[np.argsort(-n[good], kind="stable")[:pairs_now]]
        if not len(good):
            break
        chosen = owner[good]
        rule_of = np.full(size, -1, np.int64)
        rule_of[good] = np.arange(len(good))
        rule = np.where(mine, rule_of[slot], -1)
        hit = rule >= 0
        at, rule = at[hit], rule[hit]
        begins = np.ones(len(at), bool)
        begins[1:] = np.diff(at) > 1
        run = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        even = (np.arange(len(at)) - run) % 2 == 0
        at, rule = at[even], rule[even]
        s[at] = base + len(rules) + rule
        last[at] = last[at + 1]
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        before = len(s)
        s, last = s[keep], last[keep]
        rules = np.concatenate([rules, np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)])
        if before - len(s) < gain * before:
            break
    return s, rules, last


def rule_ranges(rules: np.ndarray, base: int) -> Iterator[tuple[int, int]]:
    """Ranges of rules, each as long as can be, whose parts are ids and rules of earlier ranges; about one a round."""
    latest, i = rules.max(axis=1).astype(np.int64) - base if len(rules) else np.empty(0, np.int64), 0
    while i < len(rules):
        inner = np.flatnonzero(latest[i:] >= i)
        j = i + int(inner[0]) if len(inner) else len(rules)
        yield i, j
        i = j


def write_file(docs: list[int], bodies: list[np.ndarray], base: int) -> bytes:
    ids = np.concatenate(bodies) if bodies else np.empty(0, np.uint32)
    sizes = np.array([len(b) for b in bodies], np.int64)
    last = np.zeros(len(ids), bool)
    ends = np.cumsum(sizes)
    last[ends[sizes > 0] - 1] = True
    symbols, rules, last = repair(ids, last, base)
    per_doc = np.zeros(len(bodies), np.int64)
    per_doc[sizes > 0] = np.diff(np.flatnonzero(last), prepend=-1)
    lengths = np.ones(len(rules), np.uint32)
    for i, j in rule_ranges(rules, base):
        parts = rules[i:j].astype(np.int64) - base
        lengths[i:j] = np.where(parts >= 0, lengths[np.maximum(parts, 0)], 1).sum(axis=1)
    kind = "<u2" if base + len(rules) <= 65536 else "<u4"
    head = struct.pack("<4s5q", MAGIC, base, len(docs), len(rules), len(symbols), int(kind[-1]))
    parts = [np.array(docs, "<i8"), np.concatenate([[0], np.cumsum(per_doc)]).astype("<i8"), np.concatenate([[0], ends]).astype("<i8"), rules.astype("<u4"), lengths.astype("<u4"), symbols.astype(kind)]
    return head + b"".join(p.tobytes() for p in parts)


class GrammarFile:
    """Reads a file; ``document(i)`` expands one document's symbols only."""

    def __init__(self, content: bytes):
        magic, self.base, n_docs, n_rules, n_symbols, width = struct.unpack_from("<4s5q", content)
        if magic != MAGIC:
            raise ValueError("not a grammar file")
        at = struct.calcsize("<4s5q")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(content, kind, n, at)
            at += got.nbytes
            return got

        self.doc_ids, self.symbol_at, self.id_at = take("<i8", n_docs), take("<i8", n_docs + 1), take("<i8", n_docs + 1)
        self.rules, self.lengths, self.symbols = take("<u4", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules), take(f"<u{width}", n_symbols)
        self.begin = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        self.expanded = np.empty(self.begin[-1], np.uint32)
        for i, j in rule_ranges(self.rules, self.base):
            self.expanded[self.begin[i] : self.begin[j]] = self._expand(self.rules[i:j].ravel())

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols.astype(np.int64)
        rule = symbols >= self.base
        r = symbols[rule] - self.base
        size = np.ones(len(symbols), np.int64)
        size[rule] = self.lengths[r]
        to = np.cumsum(size) - size
        out = np.empty(int(size.sum()), "<u4")
        out[to[~rule]] = symbols[~rule]
        n = self.lengths[r].astype(np.int64)
        if len(n):
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(to[rule], n) + inner] = self.expanded[np.repeat(self.begin[r], n) + inner]
        return out

    def document(self, i: int) -> np.ndarray:
        return self._expand(self.symbols[self.symbol_at[i] : self.symbol_at[i + 1]])

    def all_ids(self) -> np.ndarray:
        return self._expand(self.symbols)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, base: int, end_id: int | None = 0, file_ids: int = 1 << 20) -> None:
    """Encode every whole text and write grammar files in ascending doc_id order to ``path``.

    Shards are ranges of doc_id, cut at its quantiles; rows without a doc_id come first. Null and empty
    texts are the end id alone. Each row of the table at ``path`` is a file of about ``file_ids`` ids.
    """
    n = shuffle_width(docs.sparkSession)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, size = [], 0
            for doc, ids in encoded_rows(b, tokenizer, end_id, CACHED_WORDS):
                rows.append((0 if doc is None else bisect.bisect_left(cuts, doc), doc, ids.astype("<u2").tobytes() if base <= 65536 else ids.tobytes()))
                size += len(ids)
                if size > 1 << 21:
                    yield batch(rows)
                    rows, size = [], 0
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        a, b, c = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["shard", "doc_id", "ids"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_no, file_no, names, bodies, size = TaskContext.get().partitionId(), 0, [], [], 0

        def out() -> pa.RecordBatch:
            content = write_file([0 if d is None else d for d in names], bodies, base)
            row = [[shard_no], [file_no], [names[0]], [len(names)], [size]]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in row), pa.array([content], pa.binary())], names=["shard", "file_no", "first_doc", "n_docs", "n_ids", "content"])

        for b in batches:
            for doc, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist(), strict=True):
                body = np.frombuffer(raw, "<u2" if base <= 65536 else "<u4").astype(np.uint32)
                if bodies and (size + len(body) > file_ids or (names[-1] is None) != (doc is None)):
                    yield out()
                    file_no, names, bodies, size = file_no + 1, [], [], 0
                names.append(doc)
                bodies.append(body)
                size += len(body)
        if bodies:
            yield out()

    (
        docs.select("doc_id", "text")
        .mapInArrow(encode, "shard int, doc_id long, ids binary")
        .repartitionById(len(cuts) + 1, F.col("shard"))
        .sortWithinPartitions("doc_id")
        .mapInArrow(build, FILES)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files at ``path``."""
    files = spark.read.schema(FILES).parquet(path)
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).select("shard", before(Window.orderBy("shard")).alias("shard_before"))  # a row a shard
    inside = files.select("shard", "file_no", before(Window.partitionBy("shard").orderBy("file_no")).alias("inside"))
    begins = inside.join(shards, "shard").select("shard", "file_no", (F.col("shard_before") + F.col("inside")).alias("before"))  # a row a file
    if begins.count() <= 1_000_000:
        begins = F.broadcast(begins)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, first, before in zip(b.column("content"), b.column("first_doc").to_pylist(), b.column("before").to_pylist(), strict=True):
                f = GrammarFile(content.as_py())
                ids, at = memoryview(f.all_ids()).cast("B"), f.id_at.tolist()
                crc = [zlib.crc32(ids[4 * at[i] : 4 * at[i + 1]]) for i in range(len(f.doc_ids))]
                names = pa.array(f.doc_ids, pa.int64()) if first is not None else pa.nulls(len(f.doc_ids), pa.int64())
                yield pa.RecordBatch.from_arrays([names, pa.array(f.id_at[:-1] + before), pa.array(np.diff(f.id_at)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.join(begins, ["shard", "file_no"]).select("content", "first_doc", "before").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, base: int, end_id: int | None = 0) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    path = new_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, base, end_id)
    return read_token_files(docs.sparkSession, path)
