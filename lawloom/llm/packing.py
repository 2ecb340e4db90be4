"""Packing by minimum bin slack.

Each task packs its own window of documents: chunks of a full window stand
alone, and the remaining lengths are packed from their histogram. A pattern is
found by a bitset subset-sum over the remaining length counts (the bits of one
Python integer are the reachable fills), backtracked to counts per length, and
applied as often as the counts allow, so the number of patterns depends on the
number of different lengths, not on the documents. Where the closest fill is not
exact, only its slack is cut from another document; what fills no whole window
at the end is cut into powers of two, which need no padding. There is no shuffle
and a task holds at most ``flush_docs`` documents' remainders.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lawloom.llm.encode import CACHE_ENTRIES, encoded_rows, forget_words
from lawloom.llm.scratch import released

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def best_fill(counts: dict[int, int], room: int) -> tuple[dict[int, int], int]:
    """The multiset of lengths, within ``counts``, whose sum comes closest to ``room`` from below; and that sum."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for size in sorted((s for s, n in counts.items() if n and s <= room), reverse=True):
        left, take = min(counts[size], room // size), 1
        while left:
            take = min(take, left)
            steps.append((size, take, reach))
            reach |= (reach << (size * take)) & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total = at = reach.bit_length() - 1
    used: dict[int, int] = defaultdict(int)
    for size, take, had in reversed(steps):
        if not had >> at & 1:
            used[size] += take
            at -= size * take
    return dict(used), total


def fill_window(counts: dict[int, int], window: int) -> tuple[dict[int, int], int]:
    """A window's lengths: the longest one and the multiset that comes closest to what it leaves; and the slack."""
    longest = max(counts)
    counts[longest] -= 1
    used, total = best_fill(counts, window - longest)
    counts[longest] += 1
    used[longest] = used.get(longest, 0) + 1
    return used, window - longest - total


def stream_cuts(total: int, window: int) -> list[int]:
    """Ends of the sequences over ``total`` ids laid end to end: whole windows, then powers of two."""
    ends = list(range(window, total + 1, window))
    at = total - total % window
    for bit in range(window.bit_length(), -1, -1):
        if total % window >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def pack_lengths(lengths: np.ndarray, window: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(item, start in the item, length, sequence, offset) for items all shorter than ``window``; and how many sequences.

    An exact fill is applied as often as the counts allow. Where the closest fill leaves a slack, the
    longest item not in it (all others are longer than the slack) gives its head for it, and its rest is
    an item again. Items that fill no whole window go to sequences of powers of two.
    """
    where: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, size in enumerate(lengths.tolist()):
        if size:
            where[size].append((i, 0))
    counts = {s: len(w) for s, w in where.items()}
    out, seq, left = [], 0, sum(s * n for s, n in counts.items())

    def take(size: int, length: int, at: int) -> int:
        """The first ``length`` ids of an item of ``size``, placed at ``at``; the rest goes back."""
        item, start = where[size].pop()
        counts[size] -= 1
        if not counts[size]:
            del counts[size]
        out.append((item, start, length, seq, at))
        if length < size:
            where[size - length].append((item, start + length))
            counts[size - length] = counts.get(size - length, 0) + 1
        return at + length

    while left >= window:
        used, slack = fill_window(counts, window)
        times = 1 if slack else min(counts[s] // n for s, n in used.items())
        for _ in range(times):
            at = 0
            for size, n in sorted(used.items(), reverse=True):
                for _ in range(n):
                    at = take(size, size, at)
            if slack:
                at = take(max(counts), slack, at)
            seq, left = seq + 1, left - window
    for begin, end in itertools.pairwise([0, *stream_cuts(left, window)]):
        at = begin
        while at < end:
            size = max(counts)
            at = take(size, min(size, end - at), at - begin) + begin
        seq += 1
    return out, seq


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int | None = 1, flush_docs: int = 16384, with_ids: bool = False, cached_words: int = CACHE_ENTRIES, keep_words: bool = True) -> DataFrame:
    """Pieces of the encoded documents with their place in sequences of at most ``window`` ids.

    One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ``with_ids``
    adds the ids as an array. Null and empty texts are the end id alone (without an end id they give
    no piece). Repeated rows are packed as often as they come; null doc_id stays null. Other columns
    are not read. sequence_id is unique: the task's partition in the high bits. Without ``keep_words`` a task
    gives back its cached words when it ends, which leaves memory to what else runs in the worker.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        next_seq, rows, held = base, [], []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in range(7 + with_ids)]
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            names = FIELDS
            if with_ids:
                arrays.append(pa.array([np.asarray(x, np.int32) for x in cols[7]], pa.list_(pa.int32())))
                names = [*FIELDS, "ids"]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def put(doc: object, ids: np.ndarray, start: int, total: int, seq: int, offset: int) -> None:
            row = (doc, start, len(ids), zlib.crc32(ids.tobytes()), total, seq, offset)
            rows.append((*row, ids) if with_ids else row)

        def flush() -> None:
            nonlocal next_seq
            placed, n = pack_lengths(np.array([len(x[1]) for x in held], np.int64), window)
            for item, start, length, seq, offset in placed:
                doc, ids, at, total = held[item]
                put(doc, ids[start : start + length], at + start, total, next_seq + seq, offset)
            next_seq += n
            held.clear()

        for b in batches:
            for doc, ids in encoded_rows(b, tokenizer, end_id, cached_words):
                whole = len(ids) // window * window
                for at in range(0, whole, window):
                    put(doc, ids[at : at + window], at, len(ids), next_seq, 0)
                    next_seq += 1
                if whole < len(ids):
                    held.append((doc, ids[whole:].copy(), whole, len(ids)))
                if len(held) >= flush_docs:
                    flush()
                if len(rows) >= 8192:
                    yield batch()
        flush()
        if not keep_words:
            forget_words(tokenizer)
        yield batch()

    return docs.select("doc_id", "text").mapInArrow(released(run), schema)
