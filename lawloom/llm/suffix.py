"""Removal of repeated byte strings with suffix arrays sharded by content.

A window is any string of ``length`` bytes inside a text. Every window names as
its anchor the gram (half the length) of least hash inside it, so equal
windows name equal anchors at equal places. Anchors are counted over the whole corpus; only
windows whose anchor occurs in another place can be repeated, and only the text
around those (a *segment* per anchor and text) moves. All segments of an anchor
meet in one shard, where a suffix array (Larsson-Sadakane refinement) with
common prefixes (Kasai's relation between neighbours in text order) tells which
windows occur twice. Where shorter passages are asked for besides, anchors and
segments follow their windows, segments reach on to the long windows that begin
in them, and one suffix array tells both. An anchor with more segments than ``hot_segments`` is dealt
over several shards by segment; each shard then sends one row for each different
window, and sorted runs of these are merged by binary search.

Equal texts are one text with a count: a text of two copies or more repeats as a
whole, and takes part in the search once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.scratch import discard, released, shuffle_width, stored

HOT_KEYS = 2000
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE, UNBASE = 0x9E3779B97F4A7C17 | 3, pow(0x9E3779B97F4A7C17 | 3, -1, 1 << 64)
BYTES = np.random.default_rng(20240607).integers(0, 1 << 64, 256, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, 1 << 16), base, np.uint64)
        got[0] = 1
        _powers[base] = got = np.cumprod(got, dtype=np.uint64)
    return got[:n]


def prefix_sums(data: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(BASE, len(data)), out=sums[1:])
    return sums


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes at each place where so many are left."""
    sums = prefix_sums(data)
    return mixed((sums[size:] - sums[:-size]) * powers(UNBASE, len(data) - size + 1))


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbours, from prefix and suffix minima of blocks."""
    n = len(x) - w + 1
    blocks = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, w)
    fore = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], fore[w - 1 : w - 1 + n])


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(hash, text, first, last): runs of windows with the same anchor; first and last are window starts in their text."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    grams = gram_hashes(data, length // 2)
    bits = np.uint64(max(20, int(len(grams)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    best = (sliding_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - length // 2 + 1) & low).astype(np.int64)
    text = np.repeat(np.arange(len(starts)), ends - starts)[: len(best)]
    good = ends[text] - np.arange(len(best)) >= length
    at = np.flatnonzero(good)
    if not len(at):
        return none, none, none, none
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (best[at[1:]] != best[at[:-1]]) | (text[at[1:]] != text[at[:-1]])
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
    owner = text[first]
    return grams[best[first]].view(np.int64), owner, first - starts[owner], last - starts[owner]


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes in order: ranks of eight bytes, then of doubled lengths, where only groups not yet sorted are sorted again."""
    n = len(data)
    words = word_at(data)
    left = np.minimum(np.arange(n, 0, -1), 8).astype(np.uint64)
    order = np.lexsort((left, words))
    w, k = words[order], left[order]
    new = np.ones(n, bool)
    new[1:] = (w[1:] != w[:-1]) | (k[1:] != k[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h, slots = 8, None
    while h < n:
        single = new & np.append(new[1:], True)
        slots = np.flatnonzero(~single) if slots is None else slots[~single[slots]]
        if not len(slots):
            break
        pos = order[slots]
        ahead = np.where(pos + h < n, rank[np.minimum(pos + h, n - 1)] + 1, 0)
        key = rank[pos] * (n + 2) + ahead
        by = np.argsort(key, kind="stable")
        pos, key = pos[by], key[by]
        order[slots] = pos
        new[slots[1:]] |= key[1:] != key[:-1]
        group = np.maximum.accumulate(np.where(new[slots], slots, 0))
        rank[pos] = group
        h *= 2
    return order


def word_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a number, zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i : i + len(data)]
    return out


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The common prefix of each suffix with the one before it in order.

    Kasai's relation: where the bytes before a suffix and before its predecessor agree, its common
    prefix is one less than that of the suffix one byte earlier. The others are compared eight bytes at a time.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    open_ = (before > 0) & (at > 0)
    follows = np.zeros(n, bool)
    follows[open_] = data[at[open_] - 1] == data[before[open_] - 1]
    first = np.flatnonzero(~follows)
    words = np.concatenate([word_at(data), np.zeros(8, np.uint64)])
    got = np.zeros(len(first), np.int64)
    live = np.flatnonzero(before[first] >= 0)
    while len(live):
        a, b = first[live] + got[live], before[first[live]] + got[live]
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        same = differ == 0
        lead = np.zeros(len(a), np.int64)
        x = differ[~same]
        bytes_equal = np.zeros(len(x), np.int64)
        for i in range(1, 8):
            bytes_equal += (x >> np.uint64(64 - 8 * i)) == 0
        lead[~same], lead[same] = bytes_equal, 8
        got[live] += lead
        live = live[same]
    got = np.minimum(got, n - np.maximum(first, before[first]))
    base = np.zeros(n, np.int64)
    base[first] = first + got
    return (base[np.maximum.accumulate(np.where(follows, 0, at))] - at)[order]


def window_groups(segments: list[bytes], starts_in: np.ndarray, lengths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length the (segment, offset, group) of every window that begins in the first ``starts_in`` places of its segment; windows are equal exactly if their groups are."""
    data = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(s) for s in segments], np.int64)
    starts = np.cumsum(sizes) - sizes
    order = suffix_array(data)
    common = common_prefixes(data, order)
    seg = np.repeat(np.arange(len(segments)), sizes)
    off = np.arange(len(data)) - starts[seg]
    for length in lengths:
        joined = common >= length
        joined[0] = False
        valid = ((sizes[seg] - off >= length) & (off < starts_in[seg]))[order]
        at, group = order[valid], np.cumsum(~joined)[valid]
        yield seg[at], off[at], group


def runs(seg: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first, last) of consecutive offsets."""
    if not len(seg):
        return seg, off, off
    by = np.lexsort((off, seg))
    seg, off = seg[by], off[by]
    new = np.ones(len(seg), bool)
    new[1:] = (np.diff(seg) != 0) | (np.diff(off) != 1)
    begin = np.flatnonzero(new)
    return seg[begin], off[begin], off[np.append(begin[1:], len(seg)) - 1]


def _anchor_rows(length: int, batch_bytes: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
            t, u = b.column("t").to_numpy(), b.column("u").to_numpy()
            i = 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + batch_bytes, "right")) - 1)
                starts, ends = offsets[i:j] - offsets[i], offsets[i + 1 : j + 1] - offsets[i]
                h, owner, first, last = anchors(raw[offsets[i] : offsets[j]], starts, ends, length)
                by = np.lexsort((h, owner))
                twice = np.zeros(len(h), bool)
                same = (np.diff(owner[by]) == 0) & (np.diff(h[by]) == 0)
                twice[by[1:][same]] = True
                cols = [pa.array(h), pa.array(t[i:j][owner]), pa.array(u[i:j][owner]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(twice)]
                yield pa.RecordBatch.from_arrays(cols, names=["h", "t", "u", "s", "e", "twice"])
                i = j

    return run


def _cut_rows(reach: int):
    """Segments: the windows' starts from s to e, and ``reach`` bytes from the last of them as far as the text goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, size = [], 0
            for t, u, text, places in zip(b.column("t").to_pylist(), b.column("u").to_pylist(), b.column("text"), b.column("places").to_pylist(), strict=True):
                raw = text.as_py().encode()
                for p in places:
                    seg, m = raw[p["s"] : p["e"] + reach], p["e"] - p["s"] + 1
                    rows.append((p["h"], hashlib.blake2b(seg, digest_size=16, salt=m.to_bytes(8, "little")).digest(), t, u, p["s"], m, seg))
                    size += len(seg)
                    if size > 4 << 20:
                        yield _segment_batch(rows)
                        rows, size = [], 0
            yield _segment_batch(rows)

    return run


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["h", "g", "t", "u", "s", "m", "seg"])


def _shard_rows(lengths: list[int], export: bool, shard_bytes: int = 1 << 18):
    """Suffix arrays over whole groups (by h, and part): for each length the runs of repeated windows, or a row for each different window."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        segs, whole = [r[2] for r in rows], np.array([r[3] > 1 for r in rows])
        starts_in = np.array([r[4] for r in rows], np.int64)
        for length, (seg, off, group) in zip(lengths, window_groups(segs, starts_in, lengths), strict=True):
            count = np.bincount(group, minlength=int(group.max(initial=0)) + 1)
            repeated = count[group] > 1
            if not export:
                s, a, b = runs(*((x[repeated | whole[seg]]) for x in (seg, off)))
                size = np.full(len(s), length, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([rows[i][1] for i in s], pa.binary()), pa.array(size), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["g", "size", "a", "b"])
                continue
            first = np.flatnonzero(np.append(True, np.diff(group) != 0)) if len(group) else np.empty(0, np.int64)
            many = repeated[first] | whole[seg[first]]
            salt = length.to_bytes(8, "little")
            keys = [hashlib.blake2b(segs[i][o : o + length], digest_size=16, salt=salt).digest() for i, o in zip(seg[first], off[first], strict=True)]
            index = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(group))))
            size = np.full(len(seg), length, np.int64)
            cols = [pa.array([keys[i] for i in index], pa.binary()), pa.array([rows[i][1] for i in seg], pa.binary()), pa.array(size), pa.array(off, pa.int64()), pa.array(many[index], pa.bool_()), pa.array(np.isin(np.arange(len(group)), first))]
            yield pa.RecordBatch.from_arrays(cols, names=["w", "g", "size", "a", "many", "lead"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for b in batches:
            for h, g, seg, n, m in zip(*(b.column(c).to_pylist() for c in ("k", "g", "seg", "n", "m")), strict=True):
                if h != last and size >= shard_bytes:
                    yield from solve(held)
                    held, size = [], 0
                held.append((h, g, seg, n, m))
                size, last = size + len(seg), h
        if held:
            yield from solve(held)

    return run


def _merge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted windows of all shards: those that more than one row has, found by binary search; a key's rows can span batches."""
    held: list[bytes] = []
    for b in batches:
        held += b.column("w").to_pylist()
        if len(held) > 50_000 and held[0] != held[-1]:
            cut = next(i for i in range(len(held) - 1, -1, -1) if held[i] != held[-1]) + 1
            yield _found(held[:cut])
            held = held[cut:]
    yield _found(held)


def _found(keys: list[bytes]) -> pa.RecordBatch:
    x = np.array(keys, "S16") if keys else np.empty(0, "S16")
    more = np.searchsorted(x, x, "right") - np.searchsorted(x, x, "left") > 1
    return pa.RecordBatch.from_arrays([pa.array([k for k, m in zip(keys, more, strict=True) if m], pa.binary())], names=["w"])


def _covered(n: int, places: list[dict], size: int) -> np.ndarray:
    """Which of ``n`` bytes lie in a repeated window of this size."""
    edge = np.zeros(n + 1, np.int64)
    own = [p for p in places if p["size"] == size]
    np.add.at(edge, [p["a"] for p in own], 1)
    np.add.at(edge, [p["b"] + size for p in own], -1)
    return np.cumsum(edge[:-1]) > 0


def _kept_rows(length: int, passage: int | None, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            size = 0
            for t, u, text, places in zip(b.column("t").to_pylist(), b.column("u").to_pylist(), b.column("text"), b.column("places").to_pylist(), strict=True):
                raw = text.as_py().encode()
                data = np.frombuffer(raw, np.uint8)
                gone = _covered(len(raw), places, length)
                spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1))
                n = int(gone.sum())
                short = int(_covered(len(raw), places, passage).sum()) if passage else 0
                if as_text:  # a character stays or goes as a whole: it goes if any of its bytes does
                    lead = (data & 0xC0) != 0x80
                    char = np.cumsum(lead) - 1
                    gone = np.bincount(char, gone)[char] > 0
                out.append((t, u, n, spans, short, data[~gone].tobytes() if n else None))
                size += len(raw)
                if size > 4 << 20:
                    yield _kept_batch(out)
                    out, size = [], 0
            yield _kept_batch(out)

    return run


def _kept_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
    kinds = [pa.int64()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["t", "u", "n_removed", "n_spans", "n_passage_bytes", "kept"])


def text_key() -> list:
    """Two 64-bit hashes that stand for a text."""
    return [F.xxhash64("text").alias("t"), F.xxhash64(F.lit(7), "text").alias("u")]


def repeated_spans(docs: DataFrame, length: int = 400, hot_segments: int = 4000, as_text: bool = False, passage: int | None = None) -> tuple[DataFrame, DataFrame]:
    """What to remove from each different text: (t, u, n_removed, n_spans, n_passage_bytes, kept) and (t, u) of texts that repeat as a whole.

    t and u are the keys of ``text_key()`` (null text counts as empty). Only texts with a repeated string have a
    row; kept is null where nothing is removed. n_passage_bytes counts the bytes in strings of ``passage`` bytes
    (less than ``length``) that also begin elsewhere, whether removed or not; 0 without it. Copies of at least
    ``length`` (or ``passage``) bytes are in the second table only. ``as_text`` removes whole characters, so that
    kept is valid UTF-8.
    """
    spark, width = docs.sparkSession, shuffle_width(docs.sparkSession)
    lengths = sorted({length, passage or length})
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", *text_key())
    long_texts = texts.where(F.octet_length("text") >= lengths[0])
    anchor_rows = stored(
        long_texts.select("t", "u", "text").mapInArrow(released(_anchor_rows(lengths[0])), "h long, t long, u long, s int, e int, twice boolean"), "anchors"
    )
    again = (
        anchor_rows.groupBy("h")
        .agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.min("u").alias("u0"), F.max("u").alias("u1"), F.max("twice").alias("twice"), F.count("*").alias("n"))
        .where("t0 <> t1 or u0 <> u1 or twice")
        .select("h", "n")
    )
    again = stored(again, "again")
    # at most HOT_KEYS anchors can have more rows than this share of all, so a list of them is bounded; their rows need no join
    share = max(4096, anchor_rows.count() // HOT_KEYS)
    hot = F.col("h").isin([r.h for r in again.where(F.col("n") > share).select("h").collect()])
    calm_rows = anchor_rows.where(~hot).join(again.where(F.col("n") <= share).select("h"), "h", "left_semi")
    places = anchor_rows.where(hot).unionByName(calm_rows).groupBy("t", "u").agg(F.collect_set(F.struct("h", "s", "e")).alias("places"))
    one = stored(long_texts.groupBy("t", "u").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "texts")
    chosen = places.join(one.select("t", "u", "rep"), ["t", "u"])
    with_text = long_texts.join(chosen, ["t", "u"]).where(F.col("doc_id").eqNullSafe(F.col("rep"))).select("t", "u", "text", "places")
    found = stored(with_text.mapInArrow(released(_cut_rows(length)), "h long, g binary, t long, u long, s long, m long, seg binary"), "segments")
    discard(anchor_rows, again)
    # a text whose rows share a doc_id comes more than once here; its places are counted once
    held = stored(found.select("g", "t", "u", "s").distinct(), "held")
    times = held.groupBy("g").agg(F.count("*").alias("n"))
    different = found.groupBy("g").agg(F.min("h").alias("h"), F.first("seg").alias("seg"), F.first("m").alias("m")).join(times, "g")
    different = stored(different, "different")
    discard(found)
    crowded = different.groupBy("h").agg(F.count("*").alias("many")).where(F.col("many") > hot_segments)
    crowded = stored(crowded, "crowded")
    dealt = different.join(crowded, "h", "left")
    calm = dealt.where("many is null")
    pick = ["k", "g", "seg", "n", "m"]
    hits = calm.select(F.col("h").alias("k"), *pick[1:]).repartition(width, "k").sortWithinPartitions("k", "g").mapInArrow(released(_shard_rows(lengths, False)), "g binary, size long, a long, b long")
    windows = None
    if not crowded.isEmpty():
        salted = dealt.where("many is not null").withColumn("k", F.xxhash64("h", F.pmod(F.xxhash64("g"), F.ceil(F.col("many") / F.lit(hot_segments / 4)))))
        windows = stored(salted.select(pick).repartition(width, "k").sortWithinPartitions("k", "g").mapInArrow(released(_shard_rows(lengths, True)), "w binary, g binary, size long, a long, many boolean, lead boolean"), "windows")
        shared = windows.where("lead").select("w").repartition(width, "w").sortWithinPartitions("w").mapInArrow(released(_merge_rows), "w binary").distinct()
        far = windows.where("not many").join(shared, "w", "left_semi")
        warm = windows.where("many").unionByName(far)
        hits = hits.unionByName(warm.select("g", "size", "a", F.col("a").alias("b")))
    hits = stored(hits, "hits")
    discard(different, crowded, *([windows] if windows else []))
    spans = (
        held.join(hits, "g")
        .groupBy("t", "u")
        .agg(F.collect_set(F.struct("size", (F.col("s") + F.col("a")).cast("int").alias("a"), (F.col("s") + F.col("b")).cast("int").alias("b"))).alias("places"))
    )
    spans = stored(spans.join(one.where("copies = 1").select("t", "u"), ["t", "u"], "left_semi"), "spans")
    kept = long_texts.join(spans, ["t", "u"]).select("t", "u", "text", "places").mapInArrow(released(_kept_rows(length, passage, as_text)), "t long, u long, n_removed long, n_spans long, n_passage_bytes long, kept binary")
    kept, copies = stored(kept, "kept"), stored(one.where("copies > 1").select("t", "u"), "copies")
    discard(held, hits, spans, one)
    return kept, copies


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every document without the bytes of its repeated windows.

    Null and empty texts, and texts shorter than ``length``, lose nothing. All copies of a repeated string
    go, the first one too. Repeated rows count as copies of each other. Other columns are not read.
    """
    kept, copies = repeated_spans(docs, length)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", F.col("text").cast("binary").alias("raw"), *text_key())
    rows = rows.withColumn("n_bytes", F.octet_length("raw").cast("long"))
    marked = rows.join(kept, ["t", "u"], "left").join(copies.withColumn("copied", F.lit(True)), ["t", "u"], "left")
    return marked.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copied"), F.lit(b"")).otherwise(F.coalesce("kept", "raw")).alias("kept"),
    )


def digests(docs: DataFrame, length: int = 400, passage: int | None = None) -> DataFrame:
    """As ``remove_repeats``, with the SHA-256 of what is kept; texts are hashed where they are read, so none is moved for it.

    With ``passage`` also n_passage_bytes: the document's bytes in strings of that many bytes that begin elsewhere
    too (a copied text counts as a whole), a report on shorter repeats, which are not removed.
    """
    kept, copies = repeated_spans(docs, length, passage=passage)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"), *text_key())
    marked = rows.join(kept.select("t", "u", "n_removed", "n_spans", "n_passage_bytes", F.sha2("kept", 256).alias("part")), ["t", "u"], "left").join(copies.withColumn("copied", F.lit(True)), ["t", "u"], "left")
    copied = F.col("copied") & (F.col("n_bytes") >= length)
    out = marked.select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("part", "whole")).alias("kept_sha256"),
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_passage_bytes", F.lit(0))).alias("n_passage_bytes"),
    )
    return out if passage else out.drop("n_passage_bytes")


def clean_texts(docs: DataFrame, length: int = 400) -> DataFrame:
    """``docs`` with text replaced by what is kept (whole characters) and n_chars, where there is one, by its length; same columns, same rows.

    Null texts stay null and empty ones empty. Every occurrence of a repeated string of ``length`` bytes goes, the
    first one too; all copies of a text become empty. An empty table stays empty.
    """
    kept, copies = repeated_spans(docs, length, as_text=True)
    keyed = docs.withColumns({"__t": F.xxhash64(F.coalesce("text", F.lit(""))), "__u": F.xxhash64(F.lit(7), F.coalesce("text", F.lit("")))})
    left = kept.select(F.col("t").alias("__t"), F.col("u").alias("__u"), F.col("kept").cast("string").alias("__kept"))
    gone = copies.select(F.col("t").alias("__t"), F.col("u").alias("__u"), F.lit("").alias("__gone"))  # all of ``length`` bytes or more
    out = keyed.join(left, ["__t", "__u"], "left").join(gone, ["__t", "__u"], "left")
    out = out.withColumn("text", F.coalesce("__gone", "__kept", "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
