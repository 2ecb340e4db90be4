"""A search index that is kept up batch by batch.

The index is a log of snapshots (``sources.snapshots``), each naming immutable
segments. A batch becomes a new segment; what it replaces or removes is listed
as dead beside the segment that holds it, with the terms that no longer count.
Statistics are sums over segments less what is dead, so scores are those of an
index built anew. Segments of one size class are merged when there are enough
of them, so a row is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.operators import search
from lawloom.sources.snapshots import Snapshots, get_text

#: Segments of a size class that are merged, which is also the ratio of two classes.
TIER = 4


def _live(entry: dict) -> int:
    return entry["stats"]["n"] - entry.get("dead_stats", {}).get("dead_n", 0)


def _buried(spark: SparkSession, path: str, entry: dict, keys: DataFrame, folder: str) -> dict:
    """The segment with the rows of ``keys`` (chunk_id) dead besides those that were; unchanged where it has none of them."""
    rows = search.segment_rows(spark, f"{path}/{entry['folder']}")
    before = [spark.read.parquet(f"{path}/{entry['dead']}/keys")] if entry.get("dead") else []
    gone = rows.join(keys, "chunk_id", "left_semi")
    for b in before:
        gone = gone.join(b, "chunk_id", "left_anti")
    cut = search.indexed_fields(gone).select("chunk_id", *[search.terms(F.col(f)).alias(f) for f in search.WEIGHTS])
    cut = cut.withColumn("terms", F.concat(*search.WEIGHTS)).select("chunk_id", "terms").persist()
    sums = cut.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("dl")).first()
    if not sums.n:
        cut.unpersist()
        return entry
    dead, counts = cut.select("chunk_id"), cut.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    for b in before:
        dead = dead.unionByName(b)
        counts = counts.unionByName(spark.read.parquet(f"{path}/{entry['dead']}/terms")).groupBy("term").agg(F.sum("n").alias("n"))
    dead.write.parquet(f"{path}/{folder}/keys")
    counts.sortWithinPartitions("term").write.parquet(f"{path}/{folder}/terms")
    cut.unpersist()
    was = entry.get("dead_stats", {"dead_n": 0, "dead_dl": 0})
    return {**entry, "dead": folder, "dead_stats": {"dead_n": was["dead_n"] + sums.n, "dead_dl": was["dead_dl"] + sums.dl}}


def _segment(spark: SparkSession, path: str, rows: DataFrame, folder: str) -> dict:
    search.write_segment(rows, f"{path}/{folder}")
    return {"folder": folder, "stats": json.loads(get_text(spark, f"{path}/{folder}/stats.json"))}


def change(spark: SparkSession, path: str, rows: DataFrame | None = None, removed: DataFrame | None = None) -> int:
    """Adds index rows, replacing those of the same chunk_id, and removes the ids of ``removed`` (chunk_id); returns the number of the snapshot.

    Only the batch is cut and written; of older segments the rows that go are read for their terms. chunk_id must be
    unique within the batch. Readers see the state before or the state after. Conflict where another writer came
    first; nothing of this one is then seen.
    """
    tx = Snapshots(spark, path).begin()
    entries = tx.notes.get("segments", [])
    new = _segment(spark, path, rows, tx.folder("segment")) if rows is not None else None
    keys = [search.segment_rows(spark, f"{path}/{new['folder']}").select("chunk_id")] if new else []
    keys += [removed.select("chunk_id")] if removed is not None else []
    for k in keys:
        entries = [_buried(spark, path, e, k, tx.folder("dead")) for e in entries]
    if new and removed is not None:  # what is both added and removed is removed
        new = _buried(spark, path, new, removed.select("chunk_id"), tx.folder("dead"))
    tx.notes["last"] = (new or entries[-1])["folder"] if new or entries else tx.notes.get("last")  # whose columns an empty index shows
    tx.notes["segments"] = [e for e in entries if _live(e)] + ([new] if new and _live(new) else [])
    return tx.commit()


def tiers(entries: list[dict], tier: int = TIER) -> list[list[dict]]:
    """The segments of each size class that has ``tier`` of them or more."""
    classes: dict[int, list[dict]] = {}
    for e in entries:
        classes.setdefault(int(math.log(max(1, _live(e)), tier)), []).append(e)
    return [c for _, c in sorted(classes.items()) if len(c) >= tier]


def merge(spark: SparkSession, path: str, tier: int = TIER, everything: bool = False) -> int:
    """Merges the segments of each full size class, or all of them, into one without dead rows; returns the number of the snapshot, the last one if there was nothing to merge."""
    log = Snapshots(spark, path)
    tx = log.begin()
    entries = tx.notes.get("segments", [])
    groups = ([entries] if len(entries) > 1 or any(e.get("dead") for e in entries) else []) if everything else tiers(entries, tier)
    if not groups:
        return tx.base["number"]
    for group in groups:
        chosen = [s for s, e in zip(search.open_segments(spark, path, tx.base["number"]), tx.base["notes"]["segments"], strict=True) if e in group]
        merged = _segment(spark, path, search.spark_rows(spark, path, chosen), tx.folder("segment"))
        entries = [e for e in entries if e not in group] + [merged]
    tx.notes["segments"] = entries
    return tx.commit()
