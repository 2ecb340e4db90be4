"""Best rows by blocks, substrings by trigrams, segments and snapshots against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from lawloom.operators import postings, search, segments, trigrams
from lawloom.sources import snapshots

WORDS = [f"w{i}" for i in range(300)]
WEIGHTS = list(search.WEIGHTS.values())
FIELDS = "chunk_id string, title string, aliases string, body string, compact string"


def texts(n, seed):
    rng = random.Random(seed)
    often = [1 / (i + 1) for i in range(300)]
    out = []
    for i in range(n):
        body = rng.choices(WORDS, often, k=rng.randint(5, 80))
        body += [rng.choice(["w0", "w1", "rare"])] * rng.choice([0, 0, 0, 0, 0, 12])  # a few rows stand out
        out.append((f"c{i:05}", " ".join(rng.choices(WORDS, often, k=2)), "", " ".join(body), ""))
    return out


def test_best_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "SMALL", 8)
    path = f"file://{tmp_path}/i"
    df = spark.createDataFrame(texts(6000, 1), FIELDS)
    search.write_postings(df, "chunk_id", list(search.WEIGHTS), path, WEIGHTS)
    found = search.open_segments(spark, path)
    some = df.where(F.crc32("chunk_id") % 3 == 0).select("chunk_id")
    for query, k, chosen in (("w0", 10, None), ("w0 w1", 10, None), ("w20 w0 w1", 10, None), ("rare w0 w7", 25, some), ("w0 w0 w2", 50, some), ("w299", 5, None), ("nowhere w1", 10, None), ("w0,w1", 10, None)):
        phrases = search.query_phrases(query)
        every = postings.every_row(spark, found, "chunk_id", phrases, WEIGHTS)
        every = every if chosen is None else every.join(chosen, "chunk_id", "left_semi")
        want = [tuple(r) for r in every.orderBy("score", "chunk_id").select("chunk_id", F.round("score", 9)).limit(k).collect()]
        best = postings.top_rows(spark, found, "chunk_id", phrases, WEIGHTS, k, chosen)
        assert [tuple(r) for r in best.rows.orderBy("score", "chunk_id").select("chunk_id", F.round("score", 9)).limit(k).collect()] == want, query
        assert best.read <= best.blocks
        if query == "w0":  # a common term
            assert best.blocks > 40 and best.read < 0.4 * best.blocks, (query, best.read, best.blocks)
    with pytest.raises(ValueError):
        postings.top_rows(spark, found, "chunk_id", [["w0"]], [1.0, 1.0, 1.0, 1.0], 5)


def test_trigrams(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"c{i}", "".join(rng.choices("abc 가나", k=rng.randint(0, 12))), "".join(rng.choices("xyz", k=rng.randint(0, 3)))) for i in range(1500)] + [("null", None, None)]
    df = spark.createDataFrame(rows, "chunk_id string, a string, b string")
    path = f"file://{tmp_path}/t"
    search.write_postings(df.select("chunk_id", F.lit("x").alias("t")), "chunk_id", ["t"], path)
    trigrams.write_trigrams(df, "chunk_id", ["a", "b"], path)
    found = search.open_segments(spark, path)
    for part in ("a", "가", "ab", "나가", "abc", "a b", "가나가", "abca", "zzzz", "qq", "", "c 가a나"):
        want = {i for i, a, b in rows if (a is not None and part in a) or (b is not None and "xy" in b)}
        got = {r.chunk_id for r in trigrams.holding(spark, found, df, "chunk_id", [("a", part), ("b", "xy")]).collect()}
        assert got == want, part
    few = trigrams.candidates(spark, found, "chunk_id", "a", "가나가")
    hits = sum("가나가" in (a or "") for _, a, _ in rows)
    assert hits <= few.count() <= 2 * hits + 5
    with pytest.raises(ValueError):
        trigrams.candidates(spark, [postings.Segment(f"file://{tmp_path}/none", {})], "chunk_id", "a", "abc")


CHUNK = "chunk_id string, document_id string, version_id string, title string, department string, text string, document_type string, revision_date string, effective_date string, article_no string, appendix_no string, section_path string, access_level string, source_url string"


def index_rows(spark, rows):
    chunks = spark.createDataFrame([(i, f"D{i}", "V1", t, None, x, "regulation", None, None, None, None, None, "public", None) for i, t, x in rows], CHUNK)
    versions = spark.createDataFrame([("V1", True, "in_force", "confirmed")], "version_id string, is_latest_version boolean, validity_status string, status_confidence string")
    documents = spark.createDataFrame([("D", None, None)], "document_id string, alternative_titles array<string>, latest_version_id string")
    return search.index_rows(chunks, versions, documents)


def answers(spark, path):
    every = {"include_history": True, "include_secondary": True}
    out = []
    for query, filters in (("alpha", every), ("beta gamma", every), ("a b", every), (None, {**every, "title_contains": "ta"}), ("alpha", {})):
        out.append([(r.chunk_id, round(r.score, 12), r.rank) for r in search.search(spark, path, query, filters, 20).orderBy("rank").collect()])
    out.append(sorted(r.chunk_id for r in search.substring_rows(spark, path, "al", every).collect()))
    return out


def test_segments(spark, tmp_path):
    """After adds, replacements, removals and merges in any order, searches answer as an index built anew."""
    rng = random.Random(9)
    words = "alpha beta gamma delta a b".split()
    path, live = f"file://{tmp_path}/s", {}
    for step in range(5):
        batch = {f"c{rng.randint(0, 14)}": (rng.choice(words), " ".join(rng.choices(words, k=rng.randint(1, 9)))) for _ in range(6)}
        gone = rng.sample(sorted(live), min(len(live), 2)) if step in (2, 4) else []
        segments.change(spark, path, index_rows(spark, [(k, *v) for k, v in batch.items()]), spark.createDataFrame([(g,) for g in gone], "chunk_id string") if gone else None)
        live = {k: v for k, v in {**live, **batch}.items() if k not in gone}
        if step == 3:
            before = snapshots.Snapshots(spark, path).latest()
            assert segments.merge(spark, path, tier=2) > before
    fresh = f"file://{tmp_path}/fresh"
    search.write_index(index_rows(spark, [(k, *v) for k, v in live.items()]), fresh)
    want = answers(spark, fresh)
    assert answers(spark, path) == want
    segments.merge(spark, path, everything=True)
    assert answers(spark, path) == want and len(search.open_segments(spark, path)) == 1
    assert segments.merge(spark, path, everything=True) == snapshots.Snapshots(spark, path).latest()
    segments.change(spark, path, removed=spark.createDataFrame([(k,) for k in live], "chunk_id string"))
    assert answers(spark, path) == [[], [], [], [], [], []]


def test_size_classes():
    entries = [{"stats": {"n": n}} for n in (1, 2, 3, 3, 5, 90, 100)]
    assert [[e["stats"]["n"] for e in c] for c in segments.tiers(entries)] == [[1, 2, 3, 3]]


def test_snapshots(spark, tmp_path):
    """Two tables change together; who comes second is refused; a writer that stopped leaves the old state."""
    log = snapshots.Snapshots(spark, f"file://{tmp_path}/log")
    assert log.latest() == 0 and log.state()["tables"] == {}
    one = log.begin()
    one.append("a", spark.range(3))
    one.append("b", spark.createDataFrame([(1, "x")], "k int, v string"))
    with pytest.raises(KeyError):
        log.read("a")
    assert one.commit() == 1 and log.read("a").count() == 3
    two, three = log.begin(), log.begin()
    two.append("a", spark.range(3, 5))
    two.replace("b", log.read("b").withColumn("v", F.lit("y")))
    three.append("a", spark.range(100, 101))
    assert two.commit() == 2
    with pytest.raises(snapshots.Conflict):
        three.commit()
    assert sorted(r.id for r in log.read("a").collect()) == [0, 1, 2, 3, 4] and log.read("b").first().v == "y"
    assert log.read("a", 1).count() == 3 and log.read("b", 1).first().v == "x"
    stopped = log.begin()
    stopped.append("a", spark.range(7, 9))  # and never published
    assert log.read("a").count() == 5 and len(log.unused()) == 2 and log.latest() == 2
    with pytest.raises(ValueError):
        log.begin().append("a", spark.createDataFrame([("x",)], "id string"))
    with pytest.raises(KeyError):
        log.state(7)


def test_one_of_many_writers_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    log = snapshots.Snapshots(spark, f"file://{tmp_path}/log")
    writers = [log.begin() for _ in range(8)]

    def commit(w):
        w.notes["who"] = writers.index(w)
        try:
            return w.commit()
        except snapshots.Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(commit, writers))
    assert sorted(filter(None, got)) == [1] and log.state()["notes"]["who"] == got.index(1)
