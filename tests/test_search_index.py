"""Ranking, phrases and snippets against SQLite's full-text index; filters and evaluation on a fixture."""

import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from lawloom.operators import search

WORDS = "규정 지침 휴학 복학 위원회 운영 école Straße a b alpha beta 제1조 gamma".split()


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(120):
        body = " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 60)))
        title = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4)))
        rows.append((f"c{i:03}", title, rng.choice(["", "별칭 하나", "alpha·beta"]), body + rng.choice(["", ". 끝: 새 글 alpha beta", " a%b"]), body.replace(" ", "")))
    return rows


def fts(rows):
    db = sqlite3.connect(":memory:")
    db.execute("create virtual table t using fts5(chunk_id unindexed, title, aliases, body, compact, tokenize='unicode61')")
    db.executemany("insert into t values (?,?,?,?,?)", rows)
    return db


def test_bm25_and_phrases(spark, corpus, tmp_path):
    db, path = fts(corpus), f"file://{tmp_path}/i"
    df = spark.createDataFrame(corpus, "chunk_id string, title string, aliases string, body string, compact string")
    search.write_postings(df, "chunk_id", list(search.WEIGHTS), path)
    for query in ("휴학", "alpha beta", "운영 위원회", "ECOLE", "straße", "a%b", "없는말", "규정·지침 복학"):
        phrases = search.query_phrases(query)
        got = {r.chunk_id: r.score for r in search.bm25_of(spark, path, "chunk_id", phrases, list(search.WEIGHTS.values())).collect()}
        match = " OR ".join('"' + " ".join(p) + '"' for p in phrases)
        want = dict(db.execute("select chunk_id, bm25(t, 8.0, 4.0, 1.0, 2.0) from t where t match ?", (match,)).fetchall())
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want), query
    assert search.query_phrases("·()") == [] and search.bm25_of(spark, path, "chunk_id", [], [1.0]).count() == 0
    assert search.query_phrases("가 나") == [["가"], ["나"], ["가나"]] and search.query_phrases("a%b") == [["a", "b"]]


def test_snippets(spark, corpus):
    db = fts(corpus)
    df = spark.createDataFrame([(r[0], r[3]) for r in corpus], "chunk_id string, body string")
    for phrases in ([["alpha"]], [["alpha", "beta"], ["휴학"]], [["끝"], ["a", "b"]]):
        match = " OR ".join('body : "' + " ".join(p) + '"' for p in phrases)
        want = dict(db.execute("select chunk_id, snippet(t, 3, '[', ']', '…', 24) from t where t match ?", (match,)).fetchall())
        got = {r.chunk_id: r.snippet for r in search.snippets(df, "chunk_id", "body", phrases).collect()}
        assert want and {k: got[k] for k in want} == want
    empty = spark.createDataFrame([("a", None), ("b", ""), ("c", "...")], "k string, t string")
    assert {r.k: r.snippet for r in search.snippets(empty, "k", "t", [["x"]]).collect()} == {"a": None, "b": "", "c": "..."}


def tables(spark):
    chunk = "chunk_id string, document_id string, version_id string, title string, department string, text string, document_type string, revision_date string, effective_date string, article_no string, appendix_no string, section_path string, access_level string, source_url string"
    rows = [
        ("c1", "D1", "V1", "휴학 규정", None, "제1조(목적) 휴학에 관한 사항", "regulation", "2020-01-01", None, "제1조", None, None, "public", "http://x/view"),
        ("c2", "D1", "V2", "휴학 규정", None, "제1조(목적) 휴학에 관한 새 사항", "regulation", "2022-01-01", "2022-02-01", "제1조", None, None, "public", None),
        ("c3", "D2", "V3", "운영 지침", "학사과", "개정 사유 휴학", "guideline", None, None, None, None, None, "public", None),
        ("c4", "D2", "V3", "운영 지침", "학사과", "별표 휴학 표", "guideline", None, None, None, "별표", None, "internal", None),
        ("c5", "D3", "V9", "고아", None, "제2조 휴학 " + "긴 글 " * 200, "guideline", "2021-05-05", None, "제2조", None, None, "public", None),
    ]
    versions = [("V1", False, "superseded", "confirmed"), ("V2", True, "in_force", "confirmed"), ("V3", True, None, None)]
    documents = [("D1", ["휴복학 규정", "Leave·Rule"], "V2", None), ("D2", None, "V3", "http://x/list")]
    return (
        spark.createDataFrame(rows, chunk),
        spark.createDataFrame(versions, "version_id string, is_latest_version boolean, validity_status string, status_confidence string"),
        spark.createDataFrame(documents, "document_id string, alternative_titles array<string>, latest_version_id string, source_page_url string"),
    )


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('index')}"
    search.write_index(search.index_rows(*tables(spark)), path)
    return path


def ids(df):
    return [r.chunk_id for r in df.orderBy("rank").collect()]


def test_index_rows(spark):
    rows = {r.chunk_id: r for r in search.index_rows(*tables(spark)).collect()}
    assert rows.keys() == {"c1", "c2", "c3", "c5"}
    a = rows["c1"]
    assert (a.normalized_title, a.compact_title, a.normalized_aliases, a.compact_aliases) == ("휴학 규정", "휴학규정", "|휴복학 규정|leave rule|", "|휴복학규정|leaverule|")
    assert a.search_text.startswith("휴학 규정 휴복학 규정 leave rule none 제1조 목적") and "none" not in a.compact_text
    assert (rows["c3"].section_kind, rows["c3"].retrieval_scope, rows["c3"].validity_status, rows["c3"].normalized_aliases) == ("amendment_reason", "secondary", "unknown", "||")
    assert (rows["c1"].source_page_url, rows["c3"].source_page_url, rows["c3"].source_url_quality, rows["c1"].source_url_quality) == ("http://x/view", "http://x/list", "unknown", "detail")
    assert rows["c5"].is_latest_version is False and rows["c5"].status_confidence == "unknown"


def test_search(spark, index):
    assert ids(search.search(spark, index, "휴학")) == ["c2"]
    assert set(ids(search.search(spark, index, "휴학", {"include_history": True}))) == {"c1", "c2", "c5"}
    assert set(ids(search.search(spark, index, "휴학", {"include_secondary": True}))) == {"c2", "c3"}
    assert len(ids(search.search(spark, index, "휴학", {"include_history": True, "include_secondary": True}, per_document=1))) == 3
    assert ids(search.search(spark, index, None, {"title_exact": "leave rule", "include_history": True})) == ["c1", "c2"]
    assert ids(search.search(spark, index, "", {"title_contains": "복학규", "include_history": True}, limit=1)) == ["c1"]
    assert ids(search.search(spark, index, "휴학", {"current_only": True})) == ["c2"] and ids(search.search(spark, index, "휴학", {"revision_to": "2020-12-31", "include_history": True})) == ["c1"]
    assert ids(search.search(spark, index, "휴학", {"effective_from": "2022-01-01"})) == ["c2"] and ids(search.search(spark, index, "···")) == [] and ids(search.search(spark, index, "없는말")) == []
    long = search.search(spark, index, "긴", {"include_history": True}).first()
    assert len(long.context) == 280 and long.context.endswith("...") and "search_text" not in long.asDict()
    shown = search.display(search.search(spark, index, "휴학"))
    assert shown.columns == list(search.DISPLAY)
    assert search.tsv_lines(search.search(spark, index, "휴학")).first().line.split("\t")[:3] == ["1", "휴학 규정", "regulation"]


def test_fallback(spark, index, tmp_path):
    rows = search.spark_rows(spark, index)
    rows.write.partitionBy("retrieval_scope", "is_latest_version").parquet(f"file://{tmp_path}/x/rows")
    found = search.search(spark, f"file://{tmp_path}/x", "휴학에 관한새", {"include_history": True})
    assert ids(found) == ["c2"] and found.first().score == 0.0


def test_evaluation(spark, index):
    case = lambda name, q, doc, v, **more: {"name": name, "query": q, "expected": [{"document_id": doc, "version_id": v}], **more}
    good = [case("a", "휴학", "D1", "V2"), case("b", None, "D1", "V1", filters={"include_history": True, "revision_to": "2020-01-01"})]
    assert search.evaluate_cases(spark, index, good).first().asDict() == {"cases": 2, "recall": 1.0, "mrr": 1.0, "passed": True}
    bad = [*good, case("c", "휴학", "D9", "V9"), case("d", "휴학", "D1", "V2", filters={"include_secondary": True}, forbidden_section_kinds=["amendment_reason"])]
    assert search.evaluate_cases(spark, index, bad).first().asDict() == {"cases": 4, "recall": 0.5, "mrr": 0.5, "passed": False}
    with pytest.raises(ValueError):
        search.evaluate_cases(spark, index, [{"name": "x", "query": "y", "expected": []}])


def test_adapters(spark, tmp_path):
    chunks = tables(spark)[0].withColumns({"is_current": F.col("version_id") == "V2", "text_for_embedding": F.col("text")})
    assert search.public_rows(chunks).count() == 1 and search.public_rows(chunks, False).count() == 4
    got = search.adapter_search(spark, chunks, "새 사항", f"file://{tmp_path}/a").collect()
    assert [(r.chunk_id, r.snippet) for r in got] == [("c2", "제1조(목적) 휴학에 관한 [새] [사항]")]
    assert '"title":"휴학 규정"' in search.vector_rows(chunks).first().payload
