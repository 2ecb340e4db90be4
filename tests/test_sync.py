"""A corpus built from candidates, then a reviewed batch through the gate."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lawloom.plans import sync
from lawloom.sources import snapshots

BODY = "{0} 규정\n\n제1조(목적) {0} 규정은 " + "가나다라마바사아자차 " * 30 + "\n\n제2조(정의) {0} 용어의 뜻은 다음과 같다."
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def corpus(spark):
    c = "ordinal int, document_type string, title string, department string, sha256 string, revision_date string, is_current boolean, metadata_confidence string, file_extension string, enactment_date string, effective_date string, source_page_url string"
    rows = [(1, "regulation", "갑 규정", None, sha("a"), "2020-01-01", True, "high", ".hwp", None, None, "http://x/view"), (2, "regulation", "을 규정", None, sha("b"), "2021-01-01", True, "high", ".hwp", None, None, None), (3, "regulation", "병 규정", None, sha("c"), "2021-01-01", True, "high", ".hwp", None, None, None)]
    manifest = spark.createDataFrame([(i, x[4], f"raw/{i}.hwp", 10, "copied", "public") for i, x in enumerate(rows)], "ordinal int, sha256 string, archive_file string, file_size long, status string, access_level string")
    extraction = spark.createDataFrame([(1, x[4], "success", "t") for x in rows], "ordinal int, sha256 string, status string, text_file string")
    bodies = spark.createDataFrame([(sha("a"), BODY.format("갑")), (sha("b"), BODY.format("을")), (sha("c"), BODY.format("병") + " 010-1234-5678")], "sha256 string, body string")
    return sync.full_sync(spark, spark.createDataFrame(rows, c), manifest, extraction, bodies, cases(spark, "갑", sha("a"), "20200101"))


def cases(spark, name, digest, date):
    doc = "REG-" + sha(f"regulation:{name}규정:")[:12]
    return [{"name": "x", "query": f"{name} 용어", "filters": {}, "expected": [{"document_id": doc, "version_id": f"VER-{date}-{digest[:8]}"}]}]


def test_full(corpus):
    c, checks = corpus
    assert {r.title for r in c.documents.collect()} == {"갑 규정", "을 규정"} and c.chunks.count() == 6
    assert {r.section_kind for r in c.chunks.collect()} == {"operative_text", "unknown"}
    assert checks.where("status = 'FAIL'").isEmpty() and "front_matter" in {r.check for r in checks.collect()}


def record(**more):
    doc = "REG-" + sha("regulation:갑규정:")[:12]
    r = {"source_id": "s", "source_record_id": "r", "document_id": doc, "document_type": "regulation", "title": "갑 규정", "revision_date": "2024-01-01", "attachment_filename": "f.hwp", "source_page_url": "http://x/view?1", "attachment_url": "u", "file_size": 10, "sha256": sha("n"), "previous_version_id": f"VER-20200101-{sha('a')[:8]}"}
    return r | more


def batch(spark, **more):
    r = record(**more)
    return spark.createDataFrame([tuple(r.values())], ", ".join(f"{k} {'long' if k == 'file_size' else 'string'}" for k in r))


def test_gate(spark, corpus):
    c = corpus[0]
    files = spark.createDataFrame([("f.hwp", sha("n"), 10)], "file_name string, actual_sha256 string, actual_size long")
    convert = lambda v: v.select("version_id", F.lit(BODY.format("갑") + "\n\n제3조(신설) 새 조문이다.").alias("body"))
    after, gate = sync.update_gate(spark, c, batch(spark), files, convert, cases(spark, "갑", sha("n"), "20240101"), "2024-02-02", "t", "1")
    new, old = f"VER-20240101-{sha('n')[:8]}", f"VER-20200101-{sha('a')[:8]}"
    assert [(r.version_id, r.failed, r.portable_markdown_complete) for r in gate.collect()] == [(new, [], True)]
    v = {r.version_id: r for r in after.versions.collect()}
    assert (v[old].is_current, v[old].next_version_id, v[new].previous_version_id, v[new].is_latest_version) == (False, new, old, True)
    kept = {r.chunk_id: r.text for r in c.chunks.collect()}
    got = {r.chunk_id: r.text for r in after.chunks.collect()}
    assert kept.items() <= got.items() and len(got) == len(kept) + 4
    with pytest.raises(RuntimeError, match="stale_predecessor"):
        sync.update_gate(spark, after, batch(spark, sha256=sha("m"), revision_date="2025-01-01"), files, convert, [], "x", "t", "1")
    with pytest.raises(RuntimeError, match="conversion refused"):
        sync.update_gate(spark, c, batch(spark), files, lambda v: v.select("version_id", F.lit("짧다").alias("body")), [], "x", "t", "1")
    with pytest.raises(RuntimeError, match="evaluation"):
        sync.update_gate(spark, c, batch(spark), files, convert, cases(spark, "을", sha("n"), "20240101"), "2024-02-02", "t", "1")


def test_published_together(spark, tmp_path):
    """Five tables change in one step; a second writer from the same state is refused; a writer that stops half way changes nothing."""
    path = f"file://{tmp_path}/corpus"
    table = lambda name, n: spark.createDataFrame([(f"{name}{i}",) for i in range(n)], "id string")
    corpus = lambda n: sync.Corpus(*[table(t, n) for t in sync.TABLES])
    assert sync.publish(spark, path, corpus(2)) == 1
    assert sync.publish(spark, path, corpus(3), 1) == 2
    with pytest.raises(snapshots.Conflict):
        sync.publish(spark, path, corpus(9), 1)
    broken = corpus(7)
    broken.texts = broken.texts.withColumn("id", F.raise_error(F.lit("stopped")))
    with pytest.raises(Exception, match="stopped"):
        sync.publish(spark, path, broken)
    for number, n in ((None, 3), (1, 2)):
        got = sync.published(spark, path, number)
        assert [getattr(got, t).count() for t in sync.TABLES] == [n] * 5
