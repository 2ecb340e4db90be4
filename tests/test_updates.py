"""Versions, documents, batches, the gate, checks and streams on fixtures."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lawloom.operators import catalog, documents, updates, validate, versions
from lawloom.operators.numbering import row_numbers
from lawloom.streaming import batches

V = "version_id string, document_id string, revision_date string, effective_date string, sha256 string, is_current boolean, current_status string, source_file string, next_version_id string"
SHA = {k: hashlib.sha256(k.encode()).hexdigest() for k in "abcdefgh"}


def some_versions(spark):
    rows = [
        ("v1", "D1", "2019-01-01", None, SHA["a"], True, "confirmed", "f/a.hwp", "gone"), ("v2", "D1", "2021-01-01", None, SHA["b"], True, "confirmed", "f/b.hwp", None), ("v3", "D1", None, None, SHA["c"], False, "historical", "f/c.hwp", None),
        ("v4", "D2", "2020-01-01", None, SHA["d"], True, "confirmed", "f/신구 조문.hwp", None), ("v5", "D2", "2018-01-01", "2022-05-05", SHA["e"], None, "unknown", "f/e.hwp", None), ("v6", "D3", "", "2022-05-05", SHA["f"], False, "candidate", "f/f.hwp", None),
    ]
    return spark.createDataFrame(rows, V)


def some_documents(spark):
    rows = [("D1", "갑 규정", "regulation", "v3", True, "confirmed", ["옛"], "VG-1", "과"), ("D2", "을 지침", "guideline", "zz", None, "unknown", None, "VG-2", None), ("D3", "병", "guideline", None, None, "unknown", None, "VG-3", None)]
    return spark.createDataFrame(rows, "document_id string, title string, document_type string, latest_version_id string, is_current boolean, current_status string, alternative_titles array<string>, version_group_id string, department string")


def test_build_versions(spark):
    v, d = versions.build_versions(some_versions(spark), some_documents(spark))
    got = {r.version_id: r for r in v.collect()}
    assert [(got[k].previous_version_id, got[k].next_version_id) for k in ("v3", "v1", "v2")] == [(None, "v1"), ("v3", "v2"), ("v1", None)]
    assert [(got[k].is_current, got[k].current_status) for k in ("v1", "v2", "v3", "v6")] == [(None, "unknown"), (None, "unknown"), (False, "historical"), (False, "candidate")]
    docs = {r.document_id: r for r in d.collect()}
    assert [(docs[k].latest_version_id, docs[k].is_current) for k in ("D1", "D2", "D3")] == [("v3", None), ("v4", True), ("v6", None)]
    assert {k for k, r in got.items() if r.is_latest_version} == {"v3", "v4", "v6"} and got["v1"].source_url_quality == "unknown"
    c = versions.conflict_rows(some_versions(spark)).collect()
    assert [(r.conflict_id, r.source_path_1, r.source_path_2) for r in c] == [(f"CUR-{SHA['a'][:6]}-{SHA['b'][:6]}", "f/a.hwp", "f/b.hwp")]
    assert {r.document_id: r.predecessor_id for r in versions.predecessors(some_versions(spark)).collect()} == {"D1": "v2", "D2": "v4", "D3": "v6"}
    assert {r.document_id: r.predecessor_id for r in versions.predecessors(some_versions(spark), True).collect()}["D2"] == "v5"


def test_synced_markdown(spark):
    md = lambda cur, st: f"---\ntitle: x\nis_current: {cur}\ncurrent_status: {st}\n---\nbody is_current: 1\n"
    texts = spark.createDataFrame([("v1", md("true", '"confirmed"')), ("v3", md("true", '"unknown"')), ("v2", "no front")], "version_id string, text string")
    got = {r.version_id: r for r in versions.synced_markdown(texts, some_versions(spark)).collect()}
    assert not got["v1"].changed and got["v3"].text == md("false", '"historical"') and got["v3"].sha256 == hashlib.sha256(got["v3"].text.encode()).hexdigest() and got["v2"].text == "no front"


def record(**more):
    r = {"source_id": "s", "source_record_id": "r 1", "document_id": "D1", "document_type": "regulation", "title": "갑 규정", "department": None, "revision_date": "2024-01-01", "effective_date": None, "previous_version_id": None, "attachment_filename": "f%20x.hwp", "downloaded_filename": None, "source_page_url": "p", "attachment_url": "u", "file_size": 10, "sha256": SHA["g"], "previous_title": None, "title_change_evidence": None, "captured_at": "2024-02-02", "application_note": None}
    return r | more


def batch(spark, *rows):
    kinds = {"file_size": "long"}
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in rows[0]))


CASES = [
    (record(), None), (record(document_type="", sha256=None), "missing:document_type,sha256"), (record(revision_date="", effective_date=None), "no_date"), (record(document_id="D9"), "unknown_document"), (record(title="새"), None),
    (record(previous_title="갑 규정", title="새", title_change_evidence="1쪽"), None), (record(previous_title="갑 규정", title="새"), "title_change_without_evidence"), (record(previous_title="다른", title="새", title_change_evidence="1쪽"), "title_change_without_evidence"), (record(previous_title="갑 규정", title_change_evidence="1쪽"), "title_change_without_evidence"),
    (record(previous_version_id="v1"), "stale_predecessor"), (record(previous_version_id="v2"), None), (record(attachment_filename="none.hwp", sha256="0" * 64), "file_not_found"), (record(attachment_filename="none.hwp"), None), (record(sha256=SHA["h"]), "hash_mismatch"), (record(file_size=9), "size_mismatch"),
    (record(attachment_filename="a.hwp", sha256=SHA["a"], file_size=1), "hash_owned"), (record(revision_date=None, effective_date="2024-03-03", downloaded_filename="f x.hwp"), None),
]


@pytest.mark.parametrize("number", range(len(CASES)))
def test_batch_cases(spark, number):
    row, want = CASES[number]
    files = spark.createDataFrame([("f x.hwp", SHA["g"], 10), ("a.hwp", SHA["a"], 1)], "file_name string, actual_sha256 string, actual_size long")
    got = updates.validate_batch(batch(spark, row), some_documents(spark), some_versions(spark), files).first()
    assert got.error_code == want
    if want is None:
        assert got.new_version_id == f"VER-{(row['revision_date'] or row['effective_date']).replace('-', '')}-{SHA['g'][:8]}" and got.archive_file.startswith("sources/raw/regulations/official/s/r_1/") and got.found_name == "f x.hwp"


def test_apply(spark):
    files = spark.createDataFrame([("f x.hwp", SHA["g"], 10), ("y.hwp", SHA["h"], 5)], "file_name string, actual_sha256 string, actual_size long")
    b = batch(spark, record(previous_title="갑 규정", title="새 규정", title_change_evidence="1쪽", department="새과"), record(document_id="D1", revision_date="2025-01-01", attachment_filename="y.hwp", sha256=SHA["h"], file_size=5, title="새 규정"))
    ok = updates.validate_batch(b, some_documents(spark), some_versions(spark), files)
    assert updates.refused(ok).first().asDict() == {"records": 2, "errors": 0, "refused": False} and updates.refused(ok.limit(0)).first().refused
    manifest = spark.createDataFrame([("f/a.hwp", SHA["a"])], "archive_file string, sha256 string")
    d, v, m = updates.apply_batch(ok, some_documents(spark), some_versions(spark), manifest, "2025-02-02")
    one, two = f"VER-20240101-{SHA['g'][:8]}", f"VER-20250101-{SHA['h'][:8]}"
    got = {r.version_id: r for r in v.collect()}
    assert len(got) == 8 and [got[k].is_current for k in ("v1", "v2", one, two, "v4")] == [False, False, False, True, True] and [got[k].current_status for k in ("v1", one, two)] == ["historical", "historical", "confirmed"]
    assert (got["v2"].next_version_id, got[one].previous_version_id, got[one].next_version_id, got[two].previous_version_id) == (one, "v2", two, one) and got["v1"].next_version_id == "gone"
    assert (got[one].title_change_evidence, got[one].previous_title, got[one].department, got[two].title, got[two].text_extraction_status, got[one].version_group_id) == ("1쪽", "갑 규정", "새과", "새 규정", "pending_portable_hwp", "VG-1")
    doc = {r.document_id: r for r in d.collect()}["D1"]
    assert (doc.title, doc.alternative_titles, doc.latest_version_id, doc.is_current, doc.sha256, doc.original_filename, doc.updated_at, doc.revision_date) == ("새 규정", ["옛", "갑 규정"], two, True, SHA["h"], "y.hwp", "2025-02-02", "2025-01-01")
    assert {(r.archive_file, r.origin_type, r.collected_at) for r in m.collect()} == {("f/a.hwp", None, None), ("sources/raw/regulations/official/s/r_1/f%20x.hwp", "official_web", "2024-02-02"), ("sources/raw/regulations/official/s/r_1/y.hwp", "official_web", "2024-02-02")}
    again = updates.validate_batch(b.drop("previous_title"), d, v, files)
    assert [r.already_present for r in again.collect()] == [True, True]
    d2, v2, m2 = updates.apply_batch(again, d, v, m, "2026-01-01")
    assert v2.select(v.columns).exceptAll(v).isEmpty() and v2.count() == 8 and m2.count() == 3 and d2.select(d.columns).exceptAll(d).isEmpty()


def test_reconcile(spark):
    v = spark.createDataFrame([("D1", "기금 위원회 운영 지침", "2021-06-01", "2021-07-01", SHA["a"]), ("D2", "기금위원회 운영지침", None, None, SHA["b"])], "document_id string, title string, revision_date string, effective_date string, sha256 string")
    r = [("갑대학교 기금 위원회 운영 지침 일부개정(2026.8.20., 지침 제8호)", "2026-08-20", None, "a.hwp"), ("기금위원회 운영지침", "2021-07-01", None, None), ("기금위원회 운영지침", "2026-01-01", SHA["a"], None), ("딴 것", "2021-06-01", None, None), ("기금위원회 운영지침", None, SHA["a"], "개정사유.hwp"), ("", None, None, None)]
    got = updates.reconcile(spark.createDataFrame([(i, *x) for i, x in enumerate(r)], "i int, title string, effective_date string, sha256 string, attachment_filename string"), v, r"갑\s*대학교").orderBy("i").collect()
    assert [x.comparison_status for x in got] == ["new_version_candidate", "present_metadata", "present_hash", "new_document_candidate", "supporting_attachment", "new_document_candidate"]
    assert [x.matched_document_ids for x in got] == [["D1", "D2"], ["D1", "D2"], [], [], [], []]


def test_gate(spark):
    v = some_versions(spark).where("version_id in ('v1', 'v2', 'v4')").withColumns({"normalized_file": F.when(F.col("version_id") != "v4", F.concat(F.lit("n/"), "version_id")), "portable_conversion_status": F.lit("success"), "portable_extraction_tool": F.lit("t"), "portable_extraction_version": F.lit("1"), "portable_markdown_sha256": F.lit("m"), "portable_text_chars": F.lit(200), "portable_hangul_chars": F.when(F.col("version_id") == "v2", 79).otherwise(80), "portable_hangul_ratio": F.lit(0.15), "portable_replacement_chars": F.lit(0), "pdf_conversion_status": F.when(F.col("version_id") == "v4", "success"), "pdf_relative_path": F.lit("p"), "pdf_sha256": F.lit("q"), "pdf_pages": F.lit(3)})
    b = spark.createDataFrame([("v1", SHA["a"]), ("v2", SHA["b"]), ("v4", SHA["d"]), ("v9", "x")], "version_id string, sha256 string")
    files = lambda *rows: spark.createDataFrame(list(rows), "path string, sha256 string")
    g = updates.gate(b, v, files(("f/a.hwp", SHA["a"]), ("f/b.hwp", "other"), ("f/신구 조문.hwp", SHA["d"])), files(("n/v1", "m"), ("n/v2", "m")), files(("p", "q")), "t", "1")
    assert {r.version_id: r.failed for r in g.collect()} == {"v1": [], "v2": ["source_sha256", "derivative_complete"], "v4": ["normalized"], "v9": ["metadata_sha256", "source_sha256", "current", "normalized", "derivative_complete"]}


def test_normalize(spark):
    c = "ordinal int, document_type string, title string, department string, sha256 string, revision_date string, is_current boolean, metadata_confidence string, file_extension string, enactment_date string, effective_date string, source_page_url string, original_url string"
    rows = [
        (1, "regulation", "갑 규정", "A", SHA["a"], "2020-01-01", False, "high", ".hwp", None, None, None, None), (2, "regulation", "갑 규정(2021 개정)", None, SHA["b"], "2021-01-01", True, "high", ".PDF", None, None, None, None), (3, "regulation", "갑-규정", "A", SHA["c"], None, None, "high", ".hwp", None, None, None, None),
        (4, "rule", "을", "A", SHA["d"], None, True, "high", ".hwp", None, None, None, None), (5, "rule", "을", "B", SHA["e"], None, True, "high", ".hwp", None, None, None, None), (6, "rule", "을", "", SHA["f"], None, None, "high", ".hwp", None, None, None, None), (7, "rule", "병", "B", SHA["g"], None, None, "low", ".hwp", None, None, None, None), (8, "rule", "정", "B", SHA["h"], None, None, "high", ".txt", None, None, None, None),
    ]
    cand = spark.createDataFrame(rows, c)
    manifest = spark.createDataFrame([(i, s, f"raw/{i}") for i, s in enumerate([*SHA.values(), SHA["a"]])], "ordinal int, sha256 string, archive_file string")
    extraction = spark.createDataFrame([(1, SHA["b"], "failed", None), (2, SHA["b"], "success", "t/b"), (3, SHA["a"], "success", "")], "ordinal int, sha256 string, status string, text_file string")
    d, v = documents.normalize(cand, manifest, extraction)
    docs = {r.title + "|" + (r.department or ""): r for r in d.collect()}
    assert set(docs) == {"갑 규정(2021 개정)|", "을|A", "을|B", "을|"}
    a = docs["갑 규정(2021 개정)|"]
    assert a.document_id == "REG-" + hashlib.sha256("regulation:갑규정:".encode()).hexdigest()[:12] and a.alternative_titles == ["갑 규정", "갑-규정"] and a.current_status == "confirmed" and a.latest_version_id == f"VER-20210101-{SHA['b'][:8]}"
    vers = {r.sha256: r for r in v.collect()}
    assert vers[SHA["b"]].normalized_file == f"corpus/normalized/regulations/{a.document_id}/{a.latest_version_id}.md" and vers[SHA["a"]].normalized_file is None and vers[SHA["a"]].source_file == "raw/0"
    assert (vers[SHA["c"]].text_extraction_status, vers[SHA["b"]].text_extraction_status, vers[SHA["c"]].current_status, vers[SHA["c"]].authority_level) == ("unsupported", "success", "unknown", "university_rule") and len(vers) == 6
    assert documents.with_source(cand, manifest.where("ordinal < 2")).count() == 2
    md = v.where(F.col("sha256") == SHA["b"]).select(documents.version_markdown({c: F.col(c) if c in v.columns else F.lit(None).cast("string") for c in ("document_id", "version_id", "document_type", "title", "is_current", "current_status", "enactment_date", "revision_date", "effective_date", "department", "source_url", "source_file", "sha256")}, F.lit("학교"), F.lit(" 글\n")).alias("t")).first().t
    assert md.startswith('---\ndocument_id: "REG-') and "\nis_current: true\n" in md and md.endswith("\n---\n\n# 갑 규정(2021 개정)\n글\n") and 'issuing_organization: "학교"' in md


def test_migration_and_legacy(spark):
    rows = spark.createDataFrame([("regulation", "L1", "data/raw/regulations/a.hwp", None), ("rule", "L2", None, [("x/data/raw/guidelines/b.hwp",), ("c.hwp",), ("gone.hwp",)])], "document_type string, document_id string, archive_relative_path string, source_occurrences array<struct<archive_relative_path:string>>")
    files = spark.createDataFrame([("data/raw/regulations/a.hwp", SHA["a"], 1), ("x/data/raw/guidelines/b.hwp", SHA["b"], 2), ("c.hwp", SHA["c"], 3)], "path string, sha256 string, length long")
    found = spark.createDataFrame([(SHA["c"], ["k1", "k2"])], "sha256 string, reasons array<string>")
    there = spark.createDataFrame([("sources/raw/regulations/a.hwp", SHA["a"]), ("sources/raw/guidelines/b.hwp", "old")], "path string, sha256 string")
    m, x, missing = documents.migration_plan(rows, files, found, there, True)
    assert {(r.archive_file, r.status, r.hash_verified, r.legacy_document_id) for r in m.collect()} == {("sources/raw/regulations/a.hwp", "reused", True, "L1"), ("sources/raw/guidelines/b.hwp", "copied", True, "L2")}
    assert [tuple(r) for r in x.collect()] == [("c.hwp", SHA["c"], "k1;k2", "review_required")] and [r[0] for r in missing.collect()] == ["gone.hwp"]
    meta = [("regulation", 1, json.dumps({"regulation_id": "R", "attachments": [{"sha256": "h1"}, {"sha256": ""}, {"sha256": "h2"}]})), ("guideline", 2, json.dumps({"guideline_id": "G", "attachments": [{"sha256": "h2", "version_status": "active"}, {"sha256": "h3", "version_status": "old"}]})), ("regulation", 3, "broken"), ("regulation", 4, json.dumps({"regulation_id": "none", "attachments": [{"sha256": "h4"}]}))]
    texts = spark.createDataFrame([("regulation", "R", "r.md"), ("guideline", "G", "g.md")], "kind string, key string, path string")
    got = documents.legacy_texts(spark.createDataFrame(meta, "kind string, ordinal int, json string"), texts)
    assert {r.sha256: r.path for r in got.collect()} == {"h1": "r.md", "h2": "g.md"}


def test_derivatives(spark):
    v = some_versions(spark).withColumns({"document_type": F.lit("regulation"), "normalized_file": F.when(F.col("version_id") == "v2", "n/v2"), "text_extraction_status": F.lit("unsupported")})
    manifest = spark.createDataFrame([("v1", "converted", "p/1", "s1"), ("v2", "reused", "p/2", "s2"), ("v4", "converted", "p/4", "s4"), ("v5", "converted", "p/5", "s5"), ("v6", "failed", "p/6", "s6")], "version_id string, status string, pdf_file string, pdf_sha256 string")
    pages = spark.createDataFrame([("v1", 2, "둘"), ("v1", 1, " 하나 "), ("v1", 3, " "), ("v2", 1, "x"), ("v4", 1, None)], "version_id string, page int, text string")
    a, d = documents.index_derivatives(v, some_documents(spark), manifest, pages, "now")
    got = {r.version_id: r for r in a.collect()}
    assert (got["v1"].pdf_pages, got["v1"].pdf_text_chars, got["v1"].text_extraction_status, got["v1"].normalized_file) == (3, 3, "success_from_pdf", "corpus/normalized/regulations/D1/v1.md")
    assert (got["v2"].text_extraction_status, got["v4"].text_extraction_status, got["v5"].pdf_conversion_status, got["v6"].pdf_conversion_status, got["v2"].pdf_conversion_status) == ("unsupported", "needs_ocr", "failed_validation", None, "success")
    assert documents.pdf_totals(pages).where("version_id = 'v1'").first().body == "<!-- page: 1 -->\n\n하나\n\n<!-- page: 2 -->\n\n둘\n"
    assert {r.document_id: (r.pdf_relative_path, r.pdf_conversion_status) for r in d.collect()} == {"D1": (None, "available_for_versions"), "D2": (None, "available_for_versions"), "D3": (None, None)}
    part = lambda *rows: spark.createDataFrame(list(rows), "version_id string, status string, ordinal int")
    last = documents.last_manifest([part(("a", "1", 1), ("b", "1", 1)), part(("a", "2", 1), ("a", "3", 2))], part(("b", "4", 1)))
    assert {r.version_id: r.status for r in last.collect()} == {"a": "3", "b": "4"}


def test_convert(spark):
    good = "제1조(목적) 갑 규정은 " + "가나다라마바사아자차 " * 30
    v = spark.createDataFrame([(f"v{i}", "D1", "regulation", "갑 규정", f"f/{i}", SHA["a"], "success" if i == 5 else None, SHA["b"] if i == 5 else None) for i in range(1, 8)], "version_id string, document_id string, document_type string, title string, source_file string, sha256 string, portable_conversion_status string, portable_markdown_sha256 string")
    raw = spark.createDataFrame([(f"f/{i}", SHA["a"] if i != 3 else "x") for i in range(1, 7)], "path string, sha256 string")
    bodies = spark.createDataFrame([("v1", good + " \r\n끝"), ("v2", "짧다 �"), ("v3", good), ("v4", None), ("v6", good)], "version_id string, body string")
    at = "corpus/normalized/regulations/D1/v{}.md"
    there = spark.createDataFrame([(at.format(5), good, SHA["b"]), (at.format(6), good, SHA["b"])], "path string, text string, sha256 string")
    rec = spark.createDataFrame([(f"v{i}", SHA["a"]) for i in range(1, 9)], "version_id string, sha256 string")
    got = {r.version_id: r for r in documents.convert(rec, v, some_documents(spark), raw, bodies, there).collect()}
    assert {k: r.outcome for k, r in got.items()} == {"v1": "converted", "v2": "failed", "v3": "failed", "v4": "failed", "v5": "reused", "v6": "force_required", "v7": "failed", "v8": "failed"}
    assert got["v1"].errors == [] and got["v1"].text.endswith("\n끝\n") and len(got["v2"].errors) == 4 and got["v3"].errors == ["HWP SHA-256 불일치"] and got["v7"].errors == ["HWP 원본 없음"] and got["v8"].errors == ["versions.jsonl에 없음"] and got["v1"].article_count == 1
    assert {r.outcome for r in documents.convert(rec.where("version_id = 'v6'"), v, some_documents(spark), raw, bodies, there, force=True).collect()} == {"converted"}


def test_cycles(spark):
    links = lambda *pairs: spark.createDataFrame([(a, b) for a, b in pairs], "version_id string, next_version_id string")
    chain = [(f"n{i}", f"n{i + 1}") for i in range(40)]
    assert validate.chain_cycles(links(*chain, ("n40", None), ("x", "missing"), ("y", ""))).count() == 0
    got = validate.chain_cycles(links(*chain, ("n40", "n37"), ("a", "a"), ("b", "c"), ("c", "b"), ("d", "b"), ("e", None)))
    assert {r.version_id for r in got.collect()} == {f"n{i}" for i in range(41)} | {"a", "b", "c", "d"}
    assert validate.chain_cycles(links(("a", None)).limit(0)).count() == 0


def test_checks(spark):
    sha, gid = "0" * 64, "REG-" + "0" * 12
    doc = spark.createDataFrame([(gid, "regulation", "t", "public", "VG", sha, "VER-1-00000000", True)], "document_id string, document_type string, title string, access_level string, version_group_id string, sha256 string, latest_version_id string, is_current boolean")
    ver = spark.createDataFrame([("VER-1-00000000", gid, "VG", "f/a.hwp", sha, "confirmed", "public", True, "n/a.md", None, None, True, "unknown", "unknown", "detail", "t")], "version_id string, document_id string, version_group_id string, source_file string, sha256 string, current_status string, access_level string, is_current boolean, normalized_file string, previous_version_id string, next_version_id string, is_latest_version boolean, validity_status string, status_confidence string, source_url_quality string, title string")
    portable = {"portable_conversion_status": F.lit("success"), "portable_extraction_tool": F.lit("t"), "portable_extraction_version": F.lit("1"), "portable_markdown_sha256": F.lit("m"), "portable_text_chars": F.lit(300), "portable_hangul_chars": F.lit(90), "portable_hangul_ratio": F.lit(0.2), "portable_replacement_chars": F.lit(0)}
    ver = ver.withColumns(portable)
    chunk = spark.createDataFrame([("CHK-000001", gid, "VER-1-00000000", "x", "y", 5, "f/a.hwp", sha, "c", "public", "t")], "chunk_id string, document_id string, version_id string, text string, text_for_embedding string, token_count int, source_file string, sha256 string, citation_label string, access_level string, title string")
    man = spark.createDataFrame([("f/a.hwp", "src/a", sha, 3, "copied", "public", "legacy_archive")], "archive_file string, source_file string, sha256 string, file_size long, status string, access_level string, origin_type string")
    files = spark.createDataFrame([("f/a.hwp", sha), ("n/a.md", "m")], "path string, sha256 string")
    front = f'---\ndocument_id: "{gid}"\nversion_id: "VER-1-00000000"\ntitle: t\nsha256: "{sha}"\nis_current: true\ncurrent_status: confirmed\n---\nx'
    texts = spark.createDataFrame([("n/a.md", front)], "normalized_file string, text string")
    corpus = catalog.corpus_manifest(doc, ver, chunk).withColumn("sha256", F.struct(F.lit("a").alias("documents"), F.lit("b").alias("chunks")))
    archive = spark.createDataFrame([("src/a", sha)], "path string, sha256 string")
    everything = dict(manifest=man, files=files, texts=texts, archive=archive, subsets={"current_documents": doc, "latest_documents": doc, "document_catalog": doc}, corpus=corpus, export=chunk.limit(0), tool="t")
    good = validate.validate(doc, ver, chunk, **everything)
    states = {r.check: (r.status, r.failures) for r in good.collect()}
    assert len(states) == 27 and states.pop("export_up_to_date") == ("WARNING", 1) and set(states.values()) == {("PASS", 0)}, states
    assert validate.status_counts(good).first().accepted
    bad = {
        "raw_copy_hash": dict(files=files.withColumn("sha256", F.lit("x"))), "source_archive_unchanged": dict(archive=archive.limit(0)), "document_id_unique": dict(documents=doc.union(doc)), "chunk_source_known": dict(chunks=chunk.withColumn("version_id", F.lit("q"))),
        "version_in_manifest": dict(manifest=man.withColumn("sha256", F.lit("1" * 64))), "latest_belongs_to_document": dict(documents=doc.withColumn("latest_version_id", F.lit(None).cast("string"))), "files_exist": dict(files=files.where("path <> 'n/a.md'")), "derivatives_complete": dict(versions=ver.withColumn("portable_hangul_chars", F.lit(10))),
        "chunk_not_empty": dict(chunks=chunk.withColumn("text", F.lit(" 　"))), "chunk_within_limit": dict(chunks=chunk.withColumn("token_count", F.lit(1201))), "chunk_public": dict(chunks=chunk.withColumn("access_level", F.lit("internal"))), "chunk_citable": dict(chunks=chunk.withColumn("title", F.lit(""))),
        "shapes": dict(documents=doc.withColumn("document_type", F.lit("poem"))), "current_documents_equal": dict(subsets={**everything["subsets"], "current_documents": doc.limit(0)}), "manifest_counts": dict(corpus=corpus.withColumn("chunks", F.lit(9).cast("long"))), "status_fields_present": dict(versions=ver.drop("validity_status")),
        "front_matter": dict(texts=texts.withColumn("text", F.lit("none"))), "duplicate_export": dict(export=chunk), "version_has_text": dict(versions=ver.withColumn("normalized_file", F.lit(None).cast("string"))), "single_current_version": dict(versions=ver.union(ver.withColumn("version_id", F.lit("VER-2-00000000")))),
        "version_links_symmetric": dict(versions=ver.withColumn("next_version_id", F.lit("zz"))), "version_chain_acyclic": dict(versions=ver.withColumn("next_version_id", F.col("version_id"))),
    }
    for name, change in bad.items():
        args = {"documents": doc, "versions": ver, "chunks": chunk, **everything, **change}
        got = validate.validate(**args).where(F.col("check") == name).first()
        assert got.status in ("FAIL", "WARNING") and got.failures >= 1, name
    errors = validate.front_matter_errors(ver, texts.withColumn("text", F.regexp_replace("text", "title: t", "title: u")))
    assert [(r.version_id, r.error) for r in errors.collect()] == [("VER-1-00000000", "title")]
    assert validate.table_difference(doc, doc.withColumn("title", F.lit(None).cast("string"))).count() == 2


def test_numbers(spark):
    df = spark.range(5000).withColumns({"g": F.when(F.col("id") % 3 > 0, F.col("id") % 3), "k": F.hash("id") % 50}).repartition(7)
    got = row_numbers(df, ["g"], ["k", "id"], "n").toPandas()
    want = got.sort_values(["k", "id"]).groupby("g", dropna=False).cumcount() + 1
    assert (got["n"] == want.reindex(got.index)).all() and len(got) == 5000 and row_numbers(df.limit(0), ["g"], ["id"]).count() == 0
    digest = catalog.table_digest(df, "id").first()
    assert digest == catalog.table_digest(df.repartition(3), "id").first() and digest.rows == 5000 and digest != catalog.table_digest(df.withColumn("k", F.lit(0)), "id").first()


def test_streams(spark, tmp_path):
    p = f"file://{tmp_path}"

    def drop(folder, name, *rows):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))

    def records(name="known", folder="in"):
        q = batches.new_records(spark, f"{p}/{folder}", "k string, o int, v string", ["k"], ["o"], f"{p}/{name}", f"{p}/cp-{name}")
        q.awaitTermination()
        assert q.exception() is None
        return sorted((r.k or "", r.o, r.v) for r in batches.known_records(spark, f"{p}/{name}", ["k"], ["o"]).collect())

    drop("in", "1.json", {"k": "a", "o": 5, "v": "x"}, {"k": "a", "o": 7, "v": "w"}, {"k": None, "o": 2, "v": "n"})
    assert records() == [("", 2, "n"), ("a", 5, "x")]
    drop("in", "2.json", {"k": "a", "o": 9, "v": "y"}, {"k": "b", "o": 3, "v": "z"}, {"k": "b", "o": 3, "v": "q"}, {"k": None, "o": 1, "v": "m"})
    want = [("", 1, "m"), ("a", 5, "x"), ("b", 3, "q")]
    assert records() == want and records() == want
    assert records("at-once") == want  # both files in one batch
    drop("other", "2.json", *map(json.loads, (tmp_path / "in/2.json").read_text().splitlines()))
    records("turned", "other")
    drop("other", "1.json", *map(json.loads, (tmp_path / "in/1.json").read_text().splitlines()))
    assert records("turned", "other") == want  # in another order

    schema = "version_id string, document_id string, title string, document_type string, text string, revision_date string, access_level string, normalized_file string, sha256 string"
    one = lambda i, text: dict(version_id=f"v{i}", document_id="D", title="t", document_type="rule", text=text, revision_date=f"202{i}-01-01", access_level="public", normalized_file="n", sha256=str(i))
    drop("v", "1.json", one(1, "제1조 가"), one(3, "제1조 나"))
    for _ in range(2):
        batches.chunk_new_versions(spark, f"{p}/v", schema, f"{p}/chunks", f"{p}/cp2").awaitTermination()
        batches.relink_versions(spark, f"{p}/v", schema, f"{p}/vs", f"{p}/links", f"{p}/cp3").awaitTermination()
    drop("v", "2.json", one(2, "제1조 다\n제2조 라"), one(1, "제1조 바뀜"))
    batches.chunk_new_versions(spark, f"{p}/v", schema, f"{p}/chunks", f"{p}/cp2").awaitTermination()
    batches.relink_versions(spark, f"{p}/v", schema, f"{p}/vs", f"{p}/links", f"{p}/cp3").awaitTermination()
    assert sorted((r.version_id, r.text) for r in spark.read.parquet(f"{p}/chunks").collect()) == [("v1", "제1조 가"), ("v2", "제1조 다"), ("v2", "제2조 라"), ("v3", "제1조 나")]
    links = {r.version_id: (r.previous_version_id, r.next_version_id) for r in batches.current_links(spark, f"{p}/links").collect()}
    assert links == {"v1": (None, "v2"), "v2": ("v1", "v3"), "v3": ("v2", None)}
    others = spark.createDataFrame([(f"w{i}", f"E{i}") for i in range(400)], "version_id string, document_id string").withColumn("bucket", batches._bucket(F.col("document_id")))
    others.write.mode("append").partitionBy("bucket").parquet(f"{p}/vs/batch=99")
    found = batches.touched_versions(spark, f"{p}/vs", spark.createDataFrame([("D",)], "document_id string"))
    assert {r.version_id for r in found.collect()} == {"v1", "v2", "v3"}
    assert "PartitionFilters: [isnotnull(bucket" in found._jdf.queryExecution().toString()  # folders of other documents are not opened
