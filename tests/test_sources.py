"""Readers, page parsers, crawls and writers."""

import csv
import io
import json
import sys
import zipfile
from email.message import Message
from urllib.error import URLError

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lawloom.operators import catalog, updates
from lawloom.sources import crawl, html, sinks, tables

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks make clients of this module

PAGE = "https://site.example/rules"
LIST = """<table><caption>Rules in force</caption><tbody>
 <tr><th>No</th><th>Name</th><th>Office</th><th>Day</th><th>File</th></tr>
 <tr><td>3</td><td><a href="/rule?id=31">Library rule (rev. 2024.3.1.)</a></td><td>Library</td><td>2024-03-05</td><td></td></tr>
 <tr><td>2</td><td>Parking rule</td><td></td><td>2023-01-02</td><td><a href="get?f=22&amp;n=1">parking.pdf ( 12 kb)</a></td></tr>
 <tr><td>1</td><td><form action="/open"><input name="id" value="11"><input type="submit" value="Garden rule"></form></td><td>Works</td><td>none</td><td><a href="javascript:go('11')">open</a></td></tr>
</tbody></table>"""
RULE = "<h1>Site</h1><h2>Library rule (rev. 2024.3.1.)</h2><a href='/get?f=31&n=1'>개정 사유.pdf</a><a href='/get?f=31&n=2'>library.pdf</a><a href='/back'>back</a><a>nothing</a>"
LISTED = {
    "where": "size(cells) = 5 and cells[0].text rlike '^[0-9]+$'", "source_record_id": "coalesce(parse_url(get(cells[1].links, 0).href, 'QUERY', 'id'), cells[1].inputs['id'], concat('n', cells[0].text))", "document_type": "'rule'", "source_group": "caption",
    "title_raw": "coalesce(nullif(cells[1].text, ''), cells[1].inputs['submit'])", "department": "nullif(cells[2].text, '')", "posted_date": "cells[3].text", "effective_date": "nullif(cells[3].text, 'none')",
    "source_page_url": "coalesce(get(cells[1].links, 0).href, cells[1].action, url)", "attachment_url": "get(cells[4].links, 0).href", "attachment_filename": "regexp_replace(get(cells[4].links, 0).label, ' *[(] *[0-9]+ kb[)]$', '')",
}
DETAILED = {"where": "link_href like '%/get?%'", "source_record_id": "concat(source_record_id, ':', parse_url(link_href, 'QUERY', 'n'))", "title_raw": "coalesce(link_heading, title_raw)", "attachment_url": "link_href", "attachment_filename": "link_label"}


def test_tables_of_pages(spark):
    pages = spark.createDataFrame([(PAGE, LIST), (PAGE + "?p=2", None), (PAGE + "?p=3", "")], "url string, html string")
    rows = html.table_rows(pages).orderBy("ordinal").collect()
    assert len(rows) == 4 and rows[0].caption == "Rules in force" and [c.text for c in rows[0].cells] == ["No", "Name", "Office", "Day", "File"]
    assert rows[3].cells[4].links[0].asDict() == {"href": None, "label": "open", "script": "javascript:go('11')"} and rows[3].cells[1].action == "https://site.example/open"
    a, b, c = html.list_records(pages, {**LISTED, "department": F.nullif(F.col("cells")[2]["text"], F.lit(""))}).orderBy("ordinal").collect()
    assert (a.source_record_id, a.title_raw, a.department, a.effective_date, a.source_page_url, a.attachment_url, a.source_group) == ("31", "Library rule (rev. 2024.3.1.)", "Library", "2024-03-05", "https://site.example/rule?id=31", None, "Rules in force")
    assert (b.source_record_id, b.department, b.attachment_url, b.attachment_filename, b.source_page_url, b.title_normalized) == ("n2", None, "https://site.example/get?f=22&n=1", "parking.pdf", PAGE, "parkingrule")
    assert (c.source_record_id, c.title_raw, c.effective_date, c.source_page_url, c.sha256) == ("11", "Garden rule", None, "https://site.example/open", None)
    listed = html.list_records(pages, LISTED)
    own = spark.createDataFrame([("https://site.example/rule?id=31", RULE), ("https://site.example/open", "<p>no links</p>")], "url string, html string")
    got = html.detail_records(listed, own, DETAILED).orderBy("source_record_id").collect()
    assert [(r.source_record_id, r.attachment_filename, r.attachment_role) for r in got] == [("11", "open", "document"), ("31:1", "개정 사유.pdf", "supporting"), ("31:2", "library.pdf", "document")]
    assert html.page_links(own.limit(0)).count() == 0 and html.list_records(pages.limit(0), LISTED).count() == 0
    facts = html.page_facts(spark.createDataFrame([(1, "<title>a &amp; b</title><h1>x<b>y</b></h1><a href=''>1</a><a href='/z'>2"), (2, None)], "id int, html string"), "id").orderBy("id").collect()
    assert [tuple(r) for r in facts] == [(1, "a & b", "xy", 2, ""), (2, None, None, 0, None)]


class Fake:
    def __init__(self, pages, files=None):
        self.pages, self.files, self.asked = pages, files or {}, []

    def text(self, url):
        self.asked.append(url)
        if self.pages and url not in self.pages:
            raise URLError("down")
        return self.pages.get(url, "<html></html>"), Message()

    def content(self, url, headers=None):
        m = Message()
        m["Content-Disposition"] = "attachment; filename*=UTF-8''%EA%B0%80.hwp"
        return self.files[url], m


def test_crawl(spark):
    second = LIST.replace("<td>3</td>", "<td>9</td>").replace("id=31", "id=99")
    pages = {f"{PAGE}?page=1": LIST, f"{PAGE}?page=2": second, f"{PAGE}?page=3": LIST, "https://site.example/rule?id=31": RULE, "https://site.example/open": RULE.replace("f=31", "f=11"), "https://other.example/a": "<p>nothing here</p>"}
    sources = [{"source_id": "s", "lists": [PAGE], "page_key": "page", "list_layout": LISTED, "detail_layout": DETAILED}, {"source_id": "empty", "lists": ["https://other.example/a"], "list_layout": LISTED}, {"source_id": "down", "lists": ["https://other.example/b"], "list_layout": LISTED}]

    def client():
        return Fake(pages)

    rows, errors = crawl.crawl_sources(spark, sources, client)
    assert sorted(r.source_record_id for r in rows.collect()) == ["11:1", "11:2", "31:1", "31:2", "n2"]
    assert sorted((r.source_id, r.error.split(":")[0]) for r in errors.collect()) == [("down", "URLError"), ("down", "no records"), ("empty", "no records"), ("s", "URLError")]
    config = {"sources": [sources[0], {**sources[1], "enabled": False}]}
    assert crawl.chosen_sources(config) == [sources[0]] and crawl.chosen_sources(config, ["empty"]) == [] and updates.unknown_sources(["b", "q"], ["b"]) == ["q"]
    with pytest.raises(ValueError):
        crawl.chosen_sources(config, ["q"])


def test_downloads(tmp_path):
    saved = {}

    def save(name, payload):
        saved[name] = payload
        return name

    r = {"source_id": "s", "effective_date": None, "attachment_url": "u", "source_page_url": "p", "version_id": "V", "sha256": "3608bca1e44ea6c4d268eb6db02260269892c0b42b86bbf1e77a6fa16c3c9282", "file_size": 1}
    got = crawl.download(r, Fake({}, {"u": b"x"}), save)
    assert got["attachment_filename"] == "가.hwp" and saved == {"s/unknown-date/가.hwp": b"x"} and "sha256" not in crawl.download({"attachment_url": None}, Fake({}), save)
    bad = {**r, "sha256": "0" * 64}
    with pytest.raises(RuntimeError, match="hash"):
        crawl.download_batch([r, bad, {**r, "file_size": 2}], Fake({}, {"u": b"x"}), save)
    good = {**r, "sha256": "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"}
    assert crawl.download_batch([good], Fake({}, {"u": b"x"}), save)[0]["status"] == "verified"
    assert crawl.decode("가".encode("cp949"), None) == "가" and crawl.decode("é".encode("latin-1") + b"\xff\xfe\xfa", "no-such") and crawl.answer_name("http://x/a%20b.hwp?q", 'x; filename="c/d.hwp"') == "d.hwp"

    class Opener:
        def __init__(self, fails):
            self.fails = fails

        def open(self, request, timeout):
            self.fails -= 1
            if self.fails >= 0:
                raise URLError("down")
            body = io.BytesIO(b"ok")
            body.headers = Message()
            return body

    assert crawl.HttpClient("t", retries=2, pause=0, opener=Opener(2)).text("http://x")[0] == "ok"
    with pytest.raises(URLError):
        crawl.HttpClient("t", retries=1, pause=0, opener=Opener(2)).text("http://x")


def test_read_and_write(spark, tmp_path):
    p = f"file://{tmp_path}"
    df = spark.createDataFrame([(2, "나", None, ["x", "y"]), (1, 'a"b', 3, [])], "id int, t string, n int, a array<string>")
    for _ in range(2):
        sinks.write_jsonl(df, f"{p}/t.jsonl", ["id"])
    assert tables.read_jsonl(spark, f"{p}/t.jsonl", df.schema).exceptAll(df).isEmpty()
    lines = [x for f in sorted((tmp_path / "t.jsonl").glob("part*")) for x in f.read_text().splitlines()]
    assert [json.loads(x)["id"] for x in lines] == [1, 2] and '"n":null' in lines[1]
    (tmp_path / "b.jsonl").write_bytes(b'\xef\xbb\xbf{"id": 5}\n\n  \n{"id": 6}\n')
    assert sorted(r.id for r in tables.read_jsonl(spark, f"{p}/b.jsonl", "id int").collect()) == [5, 6] and tables.read_jsonl(spark, f"{p}/none.jsonl", "id int").count() == 0
    sinks.write_csv(df, f"{p}/t.csv", ["id", "a"])
    parts = [f.read_bytes() for f in sorted((tmp_path / "t.csv").glob("part*"))]
    assert parts[0] == b"\xef\xbb\xbfid,a\n" and b"".join(parts).count(b"id,a") == 1  # one header for all parts
    assert sorted(csv.reader(io.StringIO(b"".join(parts).decode("utf-8-sig")))) == [["1", "[]"], ["2", '["x","y"]'], ["id", "a"]]
    sinks.write_json(spark, f"{p}/d/x.json", {"가": 1})
    assert json.loads((tmp_path / "d/x.json").read_text()) == {"가": 1} and tables.read_json_document(spark, f"{p}/d/x.json", "`가` int").first()[0] == 1
    (tmp_path / "c.yaml").write_text("a: [1, 2]\n")
    assert tables.read_yaml(str(tmp_path / "c.yaml")) == {"a": [1, 2]}
    (tmp_path / "md/.git").mkdir(parents=True)
    (tmp_path / "md/a.md").write_text("x\ny")
    (tmp_path / "md/.git/z").write_text("q")
    assert [r.text for r in tables.read_markdown(spark, f"{p}/md").collect()] == ["x\ny"]
    assert [r.path for r in tables.file_digests(spark, f"{p}/md").where("path like '%.md'").collect()] == ["a.md"] and tables.scan_files(spark, f"{p}/md").count() == 1
    n = sinks.write_pages(spark.createDataFrame([("a/b.md", "가"), ("c.md", "")], "name string, content string"), f"{p}/pages")
    assert n == 2 and (tmp_path / "pages/a/b.md").read_text() == "가"
    plan = spark.createDataFrame([("a.md", "to/a.md", tables.file_digests(spark, f"{p}/md").where("path = 'a.md'").first().sha256, "copied"), ("a.md", "to/b.md", "0", "copied"), ("q", "q", "", "reused")], "source_file string, archive_file string, sha256 string, status string")
    assert [r.status for r in sinks.copy_files(plan, f"{p}/md", f"{p}/raw").collect()] == ["copied", "failed", "reused"] and (tmp_path / "raw/to/a.md").exists()


def test_office(spark):
    def packed(name, body):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(name, body)
        return out.getvalue()

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    docx = packed("word/document.xml", f"<w:document {w}><w:p><w:t>가</w:t><w:t>나</w:t></w:p><w:p><w:t> </w:t></w:p><w:p><w:t>다</w:t></w:p></w:document>")
    hwpx = packed("Contents/section0.xml", "<s xmlns:h='urn:h'><h:t>라</h:t><h:x>no</h:x><h:t>마</h:t></s>")
    rows = [("a.DOCX", docx), ("b.hwpx", hwpx), ("c.docx", b"broken"), ("d.hwp", b"x"), ("e.hwpx", packed("x", ""))]
    got = {r.path: (r.text, r.status) for r in tables.extract_office(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert got == {"a.DOCX": ("가나\n\n다", "success"), "b.hwpx": ("라\n마", "success"), "c.docx": (None, "failed"), "d.hwp": (None, "unsupported"), "e.hwpx": (None, "failed")}


def test_catalog_and_reports(spark, tmp_path):
    p = f"file://{tmp_path}"
    docs = spark.createDataFrame([("D1", "regulation", "나", "V1", None), ("D2", "guideline", "가", None, "과")], "document_id string, document_type string, title string, latest_version_id string, department string")
    vers = spark.createDataFrame([("V1", "in_force", "2024-01-01", "n/가 b.md", "http://x/view")], "version_id string, validity_status string, revision_date string, normalized_file string, source_page_url string")
    rows = catalog.catalog_rows(docs, vers)
    lines = {r.document_id: r.x for r in rows.select("document_id", catalog.markdown_row("https://b/").alias("x")).collect()}
    assert lines["D1"] == "| 나 | - | regulation | - | V1 | in_force/unknown | 2024-01-01 | - | `D1` | [본문](https://b/n/%EA%B0%80%20b.md) | [공식](http://x/view) |"
    assert lines["D2"] == "| 가 | - | guideline | 과 | - | unknown/unknown | - | - | `D2` | - | - |"
    assert [r.document_id for r in catalog.sorted_by(rows, "department").collect()] == ["D1", "D2"] and [r.document_id for r in catalog.review_required(rows).collect()] == ["D2"]
    sinks.write_catalog(rows, f"{p}/cat", "https://b/")
    assert (tmp_path / "cat/latest/regulations-001.md").read_text().count("\n") == 7 and "검토 필요 1개" in (tmp_path / "cat/README.md").read_text()
    checks = spark.createDataFrame([("a", "PASS", 0), ("b", "FAIL", 1200)], "check string, status string, failures long")
    assert "- FAIL: 1" in sinks.validation_report(checks) and "1,200건" in sinks.validation_report(checks)
    files = spark.createDataFrame([("a/b.HWP", 26 << 20), ("a/c.hwp", 1), ("x/README", 2), ("x/.hidden", 3)], "path string, length long")
    audited = catalog.audit(files)
    assert [tuple(r) for r in catalog.by_frequency(audited).collect()] == [(".hwp", 2, (26 << 20) + 1, 1, 0, 0), ("[none]", 2, 5, 0, 0, 0)]
    assert "25/50/100MB 이상: 1/0/0개" in sinks.audit_report(audited)
    rec = spark.createDataFrame([("s", "new_version_candidate", "2024-01-01", "a|b", ["D1"], "u", None), ("s", "present_hash", None, "c", [], "u", None)], "source_id string, comparison_status string, effective_date string, title_raw string, matched_document_ids array<string>, source_page_url string, attachment_filename string")
    report = sinks.comparison_report(updates.status_pivot(rec), updates.review_candidates(rec), {"t": "down"}, "now")
    assert "a\\|b" in report and "| t | 0 | 0 | 0 | 0 | 0 | 0 | down |" in report
    chunks = spark.createDataFrame([("V1", 0, "public"), ("V1", 1, "internal")], "version_id string, chunk_index int, access_level string")
    sinks.write_bundle(docs.withColumn("access_level", F.lit("public")), chunks, docs.limit(1), f"{p}/bundle", "# b\n")
    assert spark.read.json(f"{p}/bundle/chunks.jsonl").count() == 1 and (tmp_path / "bundle/README.md").read_text() == "# b\n"
    packed = zipfile.ZipFile(sinks.zip_folder(spark, f"{p}/bundle").removeprefix("file://"))
    assert packed.read("README.md") == b"# b\n" and any(n.startswith("documents.jsonl/part-") for n in packed.namelist())
    made = spark.createDataFrame([("v1", "converted", [], 300, 2), ("v2", "failed", ["짧다"], 3, 0)], "version_id string, outcome string, errors array<string>, text_chars int, article_count int")
    assert "- `v2`: 짧다" in sinks.conversion_report(made) and "| v1 | converted | 300 | 2 |" in sinks.conversion_report(made)
    proof = sinks.gate_report(spark.createDataFrame([("v1", True, [])], "version_id string, current boolean, failed array<string>"), "now")
    assert proof["passed"] and proof["versions"] == [{"version_id": "v1", "checks": {"current": True}}]
    found = catalog.security_findings(spark.createDataFrame([(1, "010-1234-5678"), (2, "x"), (3, None)], "id int, text string"))
    assert [(r.id, r.reasons) for r in found.collect()] == [(1, ["personal_mobile_number"])]
