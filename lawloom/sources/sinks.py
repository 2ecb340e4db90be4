"""Writers of the corpus tables, pages and reports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.operators import catalog


def _files(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _replace(spark: SparkSession, made: str, path: str) -> None:
    """``made`` takes the place of ``path``: the old files are moved away, then the new ones moved in, so there is a moment with neither. Readers at work use ``snapshots``, which has none."""
    fs, target = _files(spark, path)
    new = _files(spark, made)[1]
    old = _files(spark, f"{path}.old-{uuid.uuid4().hex[:8]}")[1]
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(new, target)
    fs.delete(old, True)


def write_text(spark: SparkSession, path: str, value: str) -> None:
    """One file, written beside its place and then moved there."""
    made = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    fs, where = _files(spark, made)
    fs.mkdirs(where.getParent())
    out = fs.create(where, True)
    out.write(value.encode("utf-8"))
    out.close()
    _replace(spark, made, path)


def write_json(spark: SparkSession, path: str, value: object) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2))


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """A folder of JSON lines with all fields, nulls too; parts follow each other in ``order``. The folder is replaced when it is whole."""
    made = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    (df.orderBy(*order) if order else df).write.option("ignoreNullFields", False).json(made)
    _replace(df.sparkSession, made, path)


def write_csv(df: DataFrame, path: str, fields: list[str] | None = None) -> None:
    """A folder of CSV; only ``fields`` if given; nested columns as JSON text. The parts follow each other: the first is a byte order mark and the header alone, so that all of them in order are one file."""
    df = df.select(*fields) if fields else df
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")]
    flat = df.withColumns({c: F.to_json(c) for c in nested})
    quoted = ['"' + c.replace('"', '""') + '"' if set(c) & set(',"\n') else c for c in df.columns]
    header = df.sparkSession.createDataFrame([("\ufeff" + ",".join(quoted),)], "value string").coalesce(1)
    made = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    header.unionByName(flat.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in flat.columns]), {"escape": '"'}).alias("value"))).write.text(made)
    _replace(df.sparkSession, made, path)


def write_pages(pages: DataFrame, path: str, key: str = "name", text: str = "content") -> int:
    """A file for each row (name, content) below ``path``, written by the tasks; returns their number."""
    from collections.abc import Iterator

    import pandas as pd
    import pyarrow.fs as pafs

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        for pdf in batches:
            for name, content in zip(pdf["k"], pdf["v"], strict=True):
                place = f"{root.rstrip('/')}/{name}"
                fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(f"{place}.tmp") as out:
                    out.write(content.encode("utf-8"))
                fs.move(f"{place}.tmp", place)
            yield pd.DataFrame({"n": [len(pdf)]})

    return pages.select(F.col(key).alias("k"), F.col(text).alias("v")).mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_catalog(rows: DataFrame, path: str, base_url: str) -> None:
    """The browsable catalog: pages of the latest versions, lists by title and department, what needs review, and a page that counts both."""
    spark = rows.sparkSession
    write_pages(catalog.page_texts(rows, base_url), f"{path}/latest")
    line = catalog.markdown_row(base_url)
    lists = {"by-title": catalog.sorted_by(rows, "title"), "by-department": catalog.sorted_by(rows, "department"), "review-required": catalog.sorted_by(catalog.review_required(rows), "latest")}
    for name, view in lists.items():
        view.select(line.alias("value")).write.mode("overwrite").text(f"{path}/{name}")
    n, review = rows.count(), catalog.review_required(rows).count()
    write_text(spark, f"{path}/README.md", f"# 카탈로그\n\n문서 {n}개, 검토 필요 {review}개\n")


def write_bundle(documents: DataFrame, chunks: DataFrame, manifest: DataFrame, path: str, readme: str = "") -> None:
    """Public documents and chunks with the manifest, as one folder that other systems load."""
    write_jsonl(documents.where("access_level = 'public'"), f"{path}/documents.jsonl", ["document_id"])
    write_jsonl(chunks.where("access_level = 'public'"), f"{path}/chunks.jsonl", ["version_id", "chunk_index"])
    write_jsonl(manifest, f"{path}/corpus_manifest.json")
    write_text(documents.sparkSession, f"{path}/README.md", readme)


def copy_files(plan: DataFrame, source: str, target: str) -> DataFrame:
    """(source_file, archive_file, status) of copying the planned files (status ``copied``) below ``source`` to ``target``; each copy is read again and its hash compared, ``failed`` where it differs."""
    from collections.abc import Iterator

    import pandas as pd
    import pyarrow.fs as pafs

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        place = lambda p: p if "://" in p else f"file://{p}"
        fs_in, root_in = pafs.FileSystem.from_uri(place(source))
        fs_out, root_out = pafs.FileSystem.from_uri(place(target))

        def digest(fs, at: str) -> str:
            h = hashlib.sha256()
            with fs.open_input_stream(at) as f:
                while block := f.read(1 << 20):
                    h.update(block)
            return h.hexdigest()

        for pdf in batches:
            states = []
            for a, b, sha, status in zip(pdf["source_file"], pdf["archive_file"], pdf["sha256"], pdf["status"], strict=True):
                if status == "copied":
                    to = f"{root_out}/{b}"
                    fs_out.create_dir(to.rsplit("/", 1)[0], recursive=True)
                    pafs.copy_files(f"{root_in}/{a}", to, source_filesystem=fs_in, destination_filesystem=fs_out)
                    status = "copied" if digest(fs_out, to) == sha else "failed"
                states.append(status)
            yield pd.DataFrame({"source_file": pdf["source_file"], "archive_file": pdf["archive_file"], "status": states})

    return plan.select("source_file", "archive_file", "sha256", "status").mapInPandas(run, "source_file string, archive_file string, status string")


def validation_report(checks: DataFrame) -> str:
    """The checks (a row each, a few dozen) as a page."""
    rows = checks.collect()
    n = {s: sum(r.status == s for r in rows) for s in ("PASS", "WARNING", "FAIL")}
    parts = [f"## {r.status} — {r.check}\n\n{r.failures:,}건\n" for r in rows]
    return "\n".join(["# 코퍼스 검증 보고서", "", *(f"- {s}: {k}" for s, k in n.items()), "", *parts])


def audit_report(audited: DataFrame) -> str:
    """The histogram of extensions (a row each) as a page, with totals."""
    rows = catalog.by_frequency(audited).collect()
    total = lambda c: sum(r[c] for r in rows)
    head = [f"- 전체 파일: {total('n'):,}개", f"- 전체 크기: {total('size'):,} bytes", f"- 25/50/100MB 이상: {total('over_25mb')}/{total('over_50mb')}/{total('over_100mb')}개"]
    return "\n".join(["# 원본 감사 보고서", "", *head, "", "## 확장자", "", *(f"- `{r.extension}`: {r.n:,}" for r in rows)]) + "\n"


def comparison_report(pivot: DataFrame, candidates: DataFrame, errors: dict[str, str], now: str) -> str:
    """Counts by source, the records to review and the sources that failed as a page; both tables are small by nature."""
    counts = {r.source_id: r.asDict() for r in pivot.collect()}
    names = [c for c in pivot.columns if c != "source_id"]
    lines = [f"| {s} | " + " | ".join(str(counts.get(s, {}).get(c, 0)) for c in names) + f" | {errors.get(s, '')} |" for s in sorted({*counts, *errors})]
    shown = [f"| {r.source_id} | {r.comparison_status} | {r.effective_date or ''} | {(r.title_raw or '').replace('|', chr(92) + '|')} | {', '.join(r.matched_document_ids)} | {r.source_page_url or ''} |" for r in candidates.collect()]
    return "\n".join(
        [
            "# 공식 원천 자동 대조 결과", "", f"- 생성 시각(UTC): {now}", f"- 수집 레코드: {sum(c['total'] for c in counts.values())}", f"- 원천 오류: {len(errors)}", "", "## 원천별 요약", "", f"| source_id | {' | '.join(names)} | 오류 |", "|---" * (len(names) + 2) + "|", *lines,
            "", "## 검토 후보", "", "| source_id | 판정 | 원천 표시일 | 제목 | 기존 document_id | 원천 |", "|---" * 6 + "|", *shown,
        ]
    ) + "\n"


def conversion_report(converted: DataFrame) -> str:
    """The conversions of a batch (a row each) as a page: outcomes, then those that failed with their reasons."""
    rows = converted.select("version_id", "outcome", "errors", "text_chars", "article_count").orderBy("version_id").collect()
    n = {o: sum(r.outcome == o for r in rows) for o in sorted({r.outcome for r in rows})}
    good = [f"| {r.version_id} | {r.outcome} | {r.text_chars} | {r.article_count} |" for r in rows if not r.errors]
    bad = [f"- `{r.version_id}`: {', '.join(r.errors)}" for r in rows if r.errors]
    return "\n".join(["# 변환 보고서", "", *(f"- {o}: {k}" for o, k in n.items()), "", "| version_id | outcome | text_chars | article_count |", "|---" * 4 + "|", *good, "", "## 실패", "", *(bad or ["없음"])]) + "\n"


def gate_report(gate: DataFrame, now: str) -> dict:
    """The proof of a batch (a row a record) as one document."""
    rows = [r.asDict() for r in gate.orderBy("version_id").collect()]
    return {"generated_at": now, "records": len(rows), "passed": all(not r["failed"] for r in rows), "versions": [{"version_id": r["version_id"], "checks": {k: v for k, v in r.items() if k not in ("version_id", "failed")}} for r in rows]}


def zip_folder(spark: SparkSession, path: str) -> str:
    """``path``.zip with all files below a folder, streamed through the driver one block at a time."""
    jvm = spark.sparkContext._jvm
    fs, root = _files(spark, path)
    out = jvm.java.util.zip.ZipOutputStream(fs.create(_files(spark, f"{path}.zip")[1], True))
    found, top = fs.listFiles(root, True), fs.getFileStatus(root).getPath().toUri().getPath()
    while found.hasNext():
        at = found.next().getPath()
        out.putNextEntry(jvm.java.util.zip.ZipEntry(at.toUri().getPath()[len(top) + 1 :]))
        source = fs.open(at)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
        source.close()
        out.closeEntry()
    out.close()
    return f"{path}.zip"
