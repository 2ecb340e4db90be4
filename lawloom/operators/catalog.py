"""Catalog pages, manifest, audit and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.functions import text
from lawloom.operators.numbering import row_numbers
from lawloom.operators.validate import rows_digest

# Heads of the catalog's pages, and the start of time for tables without any.
HEADER = "| 문서명 | 대체제목 | 유형 | 부서 | 최신 확보 버전 | 시행상태 | 개정일 | 시행일 | document_id | 본문 | 출처 |"
GENERATED = "자동 생성 파일입니다. 수동 편집하지 마십시오."
EPOCH = "1970-01-01T00:00:00+00:00"
PAGE = 200


def catalog_pages(documents: DataFrame, size: int = PAGE) -> DataFrame:
    """Adds n, the row within the type by title and id, and page."""
    return row_numbers(documents, ["document_type"], ["title", "document_id"]).withColumn("page", (F.floor((F.col("n") - 1) / size) + 1).cast("int"))


def catalog_rows(documents: DataFrame, versions: DataFrame) -> DataFrame:
    """Documents with what their latest version says of state, dates, text and source; without one the document's own state."""
    have = lambda df, c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    v = versions.select(F.col("version_id").alias("latest_version_id"), *[have(versions, c).alias(f"_{c}") for c in ("validity_status", "status_confidence", "revision_date", "effective_date", "normalized_file", "source_page_url")])
    j = documents.select("document_id", "document_type", "title", have(documents, "department").alias("department"), F.col("latest_version_id"), F.coalesce(F.col("alternative_titles") if "alternative_titles" in documents.columns else F.lit(None).cast("array<string>"), F.array().cast("array<string>")).alias("alternative_titles"), *[have(documents, c).alias(f"own_{c}") for c in ("validity_status", "status_confidence", "source_page_url")]).join(v, "latest_version_id", "left")
    return j.select(
        "document_id", "document_type", "title", "department", "alternative_titles", F.when(F.col("_revision_date").isNotNull() | F.col("latest_version_id").isNotNull(), F.col("latest_version_id")).alias("version_id"), F.coalesce("_validity_status", "own_validity_status", F.lit("unknown")).alias("validity_status"),
        F.coalesce("_status_confidence", "own_status_confidence", F.lit("unknown")).alias("status_confidence"), F.col("_revision_date").alias("revision_date"), F.col("_effective_date").alias("effective_date"), F.col("_normalized_file").alias("normalized_file"), F.coalesce(F.nullif("_source_page_url", F.lit("")), "own_source_page_url").alias("source_page_url"),
    )


def quoted_path(path: Column) -> Column:
    """A path with all signs but letters, digits, ``_.-~/`` as percent codes of their bytes."""
    coded = F.regexp_replace(F.regexp_replace(F.url_encode(path), r"\+", "%20"), "%2F", "/")
    return F.regexp_replace(F.regexp_replace(coded, r"\*", "%2A"), "%7E", "~")


def markdown_row(base_url: str) -> Column:
    """A row of ``catalog_rows`` as a line of a table; texts are links below ``base_url``."""
    dash = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("-"))
    file, url = text.filled(F.col("normalized_file")), text.filled(F.col("source_page_url"))
    body = F.when(file != "", F.concat(F.lit(f"[본문]({base_url}"), quoted_path(file), F.lit(")"))).otherwise("-")
    source = F.when(url != "", F.concat(F.lit("[공식]("), url, F.lit(")"))).otherwise("-")
    aliases = F.coalesce(F.nullif(F.array_join("alternative_titles", ", "), F.lit("")), F.lit("-"))
    cells = [F.col("title"), aliases, F.col("document_type"), dash("department"), dash("version_id"), F.concat_ws("/", "validity_status", "status_confidence"), dash("revision_date"), dash("effective_date"), F.concat(F.lit("`"), "document_id", F.lit("`")), body, source]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def sorted_by(rows: DataFrame, view: str) -> DataFrame:
    """Catalog rows in the order of a view: ``latest`` by type, title, id; ``title``; ``department``, those without one under the sign ~, so after Latin names and before Hangul."""
    orders = {"latest": [F.col("document_type"), F.col("title"), F.col("document_id")], "title": [F.col("title"), F.col("document_id")], "department": [F.coalesce(F.nullif("department", F.lit("")), F.lit("~")), F.col("title")]}
    return rows.orderBy(*orders[view])


def review_required(rows: DataFrame) -> DataFrame:
    """Catalog rows (validity_status, source_page_url) of unknown force or without an address of their own."""
    return rows.where((F.coalesce(F.col("validity_status"), F.lit("unknown")) == "unknown") | (text.url_quality(F.col("source_page_url")) != "detail"))


def page_texts(rows: DataFrame, base_url: str, size: int = PAGE) -> DataFrame:
    """(name, content) of the pages of the latest versions, ``size`` rows each: regulations and guidelines."""
    kind = F.concat(F.col("document_type"), F.lit("s"))
    paged = catalog_pages(rows.where(F.col("document_type").isin("regulation", "guideline")), size)
    lines = paged.select(kind.alias("kind"), "page", "n", markdown_row(base_url).alias("line")).groupBy("kind", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("lines"))
    number = F.lpad(F.col("page").cast("string"), F.greatest(F.lit(3), F.length(F.col("page").cast("string"))), F.lit("0"))
    head = F.concat(F.lit("# 최신 확보 "), F.col("kind"), F.lit(" "), F.col("page").cast("string"), F.lit(f"\n\n{GENERATED}\n\n{HEADER}\n|{'---|' * 11}\n"))
    return lines.select(F.concat("kind", F.lit("-"), number, F.lit(".md")).alias("name"), F.concat(head, "lines", F.lit("\n")).alias("content"))


def current_documents(documents: DataFrame) -> DataFrame:
    return documents.where("is_current and latest_version_id is not null")


def latest_documents(documents: DataFrame) -> DataFrame:
    return documents.where("latest_version_id is not null")


def generated_at(documents: DataFrame, versions: DataFrame, given: str | None = None) -> DataFrame:
    """One row, generated_at: the latest time in either table, the start of time without any; ``given`` counts before both."""
    times = ("updated_at", "collected_at", "portable_converted_at")
    latest = lambda df: df.agg(F.max(F.greatest(F.lit(""), *[text.filled(F.col(c).cast("string")) for c in times if c in df.columns], F.lit(""))).alias("t"))
    both = latest(documents).unionByName(latest(versions)).agg(F.max("t").alias("t"))
    return both.select(F.coalesce(F.lit(given).cast("string"), F.nullif("t", F.lit("")), F.lit(EPOCH)).alias("generated_at"))


def corpus_manifest(documents: DataFrame, versions: DataFrame, chunks: DataFrame, corpus_id: str = "corpus", given_time: str | None = None) -> DataFrame:
    """One row: counts, the number of documents by type as a map, the time and the digests of documents and chunks by their ids."""
    kinds = documents.groupBy("document_type").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("document_type", "n")))).alias("document_types"), F.coalesce(F.sum("n"), F.lit(0)).alias("documents"))
    v = versions.agg(F.count("*").alias("versions"), F.count_if("is_current").alias("current_versions"))
    current = current_documents(documents).agg(F.count("*").alias("current_documents")) if {"is_current", "latest_version_id"} <= set(documents.columns) else documents.limit(0).agg(F.count("*").alias("current_documents"))
    counted = chunks.agg(F.count("*").alias("chunks"), F.count_distinct("document_id").alias("documents_with_chunks"))
    row = kinds.crossJoin(v).crossJoin(current).crossJoin(counted).crossJoin(generated_at(documents, versions, given_time))  # tables of one row
    return row.withColumn("corpus_id", F.lit(corpus_id))


def table_digest(df: DataFrame, key: str) -> DataFrame:
    """(digest, rows) of all columns of a table in order of its key."""
    numbered = row_numbers(df, [], [key], "_n")
    return rows_digest(numbered.withColumn("_n", F.col("_n") - 1), "_n", sorted(df.columns))


def audit(files: DataFrame) -> DataFrame:
    """(extension, n, size, over_25mb, over_50mb, over_100mb) of files (path, length)."""
    ext = F.lower(F.regexp_extract("path", r"[^/]*[^/.][^/]*?(\.[^./\\]+)$", 1))
    over = [F.count_if(F.col("length") >= mb << 20).alias(f"over_{mb}mb") for mb in (25, 50, 100)]
    return files.withColumn("extension", F.when(ext == "", "[none]").otherwise(ext)).groupBy("extension").agg(F.count("*").alias("n"), F.sum("length").alias("size"), *over)


def by_frequency(audited: DataFrame) -> DataFrame:
    return audited.orderBy(F.desc("n"), "extension")


def security_findings(docs: DataFrame, own_domain: str = "example.org", most_bytes: int = 20 << 20) -> DataFrame:
    """Documents with reasons, the kinds of sensitive data in their text, where there are any; texts over ``most_bytes`` are not scanned, as the audit's rule has it."""
    scanned = docs.where(F.octet_length("text") <= most_bytes)
    return scanned.withColumn("reasons", text.sensitive_kinds(F.col("text"), own_domain)).where(F.size("reasons") > 0)


def split_restricted(candidates: DataFrame, restricted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded) by sha256."""
    keys = restricted.select("sha256").distinct()
    return candidates.join(keys, "sha256", "left_anti"), candidates.join(keys, "sha256", "left_semi")


def extraction_counts(rows: DataFrame) -> DataFrame:
    """(status, n) of extraction results."""
    return rows.groupBy("status").agg(F.count("*").alias("n"))
