"""From candidates to documents, versions and their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.functions import ids, rules, text
from lawloom.operators.numbering import row_numbers
from lawloom.operators.versions import document_groups, grouped_candidates

# Kinds of files that count as documents.
EXTENSIONS = (".pdf", ".hwp", ".hwpx", ".docx", ".xlsx", ".xls")


def candidates(rows: DataFrame) -> DataFrame:
    """Rows of high confidence whose file is of a document's kind."""
    return rows.where((F.col("metadata_confidence") == "high") & F.lower("file_extension").isin(*EXTENSIONS))


def with_source(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Candidates whose hash the source manifest has."""
    return rows.join(manifest.select("sha256").distinct(), "sha256", "left_semi")


def with_extraction(rows: DataFrame, extraction: DataFrame) -> DataFrame:
    """Candidates with extraction_status and text_file of their hash, the last by ordinal; without any: unsupported, null."""
    last = extraction.groupBy("sha256").agg(F.max_by(F.struct(F.col("status").alias("extraction_status"), "text_file"), "ordinal").alias("x")).select("sha256", "x.*")
    return rows.join(last, "sha256", "left").withColumn("extraction_status", F.coalesce("extraction_status", F.lit("unsupported")))


def legacy_texts(metadata: DataFrame, texts: DataFrame) -> DataFrame:
    """(sha256, path) of texts that earlier records have for attachments.

    metadata: (kind, ordinal, json) of record files, kind ``regulation`` or ``guideline``; texts: (kind, key, path),
    key being the record's id. Records that are no JSON are left out, as are attachments without a hash and those
    of guidelines that are not active. The last record of a hash counts, guidelines after regulations.
    """
    shape = "regulation_id string, guideline_id string, attachments array<struct<sha256:string,version_status:string>>"
    parsed = metadata.select("kind", "ordinal", F.from_json(F.regexp_replace("json", "^﻿", ""), shape).alias("x")).where("x is not null")
    each = parsed.select("kind", "ordinal", F.coalesce("x.regulation_id", "x.guideline_id").alias("key"), F.posexplode("x.attachments").alias("at", "a")).where("a.sha256 <> ''")
    each = each.where((F.col("kind") != "guideline") | (F.col("a.version_status") == "active"))
    order = F.struct((F.col("kind") == "guideline").alias("late"), "ordinal", "at")
    return each.join(texts, ["kind", "key"]).groupBy(F.col("a.sha256").alias("sha256")).agg(F.max_by("path", order).alias("path"))


def occurrences(rows: DataFrame) -> DataFrame:
    """A row for each place of a candidate in the archive, ``archive_relative_path``; without source_occurrences the candidate's own path."""
    own = F.array(F.struct(F.col("archive_relative_path")))
    listed = F.transform("source_occurrences", lambda x: F.struct(x["archive_relative_path"].alias("archive_relative_path")))
    places = F.when(F.size(F.coalesce("source_occurrences", F.array())) > 0, listed).otherwise(own)
    return rows.withColumn("_place", F.explode(places)).withColumn("archive_relative_path", F.col("_place.archive_relative_path")).drop("_place", "source_occurrences")


def migration_plan(rows: DataFrame, files: DataFrame, findings: DataFrame, targets: DataFrame, execute: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(manifest, excluded, missing) of copying candidates to the raw layer.

    files: (path, sha256, length) of the archive; findings: (sha256, reasons) of texts under review; targets:
    (path, sha256) of what is there already. Nothing is copied here: the manifest's status says what to copy.
    """
    each = occurrences(rows).drop("sha256").join(files.select(F.col("path").alias("archive_relative_path"), "sha256", F.col("length").alias("file_size")), "archive_relative_path", "left")
    found = each.where("sha256 is not null")
    held = findings.groupBy("sha256").agg(F.max_by("reasons", F.size("reasons")).alias("reasons"))
    excluded = found.join(held, "sha256").select(F.col("archive_relative_path").alias("source_file"), "sha256", F.array_join("reasons", ";").alias("reason"), F.lit("review_required").alias("access_level"))
    free = found.join(held, "sha256", "left_anti").withColumn("archive_file", ids.archive_path(F.col("document_type"), F.col("archive_relative_path")))
    free = free.join(targets.select(F.col("path").alias("archive_file"), F.col("sha256").alias("there")), "archive_file", "left")
    status = rules.copy_status(F.col("there"), F.col("sha256"), execute)
    manifest = free.select("document_type", F.col("document_id").alias("legacy_document_id"), F.col("archive_relative_path").alias("source_file"), "archive_file", "sha256", "file_size", status.alias("status"), status.isin("copied", "reused").alias("hash_verified"), F.lit("public").alias("access_level"))
    return manifest, excluded, each.where("sha256 is null").select("archive_relative_path")


def version_markdown(v: dict[str, Column], institution: Column, body: Column) -> Column:
    """The text file of a version: front matter, title and body."""
    current = F.coalesce(v["is_current"].cast("string"), F.lit("null"))
    quoted = {k: text.yaml_value(v[k]) for k in ("document_id", "version_id", "document_type", "title", "current_status", "enactment_date", "revision_date", "effective_date", "department", "source_url", "source_file", "sha256")}
    order = ("document_id", "version_id", "document_type", "title", "is_current", "current_status", "enactment_date", "revision_date", "effective_date", "issuing_organization", "department", "source_url", "source_file", "sha256", "access_level")
    fields = quoted | {"is_current": current, "issuing_organization": text.yaml_value(institution), "access_level": F.lit("public")}
    return text.markdown({k: fields[k] for k in order}, F.concat(F.lit("\n# "), v["title"], F.lit("\n")), body)


def normalize(rows: DataFrame, manifest: DataFrame, extraction: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, versions) of candidates (document_type, title, department, ordinal, sha256, dates, is_current, urls).

    Candidates of a title key are a document, apart by department where there are several; a version is one
    candidate. source_file is the first place of the hash in the manifest (ordinal). A document shows the single
    current version, else the last one by date and hash.
    """
    files = manifest.groupBy("sha256").agg(F.min_by("archive_file", "ordinal").alias("source_file"))
    known = with_extraction(candidates(rows), extraction).join(files, "sha256")
    groups = document_groups(known)
    key = ["document_type", "title_key", "discriminator"]
    v = grouped_candidates(known).drop("title", "document_id", "version_group_id").join(groups.select(*key, "document_id", "version_group_id", "title"), key)
    v = v.withColumns({"version_id": ids.version_id(F.col("revision_date"), F.col("sha256")), "current_status": rules.current_status(F.col("is_current")), "authority_level": rules.authority_level(F.col("document_type")), "access_level": F.lit("public"), "version_confidence": F.col("metadata_confidence")})
    v = v.withColumn("normalized_file", F.when(text.filled(F.col("text_file")) != "", ids.normalized_path(F.col("document_type"), F.col("document_id"), F.col("version_id"))))
    versions = v.withColumnRenamed("extraction_status", "text_extraction_status").drop("title_key", "discriminator", "metadata_confidence", "text_file")
    order = F.struct(text.filled(F.col("revision_date")), "sha256")
    one = F.count_if("is_current") == 1
    shown = [c for c in ("version_id", "department", "authority_level", "source_file", "normalized_file", "revision_date", "effective_date", "enactment_date", "sha256", "source_page_url") if c in versions.columns]
    whole = F.struct(*shown)
    per = versions.groupBy("document_id").agg(F.max_by(whole, order).alias("last"), F.max(F.when(F.col("is_current"), whole)).alias("current"), one.alias("one"))
    pick = F.when(F.col("one"), F.col("current")).otherwise(F.col("last"))
    per = per.select("document_id", "one", pick.alias("x")).select("document_id", F.when(F.col("one"), F.col("x.version_id")).alias("latest_version_id"), F.when(F.col("one"), True).alias("is_current"), F.when(F.col("one"), "confirmed").otherwise("unknown").alias("current_status"), *[f"x.{c}" for c in shown[1:]])
    docs = groups.drop("title_key", "discriminator", "n_versions").join(per, "document_id").withColumn("access_level", F.lit("public"))
    return docs, versions


def last_manifest(parts: list[DataFrame], main: DataFrame) -> DataFrame:
    """The union of shard manifests, in their order, and the main one; of rows with one version_id the last counts."""
    tagged = [p.withColumn("_part", F.lit(i)) for i, p in enumerate([*parts, main])]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t, allowMissingColumns=True)
    inner = [F.coalesce("ordinal", F.lit(0))] if "ordinal" in every.columns else []
    last = every.groupBy("version_id").agg(F.max_by(F.struct(*[c for c in every.columns if c not in ("_part", "version_id")]), F.struct("_part", *inner)).alias("x"))
    return last.select("version_id", "x.*")


def pdf_totals(pages: DataFrame) -> DataFrame:
    """(version_id, pdf_pages, pdf_text_chars, body) from page texts (version_id, page from 1, text); body has the pages that are not empty under their marks."""
    p = pages.withColumn("text", text.strip(text.filled(F.col("text"))))
    marked = F.when(F.col("text") != "", F.concat(F.lit("<!-- page: "), F.col("page").cast("string"), F.lit(" -->\n\n"), F.col("text"), F.lit("\n")))
    parts = F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("page", marked.alias("m")))))
    return p.groupBy("version_id").agg(F.count("*").alias("pdf_pages"), F.sum(F.length("text")).alias("pdf_text_chars"), F.array_join(F.transform(parts, lambda x: x["m"]), "\n").alias("body"))


def index_derivatives(versions: DataFrame, documents: DataFrame, manifest: DataFrame, pages: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(versions, documents) with their PDF fields: manifest (version_id, status, pdf_file, pdf_sha256) names the files, pages hold their texts.

    A version without a text whose PDF has one gets ``success_from_pdf`` and its path; a PDF without text is
    ``needs_ocr``. A named file without readable pages is ``failed_validation``.
    """
    named = manifest.where(F.col("status").isin("converted", "reused") & (text.filled(F.col("pdf_file")) != "")).select("version_id", F.col("pdf_file").alias("_file"), F.col("pdf_sha256").alias("_sha"))
    mine = ("pdf_relative_path", "pdf_sha256", "pdf_pages", "pdf_text_chars", "pdf_conversion_status", "pdf_generated_at")
    had = {c: F.col(c) if c in versions.columns else F.lit(None) for c in (*mine, "normalized_file", "text_extraction_status")}
    totals = pdf_totals(pages).select("version_id", F.col("pdf_pages").alias("_pages"), F.col("pdf_text_chars").alias("_chars"))
    j = versions.join(named, "version_id", "left").join(totals, "version_id", "left")
    read, failed = F.col("_file").isNotNull() & F.col("_pages").isNotNull(), F.col("_file").isNotNull() & F.col("_pages").isNull()
    fresh = read & (text.filled(had["normalized_file"].cast("string")) == "") & (F.col("_chars") > 0)
    keep = lambda c, kind, new: F.when(read, new).otherwise(had[c].cast(kind))
    values = {
        "pdf_relative_path": keep("pdf_relative_path", "string", F.col("_file")), "pdf_sha256": keep("pdf_sha256", "string", F.col("_sha")), "pdf_pages": keep("pdf_pages", "long", F.col("_pages")), "pdf_text_chars": keep("pdf_text_chars", "long", F.col("_chars")),
        "pdf_conversion_status": F.when(failed, "failed_validation").otherwise(keep("pdf_conversion_status", "string", F.lit("success"))), "pdf_generated_at": keep("pdf_generated_at", "string", F.lit(now)),
        "text_extraction_status": F.when(fresh, "success_from_pdf").when(read & (F.col("_chars") == 0), "needs_ocr").otherwise(had["text_extraction_status"].cast("string")),
        "normalized_file": F.when(fresh, ids.normalized_path(F.col("document_type"), F.col("document_id"), F.col("version_id"))).otherwise(had["normalized_file"].cast("string")),
    }
    v = j.withColumns(values).drop("_file", "_sha", "_pages", "_chars")
    per = v.groupBy("document_id").agg(F.bool_or(F.col("pdf_relative_path").isNotNull()).alias("_any"))
    latest = v.select(F.col("version_id").alias("latest_version_id"), F.col("pdf_relative_path").alias("_path"), F.col("pdf_conversion_status").alias("_status"))
    d = documents.join(latest, "latest_version_id", "left").join(per, "document_id", "left")
    was = {c: F.col(c).cast("string") if c in documents.columns else F.lit(None).cast("string") for c in ("pdf_relative_path", "pdf_conversion_status")}
    d = d.withColumns({"pdf_relative_path": F.coalesce("_path", was["pdf_relative_path"]), "pdf_conversion_status": F.when(F.col("_path").isNotNull(), F.col("_status")).when(F.col("_any"), "available_for_versions").otherwise(was["pdf_conversion_status"])})
    return v, d.drop("_path", "_status", "_any").select(*documents.columns, *[c for c in was if c not in documents.columns])


def shards(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """Adds shard: rows in order are dealt to 0 to n - 1 in turn."""
    return row_numbers(rows, [], order, "_n").withColumn("shard", ((F.col("_n") - 1) % n).cast("int")).drop("_n")


def convert(records: DataFrame, versions: DataFrame, documents: DataFrame, raw: DataFrame, bodies: DataFrame, existing: DataFrame, force: bool = False, institution: str | None = None) -> DataFrame:
    """The conversion gate: a row for each record (version_id, sha256) with outcome, errors and the metrics of its text.

    raw: (path, sha256) of the sources that are there; bodies: (version_id, body) as converted, null where that failed;
    existing: (path, text, sha256) of texts that are there. errors is empty exactly where outcome is ``reused`` or
    ``converted``; a batch is applied only when every row is one of these.
    """
    v = versions.select("version_id", "document_id", "document_type", "title", "source_file", F.col("sha256").alias("_sha"), *[F.col(c) for c in ("portable_conversion_status", "portable_markdown_sha256") if c in versions.columns])
    for c in ("portable_conversion_status", "portable_markdown_sha256"):
        v = v if c in v.columns else v.withColumn(c, F.lit(None).cast("string"))
    j = records.select("version_id", "sha256").join(v, "version_id", "left").join(documents.select("document_id", F.lit(True).alias("_doc")), "document_id", "left")
    j = j.join(raw.select(F.col("path").alias("source_file"), F.col("sha256").alias("_raw")), "source_file", "left").join(bodies, "version_id", "left")
    j = j.withColumn("path", ids.normalized_path(F.col("document_type"), F.col("document_id"), F.col("version_id"))).join(existing.select("path", F.col("text").alias("_old"), F.col("sha256").alias("_old_sha")), "path", "left")
    there = F.col("_old_sha").isNotNull()
    unchanged = there & (F.col("portable_conversion_status") == "success") & (F.col("portable_markdown_sha256") == F.col("_old_sha"))
    used = F.when(there & F.lit(not force), F.regexp_replace("_old", "^﻿", "")).otherwise(text.normalize_lines(F.col("body")))
    j = j.withColumn("_text", used)
    q = text.text_quality(F.col("_text"), F.col("title"), institution)
    bad = F.when(F.col("_text").isNull(), F.array(F.lit("변환 실패"))).otherwise(text.quality_errors(q))
    outcome = rules.conversion_outcome(there, force, unchanged, bad)
    first = F.when(F.col("_sha").isNull(), "versions.jsonl에 없음").when(F.col("_doc").isNull(), "documents.jsonl에 없음").when(F.col("_raw").isNull(), "HWP 원본 없음").when((F.col("_raw") != F.col("sha256")) | (F.col("_sha") != F.col("sha256")), "HWP SHA-256 불일치")
    errors = F.when(first.isNotNull(), F.array(first)).when(outcome == "force_required", F.array(F.lit("기존 Markdown이 있어 --force 필요"))).otherwise(bad)
    return j.select("version_id", "path", F.when(first.isNotNull(), "failed").otherwise(outcome).alias("outcome"), errors.alias("errors"), F.col("_text").alias("text"), *[c.alias(n) for n, c in q.items()])
