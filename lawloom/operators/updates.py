"""Reconciliation of listed records and reviewed update batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.sources.shared import stored
from lawloom.functions import ids, rules, text
from lawloom.operators.versions import predecessors

# Fields that a batch record must have, and words of the rows an update writes.
REQUIRED = ("source_id", "source_record_id", "document_id", "document_type", "sha256", "file_size", "attachment_filename", "source_page_url", "attachment_url")
CHANGE_SUMMARY, MIME_TYPE, EXTENSION = "공식 원천 신규 게시본", "application/haansofthwp", ".hwp"
PENDING, NOT_GENERATED = "pending_portable_hwp", "not_generated_portable"


def first_seen(records: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key."""
    first = records.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(order).alias("_first"))
    cond = F.col(order) == F.col("_first")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return records.join(first, cond, "left_semi")


def title_lookup(versions: DataFrame, institution: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(k, date) and (k, matched): each title key's revision and effective dates, and its sorted document ids."""
    own = F.nullif("title_normalized", F.lit("")) if "title_normalized" in versions.columns else F.lit(None).cast("string")
    keyed = versions.withColumn("k", F.coalesce(own, text.record_key(F.col("title"), institution))).where("k <> ''")
    fields = [F.col(c) for c in ("revision_date", "effective_date") if c in versions.columns]
    dates = keyed.select("k", F.explode(F.array(*fields)).alias("date")).where("date <> ''").distinct()
    return dates, keyed.where("document_id <> ''").groupBy("k").agg(F.array_sort(F.collect_set("document_id")).alias("matched"))


def reconcile(records: DataFrame, versions: DataFrame, institution: str | None = None) -> DataFrame:
    """Adds comparison_status and matched_document_ids to records (title_normalized or title, effective_date, sha256, attachment_filename) against versions; the first status that fits."""
    hashes = versions.where("sha256 <> ''").select("sha256").distinct().withColumn("_h", F.lit(True))
    dates, names = title_lookup(versions, institution)
    key = F.col("title_normalized") if "title_normalized" in records.columns else text.record_key(F.col("title"), institution)
    r = records.withColumn("_k", key).join(hashes, "sha256", "left")
    r = r.join(dates.select(F.col("k").alias("_k"), F.col("date").alias("effective_date"), F.lit(True).alias("_d")), ["_k", "effective_date"], "left")
    r = r.join(names.select(F.col("k").alias("_k"), "matched"), "_k", "left")
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    status = rules.source_status(F.col("attachment_filename"), no("_h"), no("_d"), F.col("matched").isNotNull())
    ids_ = F.when(F.col("comparison_status").isin("present_metadata", "new_version_candidate"), F.coalesce("matched", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    return r.withColumn("comparison_status", status).withColumn("matched_document_ids", ids_).drop("_k", "_h", "_d", "matched")


def status_pivot(reconciled: DataFrame, statuses: list[str] | tuple[str, ...] = rules.STATUSES) -> DataFrame:
    return reconciled.groupBy("source_id").agg(*[F.count_if(F.col("comparison_status") == s).alias(s) for s in statuses], F.count("*").alias("total"))


def review_candidates(reconciled: DataFrame) -> DataFrame:
    """What a person has to look at: new versions and documents, supporting files left out; the latest date first, then by source."""
    new = F.col("comparison_status").isin("new_version_candidate", "new_document_candidate") & (text.attachment_role(F.col("attachment_filename")) != "supporting")
    return reconciled.where(new).orderBy(F.desc(text.filled(F.col("effective_date"))), F.desc(text.filled(F.col("source_id"))))


def unknown_sources(selected: list[str], known: list[str]) -> list[str]:
    """Chosen sources that no configuration names."""
    return sorted(set(selected) - set(known))


def download_names(batch: DataFrame) -> Column:
    """Names under which a record's file may lie, in order: as downloaded, as attached, each also decoded."""
    plus = lambda c: text.unquoted(F.regexp_replace(c, r"\+", " "))
    names = [F.col(c) for c in ("downloaded_filename", "attachment_filename") if c in batch.columns]
    return F.array_distinct(F.array_compact(F.flatten(F.array(*[F.array(F.nullif(n, F.lit("")), plus(F.nullif(n, F.lit("")))) for n in names]))))


def find_downloads(batch: DataFrame, files: DataFrame) -> DataFrame:
    """Adds found_name, actual_sha256 and actual_size to records with ``_r``: the file of the first name that is there, else the first file by name of the record's hash. files: (file_name, actual_sha256, actual_size)."""
    asked = batch.select("_r", "sha256", F.posexplode(download_names(batch)).alias("_at", "file_name"))
    by_name = asked.join(files, "file_name").select("_r", F.struct(F.col("_at").alias("at"), "file_name", "actual_sha256", "actual_size").alias("x"))
    same = files.withColumnRenamed("actual_sha256", "sha256")
    by_hash = batch.select("_r", "sha256").join(same, "sha256").select("_r", F.struct(F.lit(1 << 20).alias("at"), "file_name", F.col("sha256").alias("actual_sha256"), "actual_size").alias("x"))
    best = by_name.unionByName(by_hash).groupBy("_r").agg(F.min("x").alias("x")).select("_r", F.col("x.file_name").alias("found_name"), "x.actual_sha256", "x.actual_size")
    return batch.join(best, "_r", "left")


def validate_batch(batch: DataFrame, documents: DataFrame, versions: DataFrame, files: DataFrame, exclude_supporting: bool = False) -> DataFrame:
    """Adds error_code (null: accepted), new_version_id, already_present and archive_file; the first failure in fixed order counts.

    In order: missing fields, a date, a known document, a title change with its former title and evidence, the
    predecessor if one is named, the file, its hash, its size, a version id of another hash, a hash of another
    version. files has (file_name, actual_sha256, actual_size). Any error refuses the batch: see ``refused``.
    """
    for c in ("effective_date", "revision_date", "previous_version_id", "previous_title", "title_change_evidence", "version_id"):
        batch = batch if c in batch.columns else batch.withColumn(c, F.lit(None).cast("string"))
    missing = F.array_compact(F.array(*[F.when(text.filled(F.col(c).cast("string")) == "", F.lit(c)) for c in REQUIRED]))
    date = F.coalesce(F.nullif("revision_date", F.lit("")), F.nullif("effective_date", F.lit("")))
    b = batch.withColumns({"_r": F.monotonically_increasing_id(), "_missing": missing, "_date": date, "new_version_id": F.coalesce(F.nullif("version_id", F.lit("")), ids.version_id(date, F.col("sha256")))})
    b = find_downloads(b, files)
    b = b.join(documents.select("document_id", F.col("title").alias("stored_title"), F.lit(True).alias("_known")), "document_id", "left")
    b = b.join(predecessors(versions, exclude_supporting), "document_id", "left")
    # versions of different files may share an id, as it has eight digits of the hash
    known = versions.where("sha256 is not null").select(F.col("version_id").alias("new_version_id"), "sha256")
    named, held = known.select("new_version_id").distinct().withColumn("_named", F.lit(True)), known.distinct().withColumn("_held", F.lit(True))
    owned = versions.where("sha256 is not null").select("sha256").distinct().withColumn("_owned", F.lit(True))
    b = b.join(named, "new_version_id", "left").join(held, ["new_version_id", "sha256"], "left").join(owned, "sha256", "left")
    unproven = ~F.col("previous_title").eqNullSafe(F.col("stored_title")) | (text.filled(F.col("title_change_evidence")) == "") | (text.filled(F.col("title")) == "") | F.col("title").eqNullSafe(F.col("stored_title"))
    code = (
        F.when(F.size("_missing") > 0, F.concat(F.lit("missing:"), F.array_join("_missing", ",")))
        .when(F.col("_date").isNull(), "no_date")
        .when(F.col("_known").isNull(), "unknown_document")
        .when(F.col("previous_title").isNotNull() & unproven, "title_change_without_evidence")
        .when((text.filled(F.col("previous_version_id")) != "") & ~F.col("previous_version_id").eqNullSafe(F.col("predecessor_id")), "stale_predecessor")
        .when(F.col("actual_sha256").isNull(), "file_not_found")
        .when(F.col("actual_sha256") != F.col("sha256"), "hash_mismatch")
        .when(F.col("actual_size") != F.col("file_size"), "size_mismatch")
        .when(F.col("_named") & F.col("_held").isNull(), "version_id_conflict")
        .when(F.col("_owned") & F.col("_named").isNull(), "hash_owned")
    )
    b = b.withColumns({"error_code": code, "already_present": F.col("_named").isNotNull(), "archive_file": ids.raw_path(F.col("document_type"), F.col("source_id"), F.col("source_record_id"), F.col("attachment_filename"))})
    return b.drop("_r", "_missing", "_date", "_known", "_named", "_held", "_owned")


def refused(validated: DataFrame) -> DataFrame:
    """One row: records, errors and refused, which is true for any error and for a batch without records."""
    return validated.agg(F.count("*").alias("records"), F.count_if(F.col("error_code").isNotNull()).alias("errors")).withColumn("refused", (F.col("errors") > 0) | (F.col("records") == 0))


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def apply_batch(accepted: DataFrame, documents: DataFrame, versions: DataFrame, manifest: DataFrame, updated_at: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, versions, manifest) with the accepted records; applied again they change nothing.

    A record's version follows the document's greatest by date and id; of several records of a document each
    follows the one before it by date and id. Current versions are closed, the predecessor is linked on, a
    changed title makes the old one an alias, the document shows the last record. Rows that are there keep their place.
    """
    date = F.coalesce(F.nullif("revision_date", F.lit("")), F.nullif("effective_date", F.lit("")))
    # records of different documents may share a version id, as it has eight digits of the hash
    new = accepted.where("error_code is null and not already_present").dropDuplicates(["document_id", "new_version_id", "sha256"])
    new = new.select(
        F.col("new_version_id").alias("version_id"), "document_id", "sha256", date.alias("revision_date"), _column(new, "effective_date").alias("effective_date"), F.col("archive_file").alias("source_file"),
        F.col("attachment_url").alias("source_url"), "source_page_url", "file_size", _column(new, "department").alias("_department"), F.col("title").alias("_title"), _column(new, "previous_title").alias("previous_title"),
        _column(new, "title_change_evidence").alias("title_change_evidence"), _column(new, "application_note").alias("application_note"), "source_id", "source_record_id", "attachment_filename", _column(new, "captured_at").alias("captured_at"),
    )
    line = Window.partitionBy("document_id").orderBy(text.filled(F.col("revision_date")), "version_id", "sha256")
    head = predecessors(versions).withColumnRenamed("predecessor_id", "_head")
    new = new.withColumns({"_before": F.lag("version_id").over(line), "_after": F.lead("version_id").over(line)}).join(head, "document_id", "left")
    new = new.withColumns({"previous_version_id": F.coalesce("_before", "_head"), "next_version_id": F.col("_after"), "is_current": F.col("_after").isNull()})
    # written once: every output below is made from it, and the batch was made by many joins
    new = stored(new.withColumn("current_status", F.when(F.col("is_current"), "confirmed").otherwise("historical")), "accepted")
    first = new.where("_before is null").select("document_id", F.col("_head").alias("version_id"), F.col("version_id").alias("_follows")).where("version_id is not null")
    touched = new.select("document_id").distinct().withColumn("_closed", F.lit(True))

    renamed = F.col("previous_title").isNotNull()
    last = new.groupBy("document_id").agg(F.max_by(F.struct(*[F.col(c) for c in ("version_id", "revision_date", "effective_date", "source_file", "source_url", "source_page_url", "attachment_filename", "file_size", "sha256", "_department")]), F.struct(text.filled(F.col("revision_date")), "version_id")).alias("x"), F.max_by(F.when(renamed, F.col("_title")), F.when(renamed, F.struct(text.filled(F.col("revision_date")), "version_id"))).alias("_new_title"), F.array_sort(F.collect_set(F.when(renamed, F.col("previous_title")))).alias("_old_titles"))
    d = documents.join(last, "document_id", "left")
    hit = F.col("x").isNotNull()
    aliases = F.coalesce(_column(documents, "alternative_titles", "array<string>"), F.array().cast("array<string>"))
    shown = {
        "alternative_titles": F.when(hit & F.col("_new_title").isNotNull(), F.array_distinct(F.concat(aliases, F.col("_old_titles")))).otherwise(_column(documents, "alternative_titles", "array<string>")),
        "title": F.when(hit, F.coalesce("_new_title", "title")).otherwise(F.col("title")),
        "department": F.when(hit, F.coalesce("x._department", _column(documents, "department"))).otherwise(_column(documents, "department")),
        "original_filename": F.when(hit, F.col("x.attachment_filename")).otherwise(_column(documents, "original_filename")),
        "source_relative_path": F.when(hit, F.col("x.source_file")).otherwise(_column(documents, "source_relative_path")),
        "normalized_relative_path": F.when(hit, None).otherwise(_column(documents, "normalized_relative_path")),
        "current_status": F.when(hit, "confirmed").otherwise(_column(documents, "current_status")),
        "is_current": F.when(hit, True).otherwise(_column(documents, "is_current", "boolean")),
        "latest_version_id": F.when(hit, F.col("x.version_id")).otherwise(_column(documents, "latest_version_id")),
        "file_extension": F.when(hit, EXTENSION).otherwise(_column(documents, "file_extension")),
        "mime_type": F.when(hit, MIME_TYPE).otherwise(_column(documents, "mime_type")),
        "text_extraction_status": F.when(hit, PENDING).otherwise(_column(documents, "text_extraction_status")),
        "pdf_conversion_status": F.when(hit, NOT_GENERATED).otherwise(_column(documents, "pdf_conversion_status")),
        "pdf_relative_path": F.when(hit, None).otherwise(_column(documents, "pdf_relative_path")),
        "title_normalized": F.when(hit & F.col("_new_title").isNotNull(), None).otherwise(_column(documents, "title_normalized")),
        "updated_at": F.when(hit, updated_at).otherwise(_column(documents, "updated_at")),
    }
    shown |= {c: F.when(hit, F.col(f"x.{c}")).otherwise(_column(documents, c, "long" if c == "file_size" else "string")) for c in ("source_url", "source_page_url", "revision_date", "effective_date", "file_size", "sha256")}
    docs = d.withColumns(shown).drop("x", "_new_title", "_old_titles")

    old = versions.join(touched, "document_id", "left").join(first, ["document_id", "version_id"], "left")
    closed = F.coalesce(F.col("_closed"), F.lit(False)) & F.coalesce("is_current", F.lit(False))
    old = old.withColumns({"current_status": F.when(closed, "historical").otherwise(_column(versions, "current_status")), "is_current": F.when(closed, False).otherwise(F.col("is_current")), "next_version_id": F.coalesce("_follows", _column(versions, "next_version_id"))}).drop("_closed", "_follows")
    facts = docs.select("document_id", "title", *[_column(docs, c).alias(c) for c in ("version_group_id", "document_type", "category", "authority_level", "enactment_date")], F.col("department").alias("_own"))
    rows = new.join(facts, "document_id").withColumns({"department": F.coalesce("_department", "_own"), "normalized_file": F.lit(None).cast("string"), "change_summary": F.lit(CHANGE_SUMMARY), "version_confidence": F.lit("high"), "access_level": F.lit("public"), "mime_type": F.lit(MIME_TYPE), "text_extraction_status": F.lit(PENDING), "pdf_conversion_status": F.lit(NOT_GENERATED)})
    inner = ("_department", "_own", "_title", "_before", "_after", "_head", "source_id", "source_record_id", "attachment_filename", "captured_at")
    listed = rows.select(
        "document_type", F.col("document_id").alias("legacy_document_id"), F.col("source_url").alias("source_file"), F.col("source_file").alias("archive_file"), "sha256", "file_size", F.lit("copied").alias("status"), F.lit(True).alias("hash_verified"), "access_level",
        F.lit("official_web").alias("origin_type"), "source_id", "source_record_id", "source_page_url", "source_url", F.coalesce("captured_at", F.lit(updated_at)).alias("collected_at"),
    )
    return docs, old.unionByName(rows.drop(*inner), allowMissingColumns=True), manifest.unionByName(listed, allowMissingColumns=True)


def gate(batch: DataFrame, versions: DataFrame, raw: DataFrame, texts: DataFrame, pdfs: DataFrame, tool: str, tool_version: str) -> DataFrame:
    """(version_id, the seven checks, failed) of each record (version_id, sha256) after an update: metadata, source, state and derivatives. raw, texts and pdfs are (path, sha256) of what is there."""
    names = ("pdf_conversion_status", "pdf_relative_path", "pdf_sha256", "portable_conversion_status", "portable_extraction_tool", "portable_extraction_version", "portable_markdown_sha256", "normalized_file")
    v = versions.select("version_id", "source_file", "is_current", F.col("sha256").alias("_sha"), *[_column(versions, c).alias(c) for c in names], *[_column(versions, c, "double").alias(c) for c in ("pdf_pages", "portable_text_chars", "portable_hangul_chars", "portable_hangul_ratio", "portable_replacement_chars")])
    there = lambda files, key, out: files.select(F.col("path").alias(key), F.col("sha256").alias(out))
    j = batch.select("version_id", "sha256").join(v, "version_id", "left").join(there(raw, "source_file", "_raw"), "source_file", "left").join(there(texts, "normalized_file", "_text"), "normalized_file", "left").join(there(pdfs, "pdf_relative_path", "_pdf"), "pdf_relative_path", "left")
    cols = {c: F.col(c) for c in j.columns}
    portable, native = rules.portable_complete(cols, F.col("_text"), tool, tool_version), rules.native_complete(cols, F.col("_pdf"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    checks = {"metadata_sha256": yes(F.col("_sha") == F.col("sha256")), "source_sha256": yes(F.col("_raw") == F.col("sha256")), "current": yes(F.col("is_current")), "normalized": F.col("_text").isNotNull(), "portable_markdown_complete": portable, "native_pdf_complete": native}
    out = j.select("version_id", *[c.alias(n) for n, c in checks.items()]).withColumn("derivative_complete", F.col("portable_markdown_complete") | F.col("native_pdf_complete"))
    needed = ("metadata_sha256", "source_sha256", "current", "normalized", "derivative_complete")
    return out.withColumn("failed", F.array_compact(F.array(*[F.when(~F.col(n), F.lit(n)) for n in needed])))
