"""Integrity checks: one row a check (check, status, failures)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.functions import rules, text
from lawloom.operators.schema_rules import row_rules
from lawloom.sources.shared import stored

# What the rows of each table must be, as JSON Schema; ``schema_rules`` compiles them.
_DIGEST = {"type": "string", "pattern": "^[0-9a-f]{64}$"}
_NAME = {"type": "string", "minLength": 1}
_COUNT, _POSITIVE = {"type": "integer", "minimum": 0}, {"type": "integer", "minimum": 1}
_MAYBE = {"type": ["string", "null"]}
_ACCESS = {"enum": ["public", "internal", "restricted", "review_required"]}
_STATE = {
    "is_latest_version": {"type": "boolean"},
    "validity_status": {"enum": ["in_force", "superseded", "abolished", "expired", "unknown"]},
    "status_confidence": {"enum": ["confirmed", "probable", "unknown"]},
}
_URL_QUALITY = {"enum": ["detail", "list_only", "attachment_only", "unknown"]}
_EVIDENCE = {"validity_evidence": _MAYBE, "validity_checked_at": {"type": ["string", "null"], "format": "date-time"}, "source_url_quality": _URL_QUALITY}
SCHEMAS: dict[str, dict] = {
    "documents": {
        "required": ["document_id", "document_type", "title", "access_level", "version_group_id", "sha256"],
        "properties": {
            "document_id": {"type": "string", "pattern": "^(REG|GDL|RUL|MAN|ETC)-[0-9a-f]{12}$"},
            "document_type": {"enum": ["regulation", "guideline", "rule", "manual", "notice", "form", "reference", "unknown"]},
            "title": _NAME, "alternative_titles": {"type": "array", "items": {"type": "string"}}, "access_level": _ACCESS, "version_group_id": {"type": "string"}, "sha256": _DIGEST, "latest_version_id": _MAYBE, **_STATE, **_EVIDENCE,
        },
    },
    "versions": {
        "required": ["version_id", "document_id", "version_group_id", "source_file", "sha256", "current_status", "access_level"],
        "properties": {
            "version_id": {"type": "string", "pattern": "^VER-(unknown|[0-9]+)-[0-9a-f]{8}$"}, "document_id": {"type": "string"}, "sha256": _DIGEST,
            "current_status": {"enum": ["confirmed", "candidate", "unknown", "historical"]}, "access_level": _ACCESS, **_STATE, **_EVIDENCE,
        },
    },
    "chunks": {
        "required": ["chunk_id", "document_id", "version_id", "text", "text_for_embedding", "token_count", "source_file", "sha256", "citation_label", "access_level"],
        "properties": {
            "chunk_id": {"type": "string", "minLength": 10}, "text": _NAME, "text_for_embedding": _NAME, "token_count": _POSITIVE, "sha256": _DIGEST, "access_level": {"const": "public"},
            "section_kind": {"enum": ["promulgation_notice", "amendment_reason", "major_changes", "comparison_old", "comparison_new", "operative_text", "supplementary_provision", "appendix", "form", "unknown"]},
            "retrieval_scope": {"enum": ["primary", "secondary"]}, "normative_status": {"enum": ["normative", "historical_context", "non_normative", "unknown"]}, **_STATE,
        },
    },
    "source_manifest": {
        "required": ["archive_file", "sha256", "file_size", "status", "access_level"],
        "properties": {"source_id": _MAYBE, "source_record_id": _MAYBE, "archive_file": _NAME, "sha256": _DIGEST, "file_size": _POSITIVE, "hash_verified": {"type": "boolean"}, "access_level": _ACCESS, "source_url_quality": _URL_QUALITY},
    },
    "conversions": {
        "required": ["version_id", "document_id", "source_file", "source_sha256", "normalized_file", "normalized_sha256", "tool", "tool_version", "status"],
        "properties": {
            "version_id": {"type": "string"}, "document_id": {"type": "string"}, "source_sha256": _DIGEST, "normalized_sha256": _DIGEST, "status": {"enum": ["converted", "failed", "skipped", "reused"]},  # converters also write the last
            "text_chars": _COUNT, "hangul_chars": _COUNT, "hangul_ratio": {"type": "number", "minimum": 0, "maximum": 1}, "replacement_chars": _COUNT,
        },
    },
    "batch_records": {
        "required": ["source_id", "source_record_id", "document_id", "version_id", "document_type", "title", "attachment_url", "file_size", "sha256"],
        "properties": {"document_type": {"enum": ["regulation", "guideline"]}, "file_size": _POSITIVE, "sha256": _DIGEST},
    },
    "corpus_manifest": {
        "required": ["corpus_id", "documents", "versions", "current_documents", "chunks", "sha256"],
        "properties": {"corpus_id": _NAME, "generated_at": {"type": "string"}, "documents": _COUNT, "versions": _COUNT, "current_documents": _COUNT, "chunks": _COUNT, "sha256": {"type": "object", "required": ["documents", "chunks"], "properties": {"documents": _DIGEST, "chunks": _DIGEST}}},
    },
    "migration_map": {
        "required": ["document_id", "version_id", "old_chunk_id", "new_chunk_ids", "relation", "old_text_sha256", "new_text_sha256", "old_location", "new_locations", "overlap_scores", "evidence", "automatic_match", "review_required"],
        "properties": {
            "document_id": {"type": "string"}, "version_id": {"type": "string"}, "old_chunk_id": _MAYBE, "new_chunk_ids": {"type": "array", "items": {"type": "string"}, "uniqueItems": True}, "relation": {"enum": ["unchanged", "modified", "split", "merged", "removed", "new"]},
            "old_text_sha256": _MAYBE, "new_text_sha256": {"type": "array", "items": {"type": "string"}}, "old_location": {"type": ["object", "null"]}, "new_locations": {"type": "array", "items": {"type": "object"}},
            "overlap_scores": {"type": "array", "items": {"type": "number", "minimum": 0, "maximum": 1}}, "evidence": {"type": "string"}, "automatic_match": {"type": "boolean"}, "review_required": {"type": "boolean"},
        },
        "additionalProperties": False,
    },
}
# Fields of a version that its text's front matter repeats.
FRONT_FIELDS = ("document_id", "version_id", "title", "sha256", "is_current", "current_status")


def _row(df: DataFrame, name: str, level: str = "FAIL") -> DataFrame:
    """(check, level, failures) of a table of failures."""
    return df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check"), F.lit(level).alias("level"), "failures")


def _row_checks(df: DataFrame, checks: list[tuple[str, str, Column]], schema: dict) -> DataFrame:
    """(check, level, failures) of all checks of single rows and of the schema, in one pass over the table."""
    rules = row_rules(df, schema)
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, (_, _, c) in enumerate(checks)]
    broken = reduce(lambda a, b: a + b, [F.count_if(r.broken) for r in rules], F.lit(0).cast("long"))
    each = [F.struct(F.lit(n).alias("check"), F.lit(level).alias("level"), F.col(f"c{i}").alias("failures")) for i, (n, level, _) in enumerate(checks)]
    row = df.agg(*counts, broken.alias("shapes"))
    return row.select(F.inline(F.array(*each, F.struct(F.lit("shapes").alias("check"), F.lit("FAIL").alias("level"), F.col("shapes").alias("failures")))))


def repeated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def asymmetric_links(versions: DataFrame) -> DataFrame:
    """Links to versions that are missing, of another document, or do not point back. Versions of different documents may share an id, so a link is right if one of its document points back."""
    v = versions.select("version_id", "document_id", "previous_version_id", "next_version_id")
    way = lambda name: F.struct(F.lit(name).alias("way"), F.nullif(F.col(f"{name}_version_id"), F.lit("")).alias("to"))
    ends = v.select("version_id", "document_id", F.explode(F.array(way("next"), way("previous"))).alias("x")).select("version_id", "document_id", "x.*").where("to is not null")
    other = v.select(F.col("version_id").alias("v"), F.col("document_id").alias("d"), F.col("previous_version_id").alias("p"), F.col("next_version_id").alias("n"))
    back = F.when(F.col("way") == "next", F.col("p")).otherwise(F.col("n"))
    return ends.join(other, (F.col("to") == F.col("v")) & F.col("document_id").eqNullSafe(F.col("d")) & F.col("version_id").eqNullSafe(back), "left_anti")


def chain_cycles(versions: DataFrame) -> DataFrame:
    """(version_id) of versions from which the chain of next versions never ends.

    Pointers are doubled; a chain that has ended leaves the table, so each round is smaller, and the rounds are
    the logarithm of the longest chain. A round is written before the next one reads it, so plans do not grow.
    What is left when the steps exceed the number of versions runs in a circle. Versions of different documents
    may share an id; a pointer then means the one of its own document, if there is one.
    """
    owner = F.coalesce(F.col("document_id").cast("string"), F.lit("")) if "document_id" in versions.columns else F.lit("")
    step = stored(versions.groupBy(owner.alias("d"), "version_id").agg(F.max(F.nullif("next_version_id", F.lit(""))).alias("to")), "steps")
    total, taken = step.count(), 1
    own = step.select("d", F.col("version_id").alias("to"), F.lit(True).alias("own"))
    known = step.groupBy(F.col("version_id").alias("to")).agg(F.min("d").alias("other"))
    place = step.where("to is not null").join(known, "to").join(own, ["d", "to"], "left")
    step = stored(place.select("d", "version_id", F.when(F.col("own"), F.col("d")).otherwise(F.col("other")).alias("to_d"), "to"), "steps")
    while taken <= total and not step.isEmpty():
        hop = step.select(F.col("d").alias("to_d"), F.col("version_id").alias("to"), F.col("to_d").alias("next_d"), F.col("to").alias("next"))
        step = stored(step.join(hop, ["to_d", "to"]).select("d", "version_id", F.col("next_d").alias("to_d"), F.col("next").alias("to")), "steps")
        taken *= 2
    return step.select("version_id")


def digest_mismatches(rows: DataFrame, files: DataFrame, path: str = "archive_file") -> DataFrame:
    """Rows (path, sha256) whose file is missing or has another hash; files are (path, sha256), pointers with the hash they name."""
    there = files.select(F.col("path").alias(path), F.col("sha256").alias("_there"))
    return rows.join(there, path, "left").where(~F.col("sha256").eqNullSafe(F.col("_there")))


def unlinked_versions(versions: DataFrame, manifest: DataFrame) -> DataFrame:
    """Versions whose file and hash the manifest does not have together."""
    return versions.join(manifest.select(F.col("archive_file").alias("source_file"), "sha256"), ["source_file", "sha256"], "left_anti")


def missing_files(versions: DataFrame, files: DataFrame) -> DataFrame:
    """Versions whose source file, or text file if they name one, is not there; files are (path)."""
    paths = files.select("path").distinct()
    v = versions.join(paths.select(F.col("path").alias("source_file"), F.lit(True).alias("_s")), "source_file", "left")
    v = v.join(paths.select(F.col("path").alias("normalized_file"), F.lit(True).alias("_n")), "normalized_file", "left")
    return v.where(F.col("_s").isNull() | ((text.filled(F.col("normalized_file")) != "") & F.col("_n").isNull())).select("version_id")


def derivative_counts(versions: DataFrame, files: DataFrame, tool: str) -> DataFrame:
    """One row: native, portable, incomplete, false_pdf and false_portable of versions with an .hwp source; files are (path, sha256)."""
    col = lambda c, kind="string": F.col(c) if c in versions.columns else F.lit(None).cast(kind)
    names = ("pdf_relative_path", "pdf_sha256", "pdf_conversion_status", "portable_conversion_status", "portable_extraction_tool", "portable_extraction_version", "portable_markdown_sha256", "normalized_file")
    v = versions.where(F.lower("source_file").endswith(".hwp")).select("version_id", *[col(c).alias(c) for c in names], *[col(c, "double").alias(c) for c in ("pdf_pages", "portable_text_chars", "portable_hangul_chars", "portable_hangul_ratio", "portable_replacement_chars")])
    there = lambda key, out: files.select(F.col("path").alias(key), F.col("sha256").alias(out))
    v = v.join(there("pdf_relative_path", "_pdf"), "pdf_relative_path", "left").join(there("normalized_file", "_text"), "normalized_file", "left")
    cols = {c: F.col(c) for c in v.columns}
    v = v.withColumns({"_native": rules.native_complete(cols, F.col("_pdf")), "_portable": rules.portable_complete(cols, F.col("_text"), tool)})
    claims_pdf = (text.filled(F.col("pdf_relative_path")) != "") | (text.filled(F.col("pdf_sha256")) != "") | F.coalesce(F.col("pdf_conversion_status") == "success", F.lit(False))
    return v.agg(F.count_if("_native").alias("native"), F.count_if("_portable").alias("portable"), F.count_if(~F.col("_native") & ~F.col("_portable")).alias("incomplete"), F.count_if(claims_pdf & ~F.col("_native")).alias("false_pdf"), F.count_if((text.filled(F.col("portable_conversion_status")) != "") & ~F.col("_portable")).alias("false_portable"))


def table_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(digest, n, m): rows that one table has more often than the other, by their JSON; fields by name, nulls included."""
    names = sorted({*a.columns, *b.columns})
    form = lambda df: df.select(F.sha2(F.to_json(F.struct(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in names]), {"ignoreNullFields": "false"}), 256).alias("digest"))
    both = form(a).select("digest", F.lit(1).alias("x"), F.lit(0).alias("y")).unionByName(form(b).select("digest", F.lit(0).alias("x"), F.lit(1).alias("y")))
    return both.groupBy("digest").agg(F.sum("x").alias("n"), F.sum("y").alias("m")).where("n <> m")


def front_matter_errors(versions: DataFrame, texts: DataFrame) -> DataFrame:
    """(version_id, error): texts (normalized_file, text) of versions without front matter, and fields in it that differ from the version's. Texts that are not there are left out."""
    j = versions.join(texts, "normalized_file").withColumn("_f", text.front_matter(F.col("text")))
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null")) if c == "is_current" else text.yaml_value(F.col(c))
    differs = lambda c: F.array_contains(F.map_keys("_f"), c) & ~F.col("_f")[c].eqNullSafe(shown(c))
    tests = [F.when(differs(c), F.lit(c)) for c in FRONT_FIELDS if c in versions.columns]
    errors = F.when(text.front_block(F.col("text")) == "", F.array(F.lit("missing"))).otherwise(F.array_compact(F.array(*tests)))
    return j.select("version_id", F.explode(errors).alias("error"))


def manifest_errors(manifest: DataFrame, documents: DataFrame, versions: DataFrame, chunks: DataFrame, digests: dict[str, Column] | None = None) -> DataFrame:
    """(field) of a one-row manifest that differs from the tables: its counts, and its hashes against ``digests``."""
    counts = [df.agg(F.count("*").alias(f"_{name}")) for name, df in (("documents", documents), ("versions", versions), ("chunks", chunks))]
    row = reduce(lambda a, b: a.join(b), counts, manifest)  # tables of one row
    tests = [F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in ("documents", "versions", "chunks")]
    tests += [F.when(~F.col(f"sha256.{c}").eqNullSafe(d), F.lit(f"sha256.{c}")) for c, d in (digests or {}).items()]
    return row.select(F.explode(F.array_compact(F.array(*tests))).alias("field"))


def validate(documents: DataFrame, versions: DataFrame, chunks: DataFrame, manifest: DataFrame | None = None, files: DataFrame | None = None, texts: DataFrame | None = None, archive: DataFrame | None = None, subsets: dict[str, DataFrame] | None = None, corpus: DataFrame | None = None, export: DataFrame | None = None, conversions: DataFrame | None = None, batches: DataFrame | None = None, tool: str = "unhwp", most: int = 1200, schemas: dict[str, dict] | None = None) -> DataFrame:
    """(check, status, failures), a row for each check that its tables allow.

    manifest: the source manifest; files: (path, sha256) of the repository; texts: (normalized_file, text);
    archive: (path, sha256) of the read-only archive; subsets: current_documents, latest_documents and
    document_catalog as written; corpus: the one-row manifest; export: chunks of an exported bundle; schemas: JSON
    Schema of each table's rows (``SCHEMAS`` by default; the one-row manifest is held against its own only where it is among them).
    """
    v, d, c = versions, documents, chunks
    checks: list[DataFrame] = []
    schemas = schemas or {k: v for k, v in SCHEMAS.items() if k != "corpus_manifest"}

    def add(df: DataFrame, name: str, level: str = "FAIL") -> None:
        checks.append(_row(df, name, level))

    if manifest is not None and files is not None:
        add(digest_mismatches(manifest, files), "raw_copy_hash")
    if manifest is not None and archive is not None:
        legacy = manifest.where(F.coalesce(F.col("origin_type"), F.lit("legacy_archive")) == "legacy_archive") if "origin_type" in manifest.columns else manifest
        add(digest_mismatches(legacy, archive, "source_file"), "source_archive_unchanged")
    for df, key in ((d, "document_id"), (v, "version_id"), (c, "chunk_id")):
        add(repeated(df, key), f"{key}_unique")
    unknown = [c.join(df.select(k).distinct(), k, "left_anti").select("chunk_id") for df, k in ((d, "document_id"), (v, "version_id"))]
    strays = unknown[0].unionByName(unknown[1].join(unknown[0], "chunk_id", "left_anti"))  # one of both counts once
    add(strays, "chunk_source_known")
    add(asymmetric_links(v), "version_links_symmetric")
    add(chain_cycles(v), "version_chain_acyclic")
    if manifest is not None:
        add(unlinked_versions(v, manifest), "version_in_manifest")
    own = v.select(F.col("version_id").alias("_v"), F.col("document_id").alias("_d"))
    add(d.join(own, (F.col("latest_version_id") == F.col("_v")) & F.col("document_id").eqNullSafe(F.col("_d")), "left_anti"), "latest_belongs_to_document", "WARNING")
    if files is not None:
        add(missing_files(v, files), "files_exist")
        counts = derivative_counts(v, files, tool)
        checks.append(counts.select(F.lit("derivatives_complete").alias("check"), F.lit("FAIL").alias("level"), (F.col("incomplete") + F.col("false_pdf") + F.col("false_portable")).alias("failures")))
    add(v.where("is_current").groupBy("document_id").agg(F.count("*").alias("n")).where("n > 1"), "single_current_version")

    empty = lambda name: text.filled(F.col(name)) == ""
    lacks = any(f not in v.columns for f in ("is_latest_version", "validity_status", "status_confidence", "source_url_quality"))
    rows = {"versions": [("status_fields_present", "WARNING", F.lit(lacks))]}
    if "normalized_file" in v.columns:
        rows["versions"].append(("version_has_text", "WARNING", empty("normalized_file")))
    else:
        add(v.join(c, "version_id", "left_anti"), "version_has_text", "WARNING")
    rows["chunks"] = [
        ("chunk_not_empty", "FAIL", text.strip(text.filled(F.col("text"))) == ""), ("chunk_within_limit", "FAIL", F.col("token_count") > most), ("chunk_public", "FAIL", F.coalesce("access_level", F.lit("")) != "public"),
        ("chunk_citable", "FAIL", reduce(lambda a, b: a | b, [empty(k) for k in ("title", "source_file", "sha256", "citation_label") if k in c.columns])),
    ]
    tables = {"documents": d, "versions": v, "chunks": c, "source_manifest": manifest, "conversions": conversions, "batch_records": batches, "corpus_manifest": corpus if "corpus_manifest" in schemas else None}
    checks += [_row_checks(df, rows.get(name, []), schemas[name]) for name, df in tables.items() if df is not None]

    expected = {"current_documents": d.where("is_current and latest_version_id is not null"), "latest_documents": d.where("latest_version_id is not null"), "document_catalog": d}
    for name, df in (subsets or {}).items():
        add(table_difference(df, expected[name]), f"{name}_equal")
    if corpus is not None:
        add(manifest_errors(corpus, d, v, c), "manifest_counts")
    if texts is not None:
        add(front_matter_errors(v, texts), "front_matter", "WARNING")
    if export is not None:
        add(export, "duplicate_export", "WARNING")
        add(table_difference(export, c), "export_up_to_date", "WARNING")
    found = reduce(DataFrame.unionByName, checks).groupBy("check").agg(F.sum("failures").alias("failures"), F.max("level").alias("level"))
    return found.select("check", F.when(F.col("failures") == 0, "PASS").otherwise(F.col("level")).alias("status"), "failures")


def status_counts(checks: DataFrame) -> DataFrame:
    """One row: how many checks pass, warn and fail, and whether the corpus is accepted."""
    n = checks.agg(*[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "WARNING", "FAIL")])
    return n.withColumn("accepted", F.col("fail") == 0)


def rows_digest(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """(digest, rows): an order-sensitive digest of all rows, which ``order`` numbers from 0 without gaps.

    Hashes of a thousand neighbours are hashed to one, four times over, so no task holds more than a thousand
    hashes and the result covers 10^12 rows.
    """
    row = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)
    level = df.select(F.col(order).cast("long").alias("o"), row.alias("h"), F.lit(1).cast("long").alias("n"))
    for _ in range(4):
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "h"))), lambda x: x["h"]), "")
        level = level.groupBy(F.expr("o div 1000").alias("p")).agg(F.sha2(joined, 256).alias("h"), F.sum("n").alias("n")).withColumnRenamed("p", "o")
    return level.select(F.col("h").alias("digest"), F.col("n").alias("rows"))
