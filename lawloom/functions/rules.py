"""Ordered classification rules as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawloom.functions.text import ARTICLE, attachment_role, search_text, uni

# Marks of the kinds of sections, in the order in which they are tried.
TABLE_HEAD = r"현\s*행\s*\|\s*개\s*정\s*안"
COMPARISON = r"신\s*구\s*조문\s*대비|현\s*행\s*개\s*정\s*안"
REASON = r"개정\s*사유|제정\s*사유"
MAJOR = r"주요\s*(내용|개정)"
SUPPLEMENTARY = r"부\s*칙"
PROMULGATION = r"공포|일부개정안"
APPENDIX = r"별\s*표"
FORM = r"별\s*지|서\s*식"
# What a listed record can be, and how an old chunk can relate to new ones.
STATUSES = ("supporting_attachment", "present_hash", "present_metadata", "new_version_candidate", "new_document_candidate")
RELATIONS = ("unchanged", "modified", "split", "merged", "removed", "new")


def current_status(is_current: Column) -> Column:
    return F.when(is_current, "confirmed").when(~is_current, "historical").otherwise("unknown")


def authority_level(kind: Column) -> Column:
    return F.when(kind == "regulation", "university_rule").otherwise("university_guideline")


def bucket(kind: Column) -> Column:
    """The folder of a document's type."""
    return F.when(kind == "regulation", "regulations").otherwise("guidelines")


def classify_section(text: Column, path: Column, native: bool = False) -> Column:
    """struct(kind, scope, normative) of a section; the first rule that fits decides. ``native`` as in ``search_text``."""
    path = F.coalesce(path, F.lit(""))
    short = (path == "") & F.coalesce(F.length(text) <= 1200, F.lit(True))  # then both forms are the same
    whole = search_text(F.substring(text, 1, 3000), native)
    head = search_text(F.when(~short, F.concat(path, F.lit("\n"), F.substring(text, 1, 1200))), native)
    # both forms are made once, whatever number of rules looks at them
    forms = F.array(F.struct(whole.alias("body"), F.when(~short, head).alias("head")))
    return F.get(F.transform(forms, lambda x: _section_kind(x["body"], F.coalesce(x["head"], x["body"]))), F.lit(0))


def _section_kind(body: Column, value: Column) -> Column:
    article = value.rlike(uni(ARTICLE))
    rules = [
        ((F.regexp_count(body, F.lit(uni(ARTICLE))) >= 2) & ~F.substring(body, 1, 700).rlike(uni(TABLE_HEAD)), "operative_text", "primary", "normative"),
        (value.rlike(uni(COMPARISON)), "comparison_old", "secondary", "historical_context"),
        (value.rlike(uni(REASON)), "amendment_reason", "secondary", "non_normative"),
        (value.rlike(uni(MAJOR)), "major_changes", "secondary", "non_normative"),
        (value.rlike(uni(SUPPLEMENTARY)), "supplementary_provision", "primary", "normative"),
        (value.rlike(uni(PROMULGATION)) & ~article, "promulgation_notice", "secondary", "non_normative"),
        (value.rlike(uni(APPENDIX)), "appendix", "primary", "normative"),
        (value.rlike(uni(FORM)), "form", "primary", "normative"),
        (article, "operative_text", "primary", "normative"),
    ]
    out = F.struct(F.lit("unknown").alias("kind"), F.lit("secondary").alias("scope"), F.lit("unknown").alias("normative"))
    for test, kind, scope, normative in reversed(rules):
        out = F.when(test, F.struct(F.lit(kind).alias("kind"), F.lit(scope).alias("scope"), F.lit(normative).alias("normative"))).otherwise(out)
    return out


def source_status(filename: Column, hash_known: Column, date_known: Column, title_known: Column) -> Column:
    """What a listed record is against the known versions; the first that fits."""
    tests = (attachment_role(filename) == "supporting", hash_known, date_known, title_known)
    out = F.lit(STATUSES[-1])
    for test, status in reversed(list(zip(tests, STATUSES, strict=False))):
        out = F.when(test, status).otherwise(out)
    return out


def migration_relation(same_id: Column, same_text: Column, candidates: Column, inbound: Column) -> Column:
    return (
        F.when(same_id & same_text, "unchanged").when(same_id, "modified").when(candidates == 0, "removed").when(candidates > 1, "split").when(inbound > 1, "merged").otherwise("modified")
    )


def migration_flags(relation: Column, score: Column) -> tuple[Column, Column]:
    """(automatic, review): matched without doubt, and what a person has to look at."""
    automatic = relation.isin("unchanged", "modified") & F.coalesce(score >= 0.8, F.lit(False))
    return automatic, ~automatic


def extraction_status(extension: Column, text: Column, failed: Column) -> Column:
    """success, needs_ocr, failed or unsupported of a file by its extension, text and whether reading it failed."""
    has = F.coalesce(F.trim(text) != "", F.lit(False))
    known = extension.isin(".pdf", ".docx", ".hwpx")
    return F.when(~known, "unsupported").when(failed, "failed").when(has, "success").when(extension == ".pdf", "needs_ocr").otherwise("failed")


def copy_status(target_sha: Column, sha: Column, execute: bool) -> Column:
    """reused where the target holds the same bytes, else copied, or planned without ``execute``."""
    return F.when(target_sha.eqNullSafe(sha) & sha.isNotNull(), "reused").otherwise("copied" if execute else "planned")


def native_complete(v: dict[str, Column], actual_sha: Column) -> Column:
    """Whether a version's native PDF is whole; ``actual_sha`` is the hash of the file that is there."""
    full = (v["pdf_conversion_status"] == "success") & (v["pdf_relative_path"] != "") & (v["pdf_pages"] > 0) & (v["pdf_sha256"] == actual_sha)
    return F.coalesce(full, F.lit(False))


def portable_complete(v: dict[str, Column], actual_sha: Column, tool: str, tool_version: str | None = None) -> Column:
    """Whether a version's converted text is whole and good enough; without ``tool_version`` any one will do."""
    version = v["portable_extraction_version"] == tool_version if tool_version else v["portable_extraction_version"] != ""
    good = (F.coalesce(v["portable_text_chars"], F.lit(0)) >= 200) & (F.coalesce(v["portable_hangul_chars"], F.lit(0)) >= 80)
    good = good & (F.coalesce(v["portable_hangul_ratio"], F.lit(0.0)) >= 0.15) & (F.coalesce(v["portable_replacement_chars"], F.lit(0)) == 0)
    full = (v["portable_conversion_status"] == "success") & (v["portable_extraction_tool"] == tool) & version & (v["normalized_file"] != "") & (v["portable_markdown_sha256"] == actual_sha)
    return F.coalesce(full & good, F.lit(False))


def conversion_outcome(exists: Column, force: bool, unchanged: Column, errors: Column) -> Column:
    """reused, force_required, converted or failed of a text to be converted: a good text that is there unchanged is used again."""
    bad = F.size(errors) > 0
    fresh = F.when(bad, "failed").otherwise("converted")
    return fresh if force else F.when(~exists, fresh).when(F.coalesce(unchanged, F.lit(False)) & ~bad, "reused").otherwise("force_required")
