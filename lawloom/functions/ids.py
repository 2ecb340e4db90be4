"""Stable identifiers and canonical paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lawloom.functions import rules, text

# Id prefixes by document type.
PREFIXES = {"regulation": "REG", "guideline": "GDL", "rule": "RUL", "manual": "MAN"}


def _seed(kind: Column, key: Column, discriminator: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", kind, key, F.coalesce(discriminator, F.lit(""))), 256), 1, 12)


def document_id(kind: Column, key: Column, discriminator: Column) -> Column:
    prefix = F.lit("ETC")
    for name, short in PREFIXES.items():
        prefix = F.when(kind == name, short).otherwise(prefix)
    return F.concat(prefix, F.lit("-"), _seed(kind, key, discriminator))


def version_group_id(kind: Column, key: Column, discriminator: Column) -> Column:
    return F.concat(F.lit("VG-"), _seed(kind, key, discriminator))


def version_id(date: Column, sha: Column) -> Column:
    digits = F.regexp_replace(F.coalesce(date, F.lit("")), "[^0-9]", "")
    return F.concat(F.lit("VER-"), F.when(digits == "", "unknown").otherwise(digits), F.lit("-"), F.substring(sha, 1, 8))


def chunk_id(version: Column, article_no: Column, article: Column, part: Column) -> Column:
    """From the version, the article's place from 1, its number (else the place) and the part from 1."""
    name = F.regexp_replace(F.coalesce(article, F.concat(F.lit("section-"), article_no.cast("string"))), "[^0-9A-Za-z가-힣-]", "")
    number = lambda n, digits: F.lpad(n.cast("string"), F.greatest(F.lit(digits), F.length(n.cast("string"))), F.lit("0"))
    return F.concat(F.lit("CHK-"), version, F.lit("-"), number(article_no, 4), F.lit("-"), name, F.lit("-"), number(part, 3))


def content_digest(content: Column) -> Column:
    """The hash of a file's bytes, or the one that a large-file pointer names."""
    named = F.regexp_extract(F.substring(content, 1, 1024).cast("string"), r"(?md)^oid sha256:([0-9a-f]{64})$", 1)
    return F.when((F.octet_length(content) < 1024) & (named != ""), named).otherwise(F.sha2(content, 256))


def raw_path(kind: Column, source: Column, record: Column, filename: Column) -> Column:
    """Where an official file is kept; null without a file name."""
    return F.concat(F.lit("sources/raw/"), rules.bucket(kind), F.lit("/official/"), text.safe_component(source), F.lit("/"), text.safe_component(record), F.lit("/"), F.nullif(filename, F.lit("")))


def archive_path(kind: Column, relative: Column) -> Column:
    """Where a file of the archive is kept: its path after the folder of its type."""
    path = F.regexp_replace(relative, r"\\", "/")
    anchor = F.concat(F.lit("data/raw/"), rules.bucket(kind), F.lit("/"))
    at = F.instr(path, anchor)
    return F.concat(F.lit("sources/raw/"), rules.bucket(kind), F.lit("/"), F.when(at > 0, F.substring(path, at + F.length(anchor), F.length(path))).otherwise(path))


def normalized_path(kind: Column, document: Column, version: Column) -> Column:
    return F.concat(F.lit("corpus/normalized/"), rules.bucket(kind), F.lit("/"), document, F.lit("/"), version, F.lit(".md"))
