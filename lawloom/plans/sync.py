"""Whole runs: a reviewed update from plan to proof, and a full rebuild."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.functions import text
from lawloom.operators import catalog, chunking, documents, search, updates, validate, versions
from lawloom.sources.shared import new_path, stored
from lawloom.sources.snapshots import Snapshots, Transaction


@dataclass
class Corpus:
    """The tables of a corpus; texts are (normalized_file, text)."""

    documents: DataFrame
    versions: DataFrame
    manifest: DataFrame
    texts: DataFrame
    chunks: DataFrame


def built(spark: SparkSession, c: Corpus, **budget: int) -> Corpus:
    """Versions linked anew, the front matter of their texts set to their state, and chunks of the versions that have none. RuntimeError where a kept chunk would change."""
    v, d = versions.build_versions(c.versions, c.documents)
    v, d = stored(v, "versions"), stored(d, "documents")
    named = c.texts.join(v.select("normalized_file", "version_id"), "normalized_file")
    synced = versions.synced_markdown(named.select("version_id", "text"), v)
    texts = stored(named.select("normalized_file", "version_id").join(synced.select("version_id", "text"), "version_id").drop("version_id"), "texts")
    with_text = v.join(texts, "normalized_file", "left").withColumn("normalized_file", F.when(F.col("text").isNotNull(), F.col("normalized_file")))
    chunks = stored(chunking.make_chunks("incremental", with_text, d, c.chunks, canonical=True, **budget), "chunks")
    return Corpus(d, v, c.manifest, texts, chunks)


def proven(spark: SparkSession, c: Corpus, cases: list[dict], top_k: int = 5) -> tuple[DataFrame, DataFrame, str]:
    """(checks, evaluation, index path) of a built corpus. RuntimeError where a check fails or the evaluation does."""
    checks = stored(validate.validate(c.documents, c.versions, c.chunks, c.manifest, texts=c.texts), "checks")
    failed = [r.check for r in checks.where("status = 'FAIL'").collect()]
    if failed:
        raise RuntimeError(f"checks failed: {failed}")
    path = new_path(spark, "search-index")
    search.write_index(search.index_rows(c.chunks, c.versions, c.documents), path)
    result = search.evaluate_cases(spark, path, cases, top_k)
    if not result.first().passed:
        raise RuntimeError("the evaluation of the search failed")
    return checks, result, path


def update_gate(spark: SparkSession, c: Corpus, batch: DataFrame, downloads: DataFrame, convert: Callable[[DataFrame], DataFrame], cases: list[dict], now: str, tool: str, tool_version: str, institution: str | None = None, **budget: int) -> tuple[Corpus, DataFrame]:
    """(corpus, gate) after a reviewed batch: validated, applied, converted, rebuilt and proven, in this order.

    downloads: (file_name, actual_sha256, actual_size); ``convert`` makes (version_id, body) of the new versions.
    RuntimeError at the first step that refuses; the given corpus is not touched, so nothing is half applied.
    """
    checked = stored(updates.validate_batch(batch, c.documents, c.versions, downloads), "batch")
    if updates.refused(checked).first().refused:
        raise RuntimeError(f"batch refused: {[(r.document_id, r.error_code) for r in checked.where('error_code is not null').limit(20).collect()]}")
    d, v, m = (stored(x, "applied") for x in updates.apply_batch(checked, c.documents, c.versions, c.manifest, now))
    records = checked.select(F.col("new_version_id").alias("version_id"), "sha256")
    raw = checked.select(F.col("archive_file").alias("path"), F.col("actual_sha256").alias("sha256"))
    bodies = stored(convert(v.join(records, ["version_id", "sha256"], "left_semi")), "bodies")
    there = c.texts.select(F.col("normalized_file").alias("path"), "text", F.sha2("text", 256).alias("sha256"))
    made = stored(documents.convert(records, v, d, raw, bodies, there, institution=institution), "converted")
    bad = made.where("size(errors) > 0").limit(20).collect()
    if bad:
        raise RuntimeError(f"conversion refused: {[(r.version_id, r.errors) for r in bad]}")
    fresh = made.where("outcome = 'converted'").select(F.col("path").alias("normalized_file"), "text")
    done = made.select("version_id", F.col("path").alias("_file"), F.sha2("text", 256).alias("_sha"), *[F.col(x).alias(f"_{x}") for x in ("text_chars", "hangul_chars", "hangul_ratio", "replacement_chars")])
    col = lambda n: F.col(n) if n in v.columns else F.lit(None)
    hit = F.col("_file").isNotNull()
    fields = {"normalized_file": ("_file", "string"), "portable_markdown_sha256": ("_sha", "string"), "portable_text_chars": ("_text_chars", "long"), "portable_hangul_chars": ("_hangul_chars", "long"), "portable_hangul_ratio": ("_hangul_ratio", "double"), "portable_replacement_chars": ("_replacement_chars", "long")}
    states = {"portable_conversion_status": "success", "portable_extraction_tool": tool, "portable_extraction_version": tool_version, "text_extraction_status": "success"}
    v = v.join(done, "version_id", "left").withColumns({n: F.when(hit, F.col(x)).otherwise(col(n).cast(kind)) for n, (x, kind) in fields.items()} | {n: F.when(hit, x).otherwise(col(n).cast("string")) for n, x in states.items()}).drop(*[x for x, _ in fields.values()])
    new = built(spark, Corpus(d, v, m, c.texts.unionByName(fresh), c.chunks), **budget)
    new.versions = stored(new.versions.drop("portable_markdown_sha256").join(new.texts.select("normalized_file", F.sha2("text", 256).alias("_sha")), "normalized_file", "left").withColumn("portable_markdown_sha256", F.when(F.col("portable_conversion_status") == "success", F.col("_sha"))).drop("_sha"), "versions")
    proven(spark, new, cases)
    texts = new.texts.select(F.col("normalized_file").alias("path"), F.sha2("text", 256).alias("sha256"))
    gate = updates.gate(records, new.versions, raw, texts, texts.limit(0), tool, tool_version)
    failed = gate.where("size(failed) > 0").limit(20).collect()
    if failed:
        raise RuntimeError(f"gate failed: {[(r.version_id, r.failed) for r in failed]}")
    return new, gate


def full_sync(spark: SparkSession, candidates: DataFrame, manifest: DataFrame, extraction: DataFrame, bodies: DataFrame, cases: list[dict], own_domain: str = "example.org", institution: str = "", **budget: int) -> tuple[Corpus, DataFrame]:
    """(corpus, checks) built from an archive's candidates: texts with sensitive data are kept out, the rest is normalised, chunked and proven.

    bodies: (sha256, body) of extracted texts. manifest and extraction as in ``documents.normalize``.
    """
    found = catalog.security_findings(bodies.withColumnRenamed("body", "text"), own_domain).select("sha256")
    free = catalog.split_restricted(candidates, found)[0]
    d, v = documents.normalize(free, manifest, extraction)
    v = v.withColumn("source_url", F.lit(None).cast("string")) if "source_url" not in v.columns else v
    cols = {c: F.col(c) if c in v.columns else F.lit(None).cast("string") for c in ("document_id", "version_id", "document_type", "title", "is_current", "current_status", "enactment_date", "revision_date", "effective_date", "department", "source_url", "source_file", "sha256")}
    texts = v.where("normalized_file is not null").join(bodies, "sha256").select("normalized_file", documents.version_markdown(cols, F.lit(institution), text.strip(F.col("body"))).alias("text"))
    kept = manifest.join(v.select("sha256").distinct(), "sha256", "left_semi")
    none = spark.createDataFrame([], "chunk_id string, version_id string, document_id string, text string, section_path string, article_no string, article_title string, chunk_index int")
    c = built(spark, Corpus(stored(d, "documents"), stored(v, "versions"), kept, stored(texts, "texts"), none), **budget)
    return c, proven(spark, c, cases)[0]


TABLES = ("documents", "versions", "manifest", "texts", "chunks")


def publish(spark: SparkSession, path: str, c: Corpus, base: int | None = None) -> int:
    """The tables of a corpus as the next snapshot of the log at ``path``, all together or none; returns its number.

    ``base`` is the snapshot that the corpus was made from, the last one by default. Conflict where another writer
    has published since; a writer that stops before leaves the old state.
    """
    log = Snapshots(spark, path)
    tx = Transaction(log, log.state(base))
    for name in TABLES:
        tx.replace(name, getattr(c, name))
    return tx.commit()


def published(spark: SparkSession, path: str, number: int | None = None) -> Corpus:
    """The corpus at a snapshot, the last one by default."""
    log = Snapshots(spark, path)
    number = log.latest() if number is None else number
    return Corpus(*[log.read(name, number) for name in TABLES])
