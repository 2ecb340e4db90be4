"""Version chains, current-version conflicts, document grouping and exact copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lawloom.functions import ids, rules, text

# Words of the conflict and duplicate tables.
CONFLICT, CONFLICT_NOTE = "복수 버전이 현행본으로 표시됨", "현행본 자동 확정 해제"
DUPLICATE_ACTION = "논리 버전 하나로 연결하고 출처 발생 경로 보존"


def chain() -> WindowSpec:
    """Versions of a document in order: undated ones first, then by date, then by hash."""
    return Window.partitionBy("document_id").orderBy(F.col("revision_date").asc_nulls_first(), "sha256")


def version_chain(versions: DataFrame) -> DataFrame:
    """Adds previous_version_id, next_version_id and position: undated versions first, then by date and hash."""
    return versions.withColumns({"previous_version_id": F.lag("version_id").over(chain()), "next_version_id": F.lead("version_id").over(chain()), "position": F.row_number().over(chain())})


def resolve_current(versions: DataFrame) -> DataFrame:
    """Where several versions of a document claim to be current, none is: is_current null, status unknown; other statuses stay, or follow from is_current where there is none."""
    many = F.count_if(F.col("is_current")).over(Window.partitionBy("document_id")) > 1
    lost = many & F.coalesce("is_current", F.lit(False))
    had = F.col("current_status") if "current_status" in versions.columns else rules.current_status(F.col("is_current"))
    return versions.withColumns({"conflict": lost, "current_status": F.when(lost, "unknown").otherwise(had), "is_current": F.when(lost, None).otherwise(F.col("is_current"))})


def current_conflicts(versions: DataFrame) -> DataFrame:
    """Neighbouring pairs of versions that claim to be current."""
    pairs = versions.where("is_current").withColumns({"other": F.lead("version_id").over(chain()), "other_sha": F.lead("sha256").over(chain()), **({"other_file": F.lead("source_file").over(chain())} if "source_file" in versions.columns else {})}).where("other is not null")
    files = ("source_file", "other_file") if "source_file" in versions.columns else ()
    return pairs.select("document_id", F.col("version_id").alias("first_version_id"), F.col("other").alias("second_version_id"), F.col("sha256").alias("first_sha256"), F.col("other_sha").alias("second_sha256"), *files)


def conflict_rows(versions: DataFrame) -> DataFrame:
    """The conflict table: a row for each pair of ``current_conflicts``; versions have source_file too."""
    c = current_conflicts(versions)
    name = F.concat(F.lit("CUR-"), F.substring("first_sha256", 1, 6), F.lit("-"), F.substring("second_sha256", 1, 6))
    return c.select(
        name.alias("conflict_id"), F.col("document_id").alias("document_id_1"), F.col("document_id").alias("document_id_2"), F.lit(CONFLICT).alias("conflict_reason"), F.col("source_file").alias("source_path_1"), F.col("other_file").alias("source_path_2"),
        F.col("first_sha256").alias("sha256_1"), F.col("second_sha256").alias("sha256_2"), F.lit(True).alias("review_required"), F.lit(CONFLICT_NOTE).alias("notes"),
    )


def latest_versions(versions: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """(document_id, latest_version_id, is_current, current_status): the single current version, else the recorded latest if it is one of the document's, else the end of the chain."""
    v = version_chain(versions)
    if documents is not None:
        v = v.join(documents.select("document_id", F.col("latest_version_id").alias("had")), "document_id", "left")
    else:
        v = v.withColumn("had", F.lit(None).cast("string"))
    g = v.groupBy("document_id").agg(F.count_if("is_current").alias("n"), F.max(F.when(F.col("is_current"), F.col("version_id"))).alias("current"), F.max(F.when(F.col("version_id") == F.col("had"), F.col("had"))).alias("had"), F.max_by("version_id", "position").alias("last"))
    one = F.col("n") == 1
    return g.select("document_id", F.when(one, F.col("current")).otherwise(F.coalesce("had", "last")).alias("latest_version_id"), F.when(one, True).alias("is_current"), F.when(one, "confirmed").otherwise("unknown").alias("current_status"))


def build_versions(versions: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(versions, documents) after a rebuild: chains linked anew, conflicts resolved, each document's state and latest version set, missing states of versions filled."""
    linked = resolve_current(version_chain(versions.drop("previous_version_id", "next_version_id", "position"))).drop("conflict", "position")
    state = latest_versions(linked.drop("previous_version_id", "next_version_id"), documents)
    docs = documents.drop("is_current", "current_status").withColumnRenamed("latest_version_id", "_had").join(state, "document_id", "left")
    docs = docs.withColumn("latest_version_id", F.coalesce("latest_version_id", "_had")).drop("_had")
    v = linked.drop("is_latest_version").join(state.select("document_id", "latest_version_id"), "document_id", "left").withColumn("is_latest_version", F.col("version_id").eqNullSafe(F.col("latest_version_id"))).drop("latest_version_id")
    url = F.col("source_page_url") if "source_page_url" in v.columns else F.lit(None).cast("string")
    missing = {"validity_status": F.lit("unknown"), "status_confidence": F.lit("unknown"), "source_url_quality": text.stored_url_quality(url)}
    return v.withColumns({c: x for c, x in missing.items() if c not in v.columns}), docs


def synced_markdown(texts: DataFrame, versions: DataFrame) -> DataFrame:
    """(version_id, text, changed, sha256): texts whose front matter has is_current and current_status as in ``versions``; all else stays as it is, as do texts without front matter."""
    j = texts.join(versions.select("version_id", "is_current", "current_status"), "version_id")
    new = F.col("text")
    for key, value in (("is_current", F.coalesce(F.col("is_current").cast("string"), F.lit("null"))), ("current_status", text.yaml_value(F.col("current_status")))):
        same = F.coalesce(F.col("_front")[key], F.lit("null")) == value
        new = F.when(same, new).otherwise(text.set_front_value(new, key, value))
    j = j.withColumn("_front", text.front_matter(F.col("text"))).withColumn("_new", F.when(F.col("_front").isNull(), F.col("text")).otherwise(new))
    return j.select("version_id", F.col("_new").alias("text"), (F.col("_new") != F.col("text")).alias("changed"), F.sha2("_new", 256).alias("sha256"))


def exact_duplicates(rows: DataFrame, digest: str, order: str) -> DataFrame:
    """Occurrences after the first of each digest. The first is found by a sum per digest, so a digest with very many rows does not gather in a task."""
    first = rows.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.min(order).alias("canonical"), F.count("*").alias("n")).where("n > 1")
    return rows.join(first.select(digest, "canonical"), digest).where(F.col(order) > F.col("canonical")).withColumn("duplicate_group", F.concat(F.lit("EXACT-"), F.substring(digest, 1, 12)))


def duplicate_rows(manifest: DataFrame, versions: DataFrame) -> DataFrame:
    """The duplicate table: manifest rows (ordinal, sha256, archive_file) after the first of a hash that a version has; of several versions with it the last by ordinal counts."""
    owner = versions.groupBy("sha256").agg(F.max_by("document_id", "ordinal").alias("document_id"))
    d = exact_duplicates(manifest, "sha256", "ordinal").join(owner, "sha256")
    return d.select(F.col("duplicate_group").alias("duplicate_group_id"), "document_id", F.lit("exact_duplicate").alias("duplicate_type"), F.col("document_id").alias("compared_document_id"), F.lit(True).alias("sha256_match"), F.lit(DUPLICATE_ACTION).alias("recommended_action"), F.col("archive_file").alias("notes"))


def grouped_candidates(rows: DataFrame) -> DataFrame:
    """Candidates (document_type, title, department, ordinal) with title_key and discriminator: the department where a type and key have several, else empty."""
    keyed = rows.withColumn("title_key", text.title_key(F.col("title")))
    several = keyed.groupBy("document_type", "title_key").agg(F.count_distinct(F.nullif("department", F.lit(""))).alias("departments"))
    return keyed.join(several, ["document_type", "title_key"]).withColumn("discriminator", F.when(F.col("departments") > 1, text.filled(F.col("department"))).otherwise("")).drop("departments")


def document_groups(rows: DataFrame) -> DataFrame:
    """Groups candidates of a type and title key: apart by department where a key has several, with stable ids, the longest title (the first of several) and the others as aliases."""
    g = grouped_candidates(rows).groupBy("document_type", "title_key", "discriminator")
    g = g.agg(F.max_by("title", F.struct(F.length("title"), F.negative("ordinal"))).alias("title"), F.array_sort(F.collect_set(F.nullif("title", F.lit("")))).alias("titles"), F.count("*").alias("n_versions"))
    key = (F.col("document_type"), text.title_key(F.col("title")), F.col("discriminator"))
    return g.select(ids.document_id(*key).alias("document_id"), ids.version_group_id(*key).alias("version_group_id"), "document_type", "title_key", "discriminator", "title", F.array_remove("titles", F.col("title")).alias("alternative_titles"), "n_versions")


def predecessors(versions: DataFrame, exclude_supporting: bool = False) -> DataFrame:
    """The version of each document that an update has to name: greatest date (revision, else effective), then id. ``exclude_supporting`` leaves out versions whose file (source_file) only supports one."""
    rows = versions.where(text.attachment_role(F.col("source_file")) == "document") if exclude_supporting else versions
    date = F.coalesce(F.nullif("revision_date", F.lit("")), F.nullif("effective_date", F.lit("")), F.lit(""))
    return rows.groupBy("document_id").agg(F.max_by("version_id", F.struct(date, "version_id")).alias("predecessor_id"))
