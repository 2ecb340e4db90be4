"""Corpus tables derived from the driver's tables, for Spark and, with the same meaning, in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.functions.ids import version_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def say(c: Column) -> Column:
    return c.cast("string")


V_VERSIONS = """v_versions as (select *, 'VER-' || coalesce(replace(revision_date,'-',''),'unknown') || '-' || substr(sha256,1,8) as version_id from (
  select o_orderkey, cast(o_custkey as varchar) as document_id, sha256(cast(o_orderkey as varchar)) as sha256,
  case when o_orderkey % 10 <> 0 then strftime(o_orderdate,'%Y-%m-%d') end as revision_date,
  case o_orderstatus when 'O' then true when 'F' then false end as is_current, 'f/' || o_orderkey || '.hwp' as source_file from orders))"""
V_CHAIN = V_VERSIONS + """, chain as (select *, lag(version_id) over w as previous_version_id, lead(version_id) over w as next_version_id, row_number() over w as position
  from v_versions window w as (partition by document_id order by revision_date asc nulls first, sha256))"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    sha = F.sha2(say(F.col("o_orderkey")), 256)
    date = F.when(F.col("o_orderkey") % 10 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select(
        F.col("o_custkey").cast("string").alias("document_id"), sha.alias("sha256"), date.alias("revision_date"),
        F.when(F.col("o_orderstatus") == "O", True).when(F.col("o_orderstatus") == "F", False).alias("is_current"),
        version_id(date, sha).alias("version_id"), F.concat(F.lit("f/"), say(F.col("o_orderkey")), F.lit(".hwp")).alias("source_file"), "o_orderkey",
    )


V_DOCUMENTS = """v_documents as (select cast(c_custkey as varchar) as document_id, c_custkey, c_name as title, case when c_custkey % 7 <> 0 then c_mktsegment end as department,
  case when c_nationkey % 2 = 0 then 'regulation' else 'guideline' end as document_type from customer)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("document_id"), F.col("c_name").alias("title"), F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("department"), F.when(F.col("c_nationkey") % 2 == 0, "regulation").otherwise("guideline").alias("document_type"))


# line i opens with 제i조 and its title, after a blank in every other line; every fifth text has headings
V_LEGAL = """v_legal as (select doc_id, case doc_id % 5 when 0 then '# 총칙' || chr(10)||chr(10) else '' end ||
  array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: '제' || i || '조' || case i % 2 when 0 then ' ' else '' end || '(T' || i || ') ' || x), chr(10)||chr(10)) ||
  case doc_id % 3 when 0 then chr(10)||chr(10)||'부칙 이 규정은 공포한 날부터 시행한다.' when 1 then chr(10)||chr(10)||'별표 제1호 (제2조 관련)' else '' end as text from documents)"""


def legal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: line i becomes ``제i조(Ti) line``, with a blank before even titles; every third text ends with a supplementary or appendix line, every fifth begins with a heading."""
    d = table(spark, sf_dir, "documents")
    blank = lambda i: F.when((i + 1) % 2 == 0, " ").otherwise("")
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.lit("제"), say(i + 1), F.lit("조"), blank(i), F.lit("(T"), say(i + 1), F.lit(") "), x))
    head = F.when(F.col("doc_id") % 5 == 0, "# 총칙\n\n").otherwise("")
    end = F.when(F.col("doc_id") % 3 == 0, "\n\n부칙 이 규정은 공포한 날부터 시행한다.").when(F.col("doc_id") % 3 == 1, "\n\n별표 제1호 (제2조 관련)").otherwise("")
    return d.select("doc_id", F.concat(head, F.array_join(lines, "\n\n"), end).alias("text"))


# articles of v_legal: a part begins with a heading or an article
V_ARTICLES = V_LEGAL + """, parts as (select doc_id, string_split(text, chr(10)||chr(10)||'제') as p from v_legal), a as (select doc_id, unnest(p) as part, generate_subscripts(p, 1) - 1 as position from parts),
  b as (select doc_id, cast(position as int) as position, case when position = 0 then part else '제' || part end as part from a),
  articles as (select doc_id, position, nullif(regexp_extract(part, '^(제[0-9]+조)', 1), '') as article_no, nullif(regexp_extract(part, '^제[0-9]+조 ?\\(([^)]*)\\)', 1), '') as article_title, regexp_replace(part, '^\\s+|\\s+$', '', 'g') as body from b)"""


def legal_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(versions with their text, documents) of ``legal``: a version a document."""
    name = F.concat(F.lit("D"), say(F.col("doc_id")))
    sha = F.sha2(F.col("text"), 256)
    v = legal(spark, sf_dir).select(F.concat(F.lit("VER-unknown-"), say(F.col("doc_id"))).alias("version_id"), say(F.col("doc_id")).alias("document_id"), name.alias("title"), F.when(F.col("doc_id") % 2 == 0, "regulation").otherwise("guideline").alias("document_type"), "text", F.lit(None).cast("string").alias("revision_date"), F.lit("public").alias("access_level"), F.concat(F.lit("n/"), say(F.col("doc_id"))).alias("normalized_file"), F.concat(F.lit("f/"), say(F.col("doc_id"))).alias("source_file"), sha.alias("sha256"))
    return v, v.select("document_id", F.col("version_id").alias("latest_version_id"))


# each document as a chunk of its source: public but for every 17th, an article in every 6th
V_INDEX = f"""src as (select doc_id, cast(doc_id as varchar) as chunk_id, coalesce(source, '-') as document_id, 'V' || doc_id as version_id, 'D' || doc_id as title, case when doc_id % 5 <> 0 then lang end as department,
  case when doc_id % 6 = 0 then '제1조 ' else '' end || coalesce(text,'') as text, case when doc_id % 2 = 0 then 'regulation' else 'guideline' end as document_type, '20' || lpad(cast(doc_id % 30 as varchar), 2, '0') || '-01-01' as revision_date, '제' || (doc_id % 3) || '조' as article_no,
  doc_id % 4 <> 0 as is_latest_version, case doc_id % 3 when 0 then 'in_force' when 1 then 'superseded' else 'unknown' end as validity_status, case when doc_id % 2 = 0 then 'confirmed' else 'probable' end as status_confidence, 'alias ' || coalesce(source, '-') as alias,
  case when doc_id % 6 = 0 then 'primary' else 'secondary' end as retrieval_scope from documents where doc_id % 17 <> 0),
  forms as (select *, trim(regexp_replace(regexp_replace(replace(lower(title || ' ' || alias || ' ' || coalesce(department, 'None') || ' ' || text),'ß','ss'), '[·ㆍ‧・./\\\\()\\[\\]{{}}<>:;,''\"“”‘’_-]+', ' ', 'g'), '\\s+', ' ', 'g')) as search_text,
  replace(trim(regexp_replace(regexp_replace(replace(lower(title || ' ' || alias || ' ' || text),'ß','ss'), '[·ㆍ‧・./\\\\()\\[\\]{{}}<>:;,''\"“”‘’_-]+', ' ', 'g'), '\\s+', ' ', 'g')), ' ', '') as compact_text from src)"""


def search_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chunks, versions, documents) of ``V_INDEX``."""
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    source = F.coalesce("source", F.lit("-"))
    chunks = d.select(
        say(i).alias("chunk_id"), source.alias("document_id"), F.concat(F.lit("V"), say(i)).alias("version_id"), F.concat(F.lit("D"), say(i)).alias("title"), F.when(i % 5 != 0, F.col("lang")).alias("department"), F.concat(F.when(i % 6 == 0, "제1조 ").otherwise(""), F.coalesce("text", F.lit(""))).alias("text"),
        F.when(i % 2 == 0, "regulation").otherwise("guideline").alias("document_type"), F.concat(F.lit("20"), F.lpad(say(i % 30), 2, "0"), F.lit("-01-01")).alias("revision_date"), F.lit(None).cast("string").alias("effective_date"), F.concat(F.lit("제"), say(i % 3), F.lit("조")).alias("article_no"),
        F.lit(None).cast("string").alias("appendix_no"), F.lit(None).cast("string").alias("section_path"), F.when(i % 17 == 0, "internal").otherwise("public").alias("access_level"), F.lit(None).cast("string").alias("source_url"), F.when(i % 6 == 0, "primary").otherwise("secondary").alias("retrieval_scope"),
    )
    vers = d.select(F.concat(F.lit("V"), say(i)).alias("version_id"), (i % 4 != 0).alias("is_latest_version"), F.when(i % 3 == 0, "in_force").when(i % 3 == 1, "superseded").otherwise("unknown").alias("validity_status"), F.when(i % 2 == 0, "confirmed").otherwise("probable").alias("status_confidence"))
    docs = d.select(source.alias("document_id")).distinct().withColumn("alternative_titles", F.array(F.concat(F.lit("alias "), F.col("document_id"))))
    return chunks, vers, docs


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as listed records."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("url", r"^[^:]+://([^/?#]+)", 1).alias("host"), F.col("url"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"), "html")


# a chunk for most versions, with every kind of fault in some
V_CHUNKS = """v_chunks as (select 'CHK-' || o_orderkey as chunk_id, case when o_orderkey % 60 = 0 then 'VER-none' else version_id end as version_id, document_id, case when o_orderkey % 50 = 0 then ' ' else '제1조(목적) 본문' end as text,
  case when o_orderkey % 90 = 0 then 1201 else 20 end as token_count, case when o_orderkey % 70 = 0 then 'internal' else 'public' end as access_level, case when o_orderkey % 40 <> 0 then 'c' end as citation_label from v_versions where o_orderkey % 9 <> 0)"""


def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return versions(spark, sf_dir).where(k % 9 != 0).select(
        F.concat(F.lit("CHK-"), say(k)).alias("chunk_id"), F.when(k % 60 == 0, "VER-none").otherwise(F.col("version_id")).alias("version_id"), "document_id", F.when(k % 50 == 0, " ").otherwise("제1조(목적) 본문").alias("text"), F.when(k % 90 == 0, 1201).otherwise(20).alias("token_count"),
        F.when(k % 70 == 0, "internal").otherwise("public").alias("access_level"), F.when(k % 40 != 0, "c").alias("citation_label"), F.lit("t").alias("title"), "source_file", "sha256", F.lit("e").alias("text_for_embedding"),
    )
