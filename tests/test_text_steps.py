"""Steps over whole texts: what they compute, and that they compute it once."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from lawloom.functions import rules, text
from lawloom.operators import chunking
from lawloom.plans import queries

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a b", "  a  b ", "a　b c", "\x1ca\x1f\x85b\xa0", "제1조(T1) a-b_c·d.e/f\\g", "--", "a - b", "x\ty\n\nz", "​a", "�� 가나 ", "😀 #1", "a᠎b", "‘x’“y” [z]{w}<v>:;,'\"&&"]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(True)
    return out.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def odd(spark):
    return spark.createDataFrame(list(enumerate([*ODD, None])), "i int, t string")


def test_search_text(spark):
    two = text.clean(F.regexp_replace(F.lower(text.filled(F.col("t"))), text.SEPARATORS, " "))
    got = odd(spark).select("t", text.search_text(F.col("t"), native=True).alias("x"), two.alias("y"), text.compact_text(F.col("t"), native=True).alias("z")).collect()
    assert [r.x for r in got] == [r.y for r in got] and [r.z for r in got] == [r.y.replace(" ", "") for r in got]


def test_quality_counts(spark):
    q = text.text_quality(F.col("t"), F.lit("T1"))
    for r in odd(spark).where("t is not null").select("t", *[q[c].alias(c) for c in ("non_whitespace_chars", "hangul_chars", "replacement_chars")]).collect():
        assert (r.non_whitespace_chars, r.hangul_chars, r.replacement_chars) == (len("".join(r.t.split())), len(re.findall("[가-힣]", r.t)), r.t.count("�")), r.t


def test_quality_gate_counts_without_lists(spark):
    p = plan(queries.quality_gate(spark, SF))
    assert p.count("regexp_extract_all") <= 1 and p.count("[가-힣]") <= 2


def test_section_forms_are_made_once(spark):
    d = odd(spark)
    p = plan(d.select(rules.classify_section(F.col("t"), F.lit(None).cast("string"))["kind"]))
    assert p.count("translate(") <= 4


def test_overlap_without_sets(spark):
    df = queries.overlap_ratio(spark, SF)
    assert "array_intersect" not in plan(df) and "array<" not in str(df.schema)
    d = odd(spark).crossJoin(odd(spark).select(F.col("t").alias("u")))
    got = d.select("t", "u", text.text_overlap("t", "u").alias("a"), text.overlap_ratio(text.long_shingles("t"), text.long_shingles("u")).alias("b")).collect()
    assert all(r.a == pytest.approx(r.b, abs=1e-6) for r in got)


def test_headless_texts_stay_out_of_python(spark):
    d = spark.createDataFrame([(1, "제1조 a\n\n제2조 b"), (2, "# h\n\n제1조 a"), (3, "---\nx: 1\n---   # h\n제1조 a"), (4, None), (5, "a # b\n제1조 c")], "doc_id long, text string")
    df = chunking.split_articles(d, headings=True)
    assert re.search(r"heading_stacks\(CASE WHEN", plan(df))
    assert [(r.doc_id, r.position, r.headings) for r in df.orderBy("doc_id", "position").collect()] == [(1, 0, []), (1, 1, []), (2, 0, []), (2, 1, ["h"]), (3, 0, []), (3, 1, ["h"]), (5, 0, []), (5, 1, [])]


def test_an_article_that_fills_its_room(spark):
    """One token above the limit with its context, where the count of Hangul leaves no half to spare."""
    version = ("V1", "D", "D1", "regulation", None, "public", "n/1", "f/1", "0" * 64)
    fixed = chunking.estimate(chunking._context("D1", "regulation", None, "제1조", "T1", "")) - 1
    for n in range(1190 - fixed, 1202 - fixed):
        body = "제1조(T1) " + " ".join(["w"] * n)
        df = spark.createDataFrame([(*version, body)], "version_id string, document_id string, title string, document_type string, revision_date string, access_level string, normalized_file string, source_file string, sha256 string, text string")
        got = chunking.full(df, df.select("document_id", F.col("version_id").alias("latest_version_id"))).collect()
        assert max(r.token_count for r in got) <= 1200 and sum(r.text.count("w") for r in got) >= n
