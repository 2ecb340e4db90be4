"""Chunks: headings, budgets, overlaps and incremental steps."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lawloom.operators import chunking, migration

TEXT = """---
title: x
---
# 규정

앞글이다.

## 제1장 총칙

### 제1조(목적) 이 규정은 목적을 정한다.

### 제2조 (정의) 용어의 뜻은 다음과 같다.

## 부칙

제1조 이 규정은 오늘부터 시행한다.

# 별표

## 서식

제9조 표를 붙인다.
"""


def versions(spark, *texts):
    rows = [(f"V{i}", "D", "제목", "regulation", t, None, "public", f"n/{i}", f"f/{i}", "0" * 64) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "version_id string, document_id string, title string, document_type string, text string, revision_date string, access_level string, normalized_file string, source_file string, sha256 string")


def documents(spark, latest="V1"):
    return spark.createDataFrame([("D", latest)], "document_id string, latest_version_id string")


def build(spark, *texts, **budget):
    return chunking.build_chunks(versions(spark, *texts), documents(spark), **budget)


def test_headings(spark):
    got = build(spark, TEXT, "제1조 제목 없는 글").orderBy("version_id", "chunk_index").collect()
    assert [(r.section_path, r.chapter, r.section, r.article_no, r.article_title, r.section_kind) for r in got] == [
        (None, None, None, None, None, "unknown"),
        ("규정 > 제1장 총칙", "규정", "제1장 총칙", "제1조", "목적", "operative_text"),
        ("규정 > 제1장 총칙 > 제1조(목적) 이 규정은 목적을 정한다.", "규정", "제1조(목적) 이 규정은 목적을 정한다.", "제2조", "정의", "supplementary_provision"),  # its body ends with the next heading
        ("규정 > 부칙", "규정", "부칙", "제1조", None, "supplementary_provision"),
        ("별표 > 서식", "별표", "서식", "제9조", None, "appendix"),
        (None, None, None, "제1조", None, "operative_text"),
    ]
    assert got[3].text_for_embedding == "문서명: 제목\n유형: 규정\n위치: 규정 > 부칙 > 제1조 \n본문: 제1조 이 규정은 오늘부터 시행한다.\n\n# 별표\n\n## 서식"
    assert [r.is_latest_version for r in got] == [False] * 5 + [True] and got[1].citation_label == "제목 제1조" and got[1].chunk_schema_version == "2.0"


def test_articles(spark):
    cut = lambda t: [(r.article_no, r.article_title, r.body) for r in chunking.split_articles(spark.createDataFrame([(1, t)], "doc_id int, text string")).orderBy("position").collect()]
    assert cut("제1조 (목적) 가\n제 2 조의 3(정의) 나") == [("제1조", "목적", "제1조 (목적) 가"), ("제2조의3", "정의", "제 2 조의 3(정의) 나")]
    assert cut("앞\r\n## 제3조 글 제4조는 아니다") == [(None, None, "앞"), ("제3조", None, "## 제3조 글 제4조는 아니다")]
    assert cut(" \n ") == [] and cut("") == [] and cut("글만") == [(None, None, "글만")] and cut("제1조　(가)") == [("제1조", "가", "제1조　(가)")]
    assert chunking.split_articles(spark.createDataFrame([(1, None)], "doc_id int, text string")).count() == 0


def spec_pieces(text, target, most):
    """A plain second version of the cutting rules."""
    size = chunking.estimate
    if size(text) <= most:
        return [text]

    def cut(v):
        if size(v) <= most:
            return [v]
        mid, best = len(v) // 2, None
        for at in (v[:mid].rfind("\n"), v[:mid].rfind(" "), v.find("\n", mid), v.find(" ", mid)):
            if at > len(v) // 4 and (best is None or abs(at - mid) < abs(best - mid)):
                best = at
        at = best or mid
        return cut(v[:at].strip()) + cut(v[at:].strip())

    out, now = [], []
    for part in sum((cut(b) for b in re.split(r"\n\s*\n", text)), []):
        if now and size("\n\n".join([*now, part])) > target:
            out.append("\n\n".join(now))
            now = []
        now.append(part)
    return out + ["\n\n".join(now)]


def test_divide():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["가나다", "word ", " ", "\n", "\n\n", "!", "한", "x1 "]) for _ in range(rng.randint(1, 300))).strip() or "x"
        target, most = rng.randint(1, 40), rng.randint(2, 60)
        assert chunking.divide(text, target, most) == spec_pieces(text, target, most)
    assert chunking.tail("가나 다라  마바 ", 2) == "다라  마바" and chunking.tail("abc", 0) == "" and chunking.tail("가나다라마바", 1) == ""


def test_budget_counts_headings(spark):
    text = "# " + "긴 제목 " * 40 + "\n\n제1조 " + "낱말 word " * 400
    got = build(spark, text, target=150, most=200, overlap=20).orderBy("chunk_index").collect()
    assert len(got) > 2 and max(r.token_count for r in got) <= 200 and all(chunking.estimate(r.text_for_embedding) == r.token_count for r in got)
    assert chunking.over_limit(build(spark, text, target=150, most=200), 200).isEmpty()
    raw = [r.text.split("\n\n", 1)[-1] for r in got]
    assert any("\n\n" in r.text and raw[i - 1].endswith(r.text.split("\n\n", 1)[0]) for i, r in enumerate(got) if i)
    assert re.match(r"CHK-V0-0002-제1조-001$", next(r.chunk_id for r in got if r.article_no))


def test_incremental(spark):
    v, d = versions(spark, "제1조(목적) 옛 글", "제1조(목적) 새 글"), documents(spark)
    old = spark.createDataFrame([("CHK-legacy", "V0", "제1조(목적) 옛 경계의 글", "제1장", "제1조", None, 0, "gone")], "chunk_id string, version_id string, text string, section_path string, article_no string, article_title string, chunk_index int, title string")
    got = chunking.make_chunks("incremental", v, d, old, canonical=True)
    rows = {r.chunk_id: r for r in got.collect()}
    assert rows["CHK-legacy"].text == "제1조(목적) 옛 경계의 글" and rows["CHK-legacy"].title == "제목" and rows["CHK-legacy"].is_latest_version is False
    assert [r.is_latest_version for k, r in rows.items() if k != "CHK-legacy"] == [True]
    assert chunking.id_changes(old, got).first().asDict() == {"reference_chunks": 1, "chunks": 2, "documents_with_chunks": 1, "retained_ids": 1, "removed_ids": 0, "new_ids": 1}
    with pytest.raises(RuntimeError, match="unknown_version"):
        chunking.make_chunks("incremental", v, d, old.withColumn("version_id", F.lit("V7")))
    with pytest.raises(RuntimeError, match="withdrawn_version"):
        chunking.make_chunks("incremental", v.withColumn("access_level", F.lit("internal")), d, old)
    assert {r.error for r in chunking.incremental_errors(v, old, got.withColumn("text", F.lit("x"))).collect()} == {"text_changed"}
    for mode in ("preview", "rechunk"):
        with pytest.raises(ValueError):
            chunking.make_chunks(mode, v, d, old, canonical=True)
    a, b = (chunking.make_chunks("rechunk", v, d, old, canonical=True, allow_id_changes=True) for _ in range(2))
    same = chunking.make_chunks("preview", v, d, old, check_determinism=True, check_reference=a)
    assert same.count() == 2
    with pytest.raises(RuntimeError, match="differ"):
        chunking.make_chunks("preview", v, d, old, check_reference=a.withColumn("text", F.lit("x")))
    assert a.count() == 2 and a.exceptAll(b).isEmpty() and chunking.make_chunks("preview", v, d, old).count() == 2
    assert build(spark, "", None, "  ").count() == 0


SCHEMA = "chunk_id string, document_id string, version_id string, text string, section_path string, article_no string, appendix_no string"


def test_migration(spark):
    text = "가나다라마바사아자차카타파하"
    old = [
        ("same", "D", "1", text, "p", "a", None), ("changed", "D", "1", text, "p", "b", None), ("split", "D", "1", text + "거너더러머버서어저처커터퍼허", "p", "c", None), ("m1", "D", "1", "고노도로모보소오조초", "p", "d", None),
        ("m2", "D", "1", "구누두루무부수우주추", "p", "d", None), ("gone", "D", "1", "기니디리미비시이지치", "p", "z", None), ("moved", "D", "1", "개내대래매배새애재채", None, None, None), ("blank", "D", "1", "갸냐댜랴먀뱌샤야쟈챠", "", "a", None),
    ]
    new = [
        ("same", "D", "1", text, "p", "a", None), ("changed", "D", "1", text + "x", "p", "b", None), ("s1", "D", "1", text, "p", "c", None), ("s2", "D", "1", "거너더러머버서어저처커터퍼허", "p", "c", None),
        ("m", "D", "1", "고노도로모보소오조초구누두루무부수우주추", "p", "d", None), ("n9", "D", "1", "개내대래매배새애재채", "q", "x", None), ("other", "D", "2", "기니디리미비시이지치", "p", "z", None),
    ]
    o, n = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    m = migration.migration_map(o, n)
    got = {r.old_chunk_id or "+" + r.new_chunk_ids[0]: r for r in m.collect()}
    assert {k: (r.relation, r.new_chunk_ids) for k, r in got.items()} == {
        "same": ("unchanged", ["same"]), "changed": ("modified", ["changed"]), "split": ("split", ["s1", "s2"]), "m1": ("merged", ["m"]), "m2": ("merged", ["m"]), "gone": ("removed", []), "moved": ("modified", ["n9"]), "blank": ("removed", []),
        "+s1": ("new", ["s1"]), "+s2": ("new", ["s2"]), "+m": ("new", ["m"]), "+n9": ("new", ["n9"]), "+other": ("new", ["other"]),
    }
    assert {k for k, r in got.items() if not r.review_required} == {"same", "changed", "moved"} == {k for k, r in got.items() if r.automatic_match}
    assert got["split"].overlap_scores == [1.0, 1.0] and got["moved"].evidence == "same_version_location_text_shingles" and got["same"].old_location.article_no == "a" and got["+m"].review_required
    assert migration.mapping_errors(m, o, n).isEmpty()
    assert {r.error for r in migration.mapping_errors(m.where("old_chunk_id <> 'gone' or old_chunk_id is null"), o, n.where("chunk_id <> 's1'")).collect()} == {"old_not_once", "unknown_target", "new_ids_differ"}
    s = migration.summary(m).first()
    assert (s.old_chunks, s.retained_ids, s.removed_ids, s.new_ids, s.review_required, s.merged) == (8, 2, 6, 5, 10, 2)
    assert {r.relation: r.n for r in migration.relation_counts(m).collect()} == {"unchanged": 1, "modified": 2, "split": 1, "merged": 2, "removed": 2, "new": 5}


def test_migration_by_path(spark):
    old = "# 갑\n\n제1조 첫째 글의 내용은 여기에 있다.\n\n# 을\n\n제1조 첫째 글의 내용은 저기에 있다."
    a = build(spark, old)
    b = a.withColumn("chunk_id", F.concat("chunk_id", F.lit("n")))
    got = {r.old_chunk_id: r.new_chunk_ids for r in migration.migration_map(a, b).where("old_chunk_id is not null").collect()}
    numbered = {r.chunk_id for r in a.where("article_no is not null").collect()}
    assert len(numbered) == 2 and all(got[i] == [i + "n"] for i in numbered)


def test_limit_error(spark):
    """A title that alone fills the limit: no chunk above it is ever handed out, whatever is read."""
    v = versions(spark, "제1조 짧은 글").withColumn("title", F.lit("긴 제목 " * 900))
    for read in (lambda c: c.collect(), lambda c: c.count(), lambda c: c.select("chunk_id").collect()):
        with pytest.raises(Exception, match="chunk above the limit: CHK-V0-"):
            read(chunking.build_chunks(v, documents(spark)))
    with pytest.raises(Exception, match="chunk above the limit"):
        chunking.make_chunks("rechunk", v, documents(spark), None, canonical=True, allow_id_changes=True).count()
    assert chunking.build_chunks(versions(spark, "제1조 짧은 글"), documents(spark)).count() == 1
