"""Literal cases of the text functions and rules."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lawloom.functions import ids, rules, text
from lawloom.operators import chunking


def one(spark, expr, **values):
    names = list(values)
    schema = ", ".join(f"{n} {'string' if not isinstance(v, bytes | bool) else 'binary' if isinstance(v, bytes) else 'boolean'}" for n, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expr(*[F.col(n) for n in names]).alias("x")).first().x


@pytest.mark.parametrize(
    "value, want",
    [("가·나", "가 나"), ("ＡＢ(다)", "ab 다"), ("Straße", "strasse"), ("  a\t b　c ", "a b c"), (None, ""), ("x-y_z", "x y z"), ("a\x1cb", "a b"), ("ﬁn", "fin")],
)
def test_search_text(spark, value, want):
    assert one(spark, text.search_text, a=value) == want
    assert one(spark, text.compact_text, a=value) == want.replace(" ", "")


@pytest.mark.parametrize("value, want", [("규정 2024.3 2호", "규정2호"), ("갑 규정(2024년 개정)", "갑규정"), ("갑 규정 2024년 3월 1일", "갑규정"), ("갑-규정_AB", "갑규정ab"), (None, ""), ("갑 규정(제2호)", "갑규정제2호"), ("2023.12-", "")])
def test_title_key(spark, value, want):
    assert one(spark, text.title_key, a=value) == want


def test_record_keys(spark):
    key = lambda t: one(spark, lambda c: text.record_key(c, r"(?:국립\s*)?을\s*대학교"), a=t)
    assert key("국립을대학교 부속 시설 설치·운영 지침(제12호, 2026.9.1.)") == key("부속 시설 설치 운영 지침") == "부속시설설치운영지침"
    assert key("[안내] 을 대학교 학칙 일부 개정안") == "학칙"
    assert one(spark, lambda c: text.canonical_key(c, "을대학교"), a="을대학교 학칙 전부개정") == "학칙"
    assert one(spark, text.canonical_key, a="개정 학칙 개정안") == "개정학칙"


@pytest.mark.parametrize("value, want", [("2024. 3. 2. 시행", "2024-03-02"), ("1850. 3. 2.", None), ("2024년 13월 1일", None), ("2024-02-30", None), ("x 2024/1/9 y 2025-01-01", "2024-01-09"), (None, None), ("12024-01-02", "2024-01-02")])
def test_date(spark, value, want):
    assert one(spark, text.normalize_date, a=value) == want


def test_last_date(spark):
    last = lambda a, b: one(spark, text.last_date, a=a, b=b)
    assert last("2020.1.1 그리고 2021-2-3", "2000-01-01") == "2021-02-03" and last("없음", "2000.1.1 x") == "2000-01-01"
    assert last("2020.1.1, 2021.2.31", "2000-01-01") is None and last(None, None) is None


@pytest.mark.parametrize("value, want", [("신ㆍ구 조문.hwp", "supporting"), ("신구조문", "supporting"), ("신 · 구 조문", "document"), ("개정 사유.hwp", "supporting"), ("규정.hwp", "document"), (None, "document"), ("공포문.pdf", "supporting")])
def test_role(spark, value, want):
    assert one(spark, text.attachment_role, a=value) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("no 900101-1234567.", ["resident_registration_number"]), ("1900101-1234567", []), ("tel 010-1234-5678", ["personal_mobile_number"]), ("01012345678", []), ("a@b.co", ["external_email_address"]), ("a@x.own.org", []), ("a@own.org.com", []), ("a@own.organic.com", ["external_email_address"]),
        ("ghp_" + "a" * 20, ["api_key_or_token"]), ("pwd = abcdef", ["password_assignment"]), ("xpwd=abcdef", []), ("password: abc", []), ("10.1.2.3", ["internal_ipv4"]), ("172.32.0.1", []), ("192.168.1.1 a@b.co", ["external_email_address", "internal_ipv4"]),
    ],
)
def test_sensitive(spark, value, want):
    assert one(spark, lambda c: text.sensitive_kinds(c, "own.org"), a=value) == want


@pytest.mark.parametrize("value, want", [("a/b%20c.hwp", "b c.hwp"), ("x%2Fy+z.pdf", "y+z.pdf"), ("a\\b", "a_b"), ("", "download.bin"), (None, "download.bin"), ("a/", "a"), ("q?:.x", "q__.x"), ("100%", "100%")])
def test_safe_filename(spark, value, want):
    assert one(spark, text.safe_filename, a=value) == want


def test_urls(spark):
    assert one(spark, lambda c: text.query_value(c, "a"), u="http://x/y?b=1&a=%EA%B0%80+z#a=2") == "가 z"
    assert one(spark, lambda c: text.query_value(c, "a"), u="http://x/y?a=&a=3") == "3" and one(spark, lambda c: text.query_value(c, "a"), u="http://x") is None
    assert text.url_with("http://x/y?p=1&q=&p=2#f", p=9, r=0) == "http://x/y?p=9&q=&r=0#f"
    assert one(spark, lambda c: text.with_query(c, p=2), u="http://x/?p=1") == "http://x/?p=2"
    assert [one(spark, text.url_quality, u=u) for u in ("http://x/VIEW", "x?mode=L", "fileDown", None, "selectBoardArticle list")] == ["unknown" if u is None else u for u in ("detail", "list_only", "attachment_only", None, "detail")]
    assert one(spark, text.stored_url_quality, u="a?mode=v") == "unknown" and one(spark, text.stored_url_quality, u="a?mode=V") == "detail"
    assert one(spark, text.safe_component, a="..가 나/" + "x" * 200) == "가_나_" + "x" * 92 and one(spark, text.safe_component, a="...") == "record"


def test_lines(spark):
    assert one(spark, text.normalize_lines, a="a \t\r\nb\x0bc\n\n") == "a\nb\nc\n\n" and one(spark, text.normalize_lines, a="") == "\n"
    assert one(spark, text.normalize_lines, a="a b c") == "a b\nc\n"


def test_front_matter(spark):
    doc = '---\ntitle: "갑: 을"\nis_current: null\nn: 3\n---\n\n# x\n'
    got = one(spark, text.front_matter, a=doc)
    assert got == {"title": '"갑: 을"', "is_current": "null", "n": "3"} and one(spark, text.front_matter, a="x") is None and one(spark, text.front_matter, a="---\n: [\n---\nx") is None
    assert one(spark, text.strip_front_matter, a=doc) == "# x\n" and one(spark, text.strip_front_matter, a="a\n---\nb\n---\n") == "a\n---\nb\n---\n"
    assert one(spark, lambda c: text.set_front_value(c, "is_current", F.lit("true")), a=doc) == doc.replace("is_current: null", "is_current: true")
    assert one(spark, lambda c: text.set_front_value(c, "zzz", F.lit("1$")), a=doc) == doc
    assert one(spark, text.yaml_value, a='a"b\n가') == '"a\\"b\\n가"' and one(spark, text.yaml_value, a=None) == "null"


SECTIONS = [
    ("개정 사유\n까닭", None, ("amendment_reason", "secondary", "non_normative")), ("신·구조문 대비표", None, ("comparison_old", "secondary", "historical_context")), ("현행개정안", None, ("comparison_old", "secondary", "historical_context")),
    ("제3조(구성) 위원회", None, ("operative_text", "primary", "normative")), ("제1조 a 제2조 b 별표 개정사유", None, ("operative_text", "primary", "normative")), ("| 현 행 | 개 정 안 | 제1조 제2조", None, ("operative_text", "primary", "normative")),
    ("부 칙\n공포한 날", None, ("supplementary_provision", "primary", "normative")), ("주요 내용", None, ("major_changes", "secondary", "non_normative")), ("공포문", None, ("promulgation_notice", "secondary", "non_normative")), ("공포 제1조", None, ("operative_text", "primary", "normative")),
    ("별 표", None, ("appendix", "primary", "normative")), ("서 식", None, ("form", "primary", "normative")), ("글", "부칙", ("supplementary_provision", "primary", "normative")), ("글", None, ("unknown", "secondary", "unknown")), ("주 요 내용", None, ("unknown", "secondary", "unknown")),
]


@pytest.mark.parametrize("body, path, want", SECTIONS)
def test_sections(spark, body, path, want):
    if "현 행 | 개 정 안" in body:  # the table head turns the first rule off, and the blanks around its sign the second
        want = ("operative_text", "primary", "normative")
    assert tuple(one(spark, rules.classify_section, a=body, b=path)) == want


@pytest.mark.parametrize(
    "body, want",
    [
        ("① 첫째", ("①", None, None)), ("가①", (None, None, None)), ("⑪ 열하나", (None, None, None)), ("  3항 글", ("3항", None, None)), ("제1조 3항", (None, None, None)), ("1. 하나\n2) 둘", (None, "1", None)), ("별표", (None, None, "별표")), ("별 지 제 3 호 서식", (None, None, "별지제3호")), ("가\n 12 ) x", (None, "12", None)),
    ],
)
def test_marks(spark, body, want):
    marks = lambda c: F.struct(*[x.alias(n) for n, x in chunking.article_marks(c).items()])
    assert tuple(one(spark, marks, a=body)) == want


def test_ids(spark):
    sha = hashlib.sha256(b"x").hexdigest()
    assert one(spark, ids.version_id, a="2024-01-02", b=sha) == f"VER-20240102-{sha[:8]}" and one(spark, ids.version_id, a=None, b=sha) == f"VER-unknown-{sha[:8]}"
    want = hashlib.sha256("rule:갑:".encode()).hexdigest()[:12]
    assert one(spark, lambda a, b, c: ids.document_id(a, b, c), a="rule", b="갑", c=None) == f"RUL-{want}" and one(spark, lambda a, b, c: ids.version_group_id(a, b, c), a="rule", b="갑", c="") == f"VG-{want}"
    assert one(spark, lambda v, a: ids.chunk_id(v, F.lit(2), a, F.lit(1)), v="VER-1-a", a="제2조의3") == "CHK-VER-1-a-0002-제2조의3-001" and one(spark, lambda v, a: ids.chunk_id(v, F.lit(12345), a, F.lit(1)), v="V", a=None) == "CHK-V-12345-section-12345-001"
    assert one(spark, ids.content_digest, c=b"data") == hashlib.sha256(b"data").hexdigest() and one(spark, ids.content_digest, c=f"version x\noid sha256:{sha}\nsize 3\n".encode()) == sha
    assert one(spark, ids.content_digest, c=f"oid sha256:{sha}\n".encode() + b" " * 1024) != sha
    assert one(spark, ids.raw_path, a="rule", b="s/1", c="r 2", d="f.hwp") == "sources/raw/guidelines/official/s_1/r_2/f.hwp"
    assert one(spark, ids.archive_path, a="regulation", b="x\\data\\raw\\regulations\\a\\b.hwp") == "sources/raw/regulations/a/b.hwp" and one(spark, ids.archive_path, a="rule", b="a/b.hwp") == "sources/raw/guidelines/a/b.hwp"


def test_status_rules(spark):
    states = spark.createDataFrame([(True,), (False,), (None,)], "x boolean").select(rules.current_status(F.col("x")).alias("s")).collect()
    assert [r.s for r in states] == ["confirmed", "historical", "unknown"]
    status = lambda ext, t, bad: one(spark, lambda a, b, c: rules.extraction_status(a, b, c), a=ext, b=t, c=bad)
    assert [status(".pdf", "x", False), status(".pdf", " ", False), status(".docx", None, True), status(".hwpx", "", False), status(".hwp", "x", False)] == ["success", "needs_ocr", "failed", "failed", "unsupported"]
    copy = lambda a, b, run: one(spark, lambda x, y: rules.copy_status(x, y, run), a=a, b=b)
    assert [copy("h", "h", False), copy(None, "h", False), copy("g", "h", True), copy(None, None, True)] == ["reused", "planned", "copied", "copied"]
    auto = lambda r, s: one(spark, lambda x, y: F.array(*rules.migration_flags(x, y.cast("double"))), a=r, b=s)
    assert [auto("unchanged", "0.9"), auto("modified", "0.5"), auto("split", "0.9"), auto("removed", None), auto("new", None)] == [[True, False], [False, True], [False, True], [False, True], [False, True]]


def test_shingles(spark):
    ratio = lambda a, b: one(spark, lambda x, y: text.overlap_ratio(text.shingles(x), text.shingles(y)), a=a, b=b)
    assert ratio("가나다라마", "가 나 다 라 마") == 1.0 and ratio("abc", "abc") == 1.0 and ratio("", "abc") == 0.0 and ratio("abcdef", "bcdefg") == 0.5 and ratio("abcdefgh", "xbcdefgx") == 0.5
    same = lambda v: (sorted(one(spark, text.shingles, a=v)), sorted(one(spark, text.long_shingles, a=v)))
    for v in ("", None, "ab", "abcde", "a b　c d e f g", "aaaaaaa"):
        x, y = same(v)
        assert x == y
