"""Text functions as columns (normalisation, dates, keys, URLs, quality, sensitive data)."""

from __future__ import annotations

import json
import re
import unicodedata
from urllib.parse import parse_qs, urlencode, urlparse, urlunparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, MapType, StringType

# Patterns and thresholds that results depend on.
SEPARATORS = r"""[·ㆍ‧・./\\()\[\]{}<>:;,'"“”‘’_-]+"""
TITLE_NOTE = r"\([^)]*(?:제정|개정|시행|\d{4})[^)]*\)"
TITLE_DATE = r"\d{4}[.년_-]\s*\d{1,2}(?:[.월_-]\s*\d{1,2}일?)?"
DATE = r"((?:19|20)\d{2})\s*[.\-/년]\s*(\d{1,2})\s*[.\-/월]\s*(\d{1,2})"
SUPPORTING = r"(?:제정|개정)\s*사유|신[·ㆍ]?구\s*조문|대비표|검토서|의견서|공포문"
RECORD_NOTE = r"\([^)]*(?:제\s*\d+\s*호|지침|규정|제정|개정|시행|(?:19|20)\d{2})[^)]*\)"
AMENDED = r"(?:일부|전부)?\s*개정안?"
SETUP_AND_RUN, SETUP_AND_RUN_KEY = r"설치\s*[·ㆍ.\-]?\s*운영", "설치운영"
AMENDED_END = r"(?:일부|전부)?\s*개정(?:안)?$"
ARTICLE = r"제\s*\d+\s*조"
ARTICLE_NUMBER = r"제\s*\d+\s*조(?:의\s*\d+)?"
HANGUL = "[가-힣]"
NOT_KEY = "[^0-9A-Za-z가-힣]"
TOKEN = r"[A-Za-z0-9]+|[^\sA-Za-z0-9가-힣]"
SENSITIVE = {
    "resident_registration_number": r"(?<!\d)\d{6}-[1-4]\d{6}(?!\d)",
    "personal_mobile_number": r"(?<!\d)01[016789][ -]\d{3,4}[ -]\d{4}(?!\d)",
    "external_email_address": r"(?i)\b[A-Z0-9._%+-]+@(?![A-Z0-9.-]*{own}\b)[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "api_key_or_token": r"(?:gh[pousr]_[A-Za-z0-9_]{20,}|sk-[A-Za-z0-9_-]{20,}|AKIA[0-9A-Z]{16})",
    "password_assignment": r"(?i)\b(?:password|passwd|pwd)\s*[:=]\s*[^\s'\"]{6,}",
    "internal_ipv4": r"(?<!\d)(?:10\.(?:\d{1,3}\.){2}\d{1,3}|192\.168\.(?:\d{1,3}\.)\d{1,3}|172\.(?:1[6-9]|2\d|3[01])\.(?:\d{1,3}\.)\d{1,3})(?!\d)",
}
QUALITY_ERRORS = ("본문 200자 미만", "한글 80자 미만", "한글 비율 0.15 미만", "Unicode replacement 문자 포함", "본문에서 문서 제목을 확인하지 못함")

#: White space of Unicode, and the four separators that it lacks.
SPACES = r"[\s\x1c-\x1f]"

#: White space of Unicode by its signs, which is faster than the class.
BLANKS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Separators and white space by sign.
BREAKS = "".join(c for c in map(chr, range(0x10000)) if not 0xD800 <= ord(c) < 0xE000 and re.fullmatch(f"{SEPARATORS}|[{BLANKS}]", c))


def uni(pattern: str) -> str:
    """The pattern with the classes of Unicode."""
    return pattern if pattern.startswith("(?U)") else "(?U)" + pattern


def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, uni(f"^{SPACES}+|{SPACES}+$"), "")


def clean(text: Column) -> Column:
    """White space collapsed and trimmed; null is empty."""
    return F.regexp_replace(F.regexp_replace(filled(text), uni(f"{SPACES}+"), " "), r"^ | $", "")


#: A sign that lower case alone may not fold: all but plain Latin, precomposed Hangul and some punctuation. The long class is tried on signs beyond ASCII alone.
UNUSUAL = r"[^\x00-\x7F](?<![\u00B7\u00C0-\u00D6\u00D8-\u00DE\u00E0-\u00F6\u00F8-\u00FF\u2013\u2014\u2018\u2019\u201C\u201D\u2022\u2027\u30FB\uAC00-\uD7A3])"


@F.pandas_udf(StringType())
def _fold(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())


def folded(value: str | None) -> str:
    """The compatibility form of one value, case folded."""
    return unicodedata.normalize("NFKC", value or "").casefold()


def search_text(text: Column, native: bool = False) -> Column:
    """Compatibility form, case folded, separators and white space to one space; null is empty. ``native`` lower-cases instead (equal for Latin text in NFC).

    Only texts with a sign that lower case may not fold are sent to Python.
    """
    low = F.regexp_replace(F.lower(filled(text)), "ß", "ss") if native else F.coalesce(_fold(F.when(text.rlike(UNUSUAL), text)), F.lower(filled(text)))
    return F.trim(F.regexp_replace(F.translate(low, BREAKS, " " * len(BREAKS)), " {2,}", " "))


def compact_text(text: Column, native: bool = False) -> Column:
    return F.replace(search_text(text, native), F.lit(" "), F.lit(""))


def title_key(title: Column) -> Column:
    """A grouping key: issue notes in parentheses and dates dropped, then only digits, Latin letters and Hangul, lower case; null is empty."""
    x = F.regexp_replace(filled(title), uni(TITLE_NOTE), "")
    return F.lower(F.regexp_replace(F.regexp_replace(x, uni(TITLE_DATE), ""), NOT_KEY, ""))


def record_key(title: Column, institution: str | None = None) -> Column:
    """The key of a listed record's title: a leading bracket, the names that the pattern ``institution`` matches, issue notes and marks of amendment dropped; lower case."""
    x = F.lower(strip(filled(title)))
    for pattern, by in ((r"^\s*\[[^]]+]\s*", ""), (institution, ""), (RECORD_NOTE, ""), (AMENDED, ""), (SETUP_AND_RUN, SETUP_AND_RUN_KEY), ("[^0-9a-z가-힣]", "")):
        x = F.regexp_replace(x, uni(pattern.replace("[^]]", r"[^\]]")), by) if pattern else x
    return x


def simple_key(text: Column) -> Column:
    return F.lower(F.regexp_replace(filled(text), f"{NOT_KEY}+", ""))


def canonical_key(title: Column, institution: str | None = None) -> Column:
    """The key under which a converted text must name its title: a leading institution and a final mark of amendment dropped."""
    x = F.regexp_replace(filled(title), uni(f"^(?:{institution})"), "") if institution else filled(title)
    return simple_key(F.regexp_replace(x, uni(AMENDED_END), ""))


def normalize_date(text: Column) -> Column:
    """First ``Y sep M sep D`` as YYYY-MM-DD; null for none and for days that no calendar has."""
    y, m, d = (F.regexp_extract(text, uni(DATE), i) for i in (1, 2, 3))
    return F.when(y != "", F.date_format(F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"), "yyyy-MM-dd"))


def last_date(text: Column, fallback: Column) -> Column:
    """The last date in ``text``, else the first in ``fallback``; null where the last one is in no calendar."""
    found = F.regexp_extract_all(filled(text), F.lit(uni(DATE)), 0)
    return F.when(F.size(found) > 0, normalize_date(F.try_element_at(found, F.lit(-1)))).otherwise(normalize_date(fallback))


def token_estimate(text: Column) -> Column:
    """Half of the Hangul syllables, rounded up, and each Latin or digit run and each other sign; 1 at least."""
    hangul = F.regexp_count(text, F.lit(HANGUL))
    other = F.regexp_count(text, F.lit(uni(TOKEN.replace(r"[^\s", r"[^\s\x1c-\x1f"))))
    return F.greatest(F.lit(1), F.floor((hangul + 1) / 2).cast("int") + other)


def sensitive_kinds(text: Column, own_domain: str = "example.org") -> Column:
    """Names of the kinds of sensitive data in ``text``, in fixed order; addresses of the own domain are none."""
    own = own_domain.replace(".", r"\.")
    return F.array_compact(F.array(*[F.when(text.rlike(uni(p.replace("{own}", own))), F.lit(n)) for n, p in SENSITIVE.items()]))


def url_quality(url: Column) -> Column:
    """detail, list_only, attachment_only or unknown, by the first group of marks the address holds."""
    low = F.lower(filled(url))
    has = lambda *marks: F.greatest(*[low.contains(m) for m in marks], F.lit(False))
    return (
        F.when(has("selectboardarticle", "mode=v", "/view"), "detail")
        .when(has("list", "mode=l", "06010"), "list_only")
        .when(has("download", "filedown", "mode=d"), "attachment_only")
        .otherwise("unknown")
    )


def stored_url_quality(url: Column) -> Column:
    """What a version without the field gets: detail for the two marks in this case of letters, else unknown."""
    return F.when(filled(url).rlike("mode=V|selectBoardArticle"), "detail").otherwise("unknown")


def unquoted(value: Column) -> Column:
    """Percent signs decoded, plus signs kept; signs without two hex digits stay."""
    safe = F.regexp_replace(F.regexp_replace(value, r"%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.coalesce(F.try_url_decode(safe), value)


def query_value(url: Column, key: str) -> Column:
    """The first value that is not empty of a key in the query, decoded; null without one."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    raw = F.regexp_extract(query, rf"(?:^|&)\Q{key}\E=([^&]+)", 1)
    return F.nullif(unquoted(F.regexp_replace(raw, r"\+", " ")), F.lit(""))


def url_with(url: str, **values: object) -> str:
    """``url`` with the keys set in its query, in place or at the end."""
    parts = urlparse(url)
    query = {**parse_qs(parts.query, keep_blank_values=True), **{k: [str(v)] for k, v in values.items()}}
    return urlunparse(parts._replace(query=urlencode(query, doseq=True)))


def with_query(url: Column, **values: object) -> Column:
    """``url_with`` as a column."""
    return F.pandas_udf(lambda s: s.map(lambda u: None if u is None else url_with(u, **values)), StringType())(url)


def safe_filename(name: Column, default: str = "download.bin") -> Column:
    """Last path part, decoded, with signs a file system forbids as ``_``."""
    path = F.regexp_replace(unquoted(filled(name)), r"(?:/\.?)+$", "")
    base = F.regexp_replace(strip(F.regexp_extract(path, r"([^/]*)$", 1)), r"\x00", "")
    base = F.when(base != ".", F.regexp_replace(base, r'[<>:"/\\|?*]', "_"))
    return F.when(filled(base) == "", default).otherwise(base)


def safe_component(name: Column, default: str = "record") -> Column:
    part = F.substring(F.regexp_replace(F.regexp_replace(name, r"[^0-9A-Za-z가-힣._-]+", "_"), r"^[._]+|[._]+$", ""), 1, 96)
    return F.when(filled(part) == "", default).otherwise(part)


def attachment_role(filename: Column) -> Column:
    return F.when(filled(filename).rlike("(?iuU)" + SUPPORTING), "supporting").otherwise("document")


def strip_front_matter(text: Column) -> Column:
    return F.regexp_replace(text, r"(?sU)^---\s*\n.*?\n---\s*\n?", "")


def front_block(text: Column) -> Column:
    """The lines between the leading marks; empty without them."""
    return F.regexp_extract(text, r"(?sU)^---\s*\n(.*?)\n---\s*\n", 1)


@F.pandas_udf(MapType(StringType(), StringType()))
def front_matter(text: pd.Series) -> pd.Series:
    """The leading block's values by key, each as JSON text; null without a block or where it is no mapping."""
    import yaml

    def parse(t: str | None) -> dict | None:
        m = re.match(r"^---\s*\n(.*?)\n---\s*\n", t or "", re.S)
        try:
            found = yaml.safe_load(m[1]) if m else None
        except yaml.YAMLError:
            return None
        return {str(k): json.dumps(v, ensure_ascii=False, default=str) for k, v in found.items()} if isinstance(found, dict) else None

    return text.map(parse)


def yaml_value(value: Column) -> Column:
    """A scalar as JSON text, null as null."""
    return F.when(value.isNull(), "null").otherwise(F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", ""))


def markdown(fields: dict[str, Column], head: Column, body: Column) -> Column:
    """Front matter of ``fields`` (texts as they are), ``head`` and the stripped body with a final line end."""
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in fields.items()]
    return F.concat(F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"), head), strip(filled(body)), F.lit("\n"))


def set_front_value(text: Column, key: str, value: Column) -> Column:
    """``text`` with the line of ``key`` in its front matter replaced; unchanged where the block has no such line."""
    head = F.regexp_extract(text, r"(?sU)^(---\s*\n.*?\n---\s*\n)", 1)
    line = F.concat(F.lit(f"{key}: "), F.regexp_replace(value, r"([\\$])", r"\\$1"))
    new = F.regexp_replace(head, F.lit(rf"(?md)^{key}:[^\n]*$"), line)
    return F.when(head != "", F.concat(new, F.substring(text, F.length(head) + 1, F.length(text)))).otherwise(text)


def normalize_lines(text: Column) -> Column:
    """Line ends as LF, trailing blanks of lines dropped, a line end at the end."""
    x = F.regexp_replace(text, "\r\n|[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", "\n")
    return F.concat(F.regexp_replace(F.regexp_replace(x, r"\n\z", ""), r"[ \t]+(?=\n|\z)", ""), F.lit("\n"))


def text_quality(text: Column, title: Column, institution: str | None = None) -> dict[str, Column]:
    """Metrics of an extracted text."""
    # signs are counted by what is left without them, not as a list of matches
    solid = F.length(F.regexp_replace(text, f"[{BLANKS}]+", ""))
    hangul = F.length(text) - F.length(F.regexp_replace(text, f"{HANGUL}+", ""))
    refs = F.transform(F.regexp_extract_all(text, F.lit(uni(ARTICLE_NUMBER)), 0), lambda x: F.regexp_replace(x, " ", ""))
    key = canonical_key(title, institution)
    return {
        "text_chars": F.length(text),
        "non_whitespace_chars": solid,
        "hangul_chars": hangul,
        "hangul_ratio": F.bround(hangul / F.greatest(F.lit(1), solid), 6),
        "replacement_chars": F.length(text) - F.length(F.replace(text, F.lit("�"), F.lit(""))),
        "article_count": F.size(F.array_distinct(refs)),
        "title_present": (key != "") & simple_key(text).contains(key),
    }


def quality_errors(q: dict[str, Column]) -> Column:
    """Why a text is not accepted, in fixed order; empty if it is."""
    tests = [q["text_chars"] < 200, q["hangul_chars"] < 80, q["hangul_ratio"] < 0.15, q["replacement_chars"] > 0, ~q["title_present"]]
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in zip(QUALITY_ERRORS, tests, strict=True)]))


def shingles(text: Column, size: int = 5) -> Column:
    """Distinct ``size``-character pieces of the text without white space; a shorter text is one piece, an empty one none."""
    x = F.regexp_replace(filled(text), uni(f"{SPACES}+"), "")
    many = F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - size + 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(size)))
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.array_distinct(many))


@F.pandas_udf(ArrayType(StringType()))
def long_shingles(text: pd.Series) -> pd.Series:
    """``shingles`` of five characters, faster for texts of any length."""

    def cut(t: str | None) -> list[str]:
        x = "".join((t or "").split())
        return list(dict.fromkeys(x[i : i + 5] for i in range(max(len(x) - 4, 1)))) if x else []

    return text.map(cut)


@F.pandas_udf(DoubleType())
def text_overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    """``overlap_ratio`` of two texts; their shingles exist for one pair at a time, in the task."""

    def cut(t: str | None) -> set[str]:
        x = "".join((t or "").split())
        return {x[i : i + 5] for i in range(max(len(x) - 4, 1))} if x else set()

    def ratio(x: set[str], y: set[str]) -> float:
        return round(len(x & y) / min(len(x), len(y)), 6) if x and y else 0.0

    return pd.Series([ratio(cut(x), cut(y)) for x, y in zip(a, b, strict=True)], dtype="float64")


def overlap_ratio(a: Column, b: Column) -> Column:
    """Common shingles over the smaller set, six decimals; 0 if either is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.bround(F.size(F.array_intersect(a, b)) / least, 6)).otherwise(0.0)
