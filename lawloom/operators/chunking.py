"""Legal-structure chunks under a token budget."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lawloom.functions import ids, rules
from lawloom.functions.text import TOKEN, clean, filled, strip_front_matter, token_estimate, uni
from lawloom.operators.catalog import table_digest

# Where an article begins, and the marks of paragraphs, items and appendices in a piece.
ARTICLE_HEAD = r"^(?:#{1,6}\s*)?(제\s*\d+\s*조(?:의\s*\d+)?)(?:\s*\(([^)]+)\))?"
PARAGRAPH_SIGN = r"(?<![가-힣])[①②③④⑤⑥⑦⑧⑨⑩]"
PARAGRAPH = r"^\s*(\d+)항"
ITEM = r"^\s*(\d+)\s*[.)]"
APPENDIX = r"(별\s*(?:표|지)(?:\s*제?\s*\d+\s*호?)?)"
#: What ``(?U)\s`` matches.
SPACE = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# Labels of the text that is embedded.
KINDS = {"regulation": "규정"}
OTHER_KIND = "지침"
TARGET, MOST, OVERLAP = 700, 1200, 80
# What a chunk takes from its version whenever it is refreshed.
REFRESHED = ("document_id", "version_group_id", "document_type", "title", "category", "department", "authority_level", "access_level", "is_current", "current_status", "enactment_date", "revision_date", "effective_date", "source_file", "normalized_file", "sha256")
PIECES = "version_id string, position int, article_no string, article_title string, section_path string, chapter string, section string, part int, piece string, lead string"


def split_articles(docs: DataFrame, key: str = "doc_id", text: str = "text", headings: bool = False) -> DataFrame:
    """(key, position, article_no, article_title, body) of each article; what stands before the first has no number. Blank texts give none.

    With ``headings`` also the array of headings in force where the article begins.
    """
    begin = uni("(?md)(?=" + ARTICLE_HEAD + ")")
    parts = F.split(strip_front_matter(F.col(text)), begin)
    solid = r"(?U)\S"
    if headings:
        # a text without a sign of a heading at the start of a line does not go to Python
        rows = docs.select(key, parts.alias("parts"), strip_front_matter(F.col(text)).rlike("(?md)^#").alias("headed")).withColumn("stacks", heading_stacks(F.when(F.col("headed"), F.col("parts"))))
        none = F.array().cast("array<string>")
        both = F.transform("parts", lambda x, i: F.struct(x.alias("part"), F.when(F.col("headed"), F.get("stacks", i)).otherwise(none).alias("headings")))
        rows = rows.select(key, F.posexplode(F.filter(both, lambda x: x["part"].rlike(solid))).alias("position", "x")).select(key, "position", "x.part", "x.headings")
    else:
        rows = docs.select(key, F.posexplode(F.filter(parts, lambda x: x.rlike(solid))).alias("position", "part"))
    head = uni(ARTICLE_HEAD)
    no = F.regexp_replace(F.regexp_extract("part", head, 1), r"(?U)\s", "")
    title = F.regexp_extract("part", head, 2)
    return rows.select(key, "position", F.nullif(no, F.lit("")).alias("article_no"), F.nullif(title, F.lit("")).alias("article_title"), F.btrim("part", F.lit(SPACE)).alias("body"), *["headings"] * headings)


def article_marks(body: Column) -> dict[str, Column]:
    """Paragraph, item and appendix that a piece names first."""
    found = lambda p, i: F.nullif(F.regexp_extract(body, uni("(?md)" + p), i), F.lit(""))
    paragraph = F.coalesce(found(PARAGRAPH_SIGN, 0), F.regexp_replace(found(PARAGRAPH, 0), r"(?U)^\s+|\s+$", ""))
    return {"paragraph_no": paragraph, "item_no": found(ITEM, 1), "appendix_no": F.regexp_replace(found(APPENDIX, 1), r"(?U)\s+", "")}


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def heading_stacks(parts: pd.Series) -> pd.Series:
    """For each part of a text the headings in force where it begins: a heading of level n keeps the first n - 1 of those before it."""

    def stacks(parts: list[str] | None) -> list[list[str]] | None:
        if parts is None:
            return None
        text = "".join(parts)
        heads = re.finditer(r"^(#{1,6})\s+(.+)$", text, re.M)
        out, stack, start, head = [], [], 0, next(heads, None)
        for part in parts:
            begin = start + len(part) - len(part.lstrip())  # headings count up to the article's own first sign
            while head and head.end() <= begin:
                stack = [*stack[: len(head[1]) - 1], head[2].strip()]
                head = next(heads, None)
            out.append(stack)
            start += len(part)
        return out

    return parts.map(stacks)


def estimate(text: str) -> int:
    hangul = len(re.findall("[가-힣]", text))
    return max(1, (hangul + 1) // 2 + len(re.findall(TOKEN, text)))


def halves(text: str, most: int) -> list[str]:
    """``text`` cut at the line end or blank nearest its middle, never in the first quarter, again and again until each part has at most ``most`` tokens."""
    done, todo = [], [text]
    while todo:
        x = todo.pop()
        if estimate(x) <= most or len(x) < 2:
            done.append(x)
            continue
        mid = len(x) // 2
        near = {x.rfind(sign, 0, mid) for sign in "\n "} | {x.find(sign, mid) for sign in "\n "}
        # of two at the same distance a line end counts before a blank, and what is before the middle first
        ranked = sorted((abs(i - mid), i >= mid, x[i] != "\n", i) for i in near if i > len(x) // 4)
        at = ranked[0][3] if ranked else mid
        todo += [x[at:].strip(), x[:at].strip()]
    return done


def divide(text: str, target: int, most: int) -> list[str]:
    """Pieces of at most ``most`` estimated tokens: paragraphs packed up to ``target``, longer ones cut in halves."""
    if estimate(text) <= most:
        return [text]
    out: list[str] = []
    for part in (p for block in re.split(r"\n\s*\n", text) for p in halves(block, most)):
        joined = f"{out[-1]}\n\n{part}" if out else part
        if out and estimate(joined) > target:
            out.append(part)
        else:
            out[-1:] = [joined]
    return out


def tail(text: str, budget: int) -> str:
    """The longest end of whole words, with the white space between them, within ``budget`` estimated tokens."""
    kept = ""
    for word in reversed(re.findall(r"\S+\s*", text)) if budget > 0 else ():
        if estimate(word + kept) > budget:
            break
        kept = word + kept
    return kept.strip()


def _context(title: str, kind: str, path: str | None, no: str | None, article: str | None, body: str) -> str:
    join = " > " if path and no else ""
    return f"문서명: {title}\n유형: {KINDS.get(kind, OTHER_KIND)}\n위치: {path or ''}{join}{no or ''} {article or ''}\n본문: {body}"


def embedding_text(title: Column, kind: Column, path: Column, no: Column, article: Column, body: Column) -> Column:
    """The labelled lines that are embedded with a chunk's text."""
    label = F.lit(OTHER_KIND)
    for name, shown in KINDS.items():
        label = F.when(kind == name, shown).otherwise(label)
    place = F.concat(filled(path), F.when((filled(path) != "") & (filled(no) != ""), " > ").otherwise(""), filled(no), F.lit(" "), filled(article))
    return F.concat(F.lit("문서명: "), title, F.lit("\n유형: "), label, F.lit("\n위치: "), place, F.lit("\n본문: "), body)


def citation(title: Column, article: Column, date: Column) -> Column:
    return F.concat(title, F.when(filled(article) != "", F.concat(F.lit(" "), article)).otherwise(""), F.when(filled(date) != "", F.concat(F.lit(", "), date, F.lit(" 개정"))).otherwise(""))


def refresh(chunks: DataFrame, versions: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Chunks (chunk_id, version_id, text and place) with all that follows from their version, their document and their text; ids, texts and places stay.

    Columns that ``versions`` lacks come out null. A chunk of a version without a document is not the latest.
    """
    have = {c: F.col(c) if c in versions.columns else F.lit(None).cast("boolean" if c == "is_current" else "string") for c in REFRESHED}
    states = {c: F.coalesce(F.col(c), F.lit("unknown")) if c in versions.columns else F.lit("unknown") for c in ("validity_status", "status_confidence")}
    url = [F.col(c) for c in ("source_page_url", "source_url") if c in versions.columns] or [F.lit(None).cast("string")]
    v = versions.select("version_id", *[x.alias(c) for c, x in {**have, **states}.items()], F.coalesce(*[F.nullif(u, F.lit("")) for u in url]).alias("source_url"))
    if documents is None:
        v = v.withColumn("is_latest_version", F.lit(False))
    else:
        v = v.join(documents.select("document_id", F.col("latest_version_id").alias("_latest")), "document_id", "left").withColumn("is_latest_version", F.col("version_id").eqNullSafe(F.col("_latest"))).drop("_latest")
    kept = [c for c in chunks.columns if c == "version_id" or c not in v.columns]
    out = chunks.select(*kept).join(v, "version_id")
    out = out.withColumn("_class", rules.classify_section(F.col("text"), F.col("section_path")))
    embed = embedding_text(F.col("title"), F.col("document_type"), F.col("section_path"), F.col("article_no"), F.col("article_title"), F.col("text"))
    out = out.withColumns({"chunk_schema_version": F.lit("2.0"), "section_kind": F.col("_class.kind"), "retrieval_scope": F.col("_class.scope"), "normative_status": F.col("_class.normative"), "citation_label": citation(F.col("title"), F.col("article_no"), F.col("revision_date")), "text_for_embedding": embed})
    return out.withColumn("token_count", token_estimate(F.col("text_for_embedding"))).drop("_class")


def build_chunks(versions: DataFrame, documents: DataFrame | None = None, target: int = TARGET, most: int = MOST, overlap: int = OVERLAP) -> DataFrame:
    """Chunks of versions (version_id, document_id, document_type, title, text, revision_date and more, see ``refresh``).

    Each article is cut so that its text with its labelled context, the headings in force at its start
    included, stays within ``most``; a piece after the first begins with the end of the raw piece before it
    as far as room is left. Paragraph, item and appendix come from the raw piece. Empty and null texts have
    no chunks. A context that alone reaches ``most`` would leave chunks above it: the job that reads the result
    then fails and names the chunk.
    """
    if "document_type" not in versions.columns:
        versions = versions.withColumn("document_type", F.lit(None).cast("string"))
    place = split_articles(versions.select("version_id", "text"), "version_id", headings=True).withColumn("section_path", F.nullif(F.array_join("headings", " > "), F.lit("")))
    articles = place.join(versions.select("version_id", "title", "document_type"), "version_id")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                around = max(0, estimate(_context(r.title, r.document_type, r.section_path, r.article_no, r.article_title, "")) - 1)
                whole = lambda piece: estimate(_context(r.title, r.document_type, r.section_path, r.article_no, r.article_title, piece))  # noqa: B023, E731
                pieces = divide(r.body, max(1, target - around), max(1, most - around))
                if any(whole(piece) > most for piece in pieces):  # one that fills its room may be one token above the limit with its context
                    pieces = divide(r.body, max(1, target - around), max(1, most - around - 1))
                for i, piece in enumerate(pieces):
                    used = whole(piece)
                    lead = tail(pieces[i - 1], min(overlap, max(0, most - used))) if i else ""
                    rows.append((r.version_id, r.position, r.article_no, r.article_title, r.section_path, r.chapter, r.section, i + 1, piece, lead))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])

    first, last = F.get("headings", F.lit(0)), F.element_at(F.nullif("headings", F.array().cast("array<string>")), -1)
    pieces = articles.select("version_id", "title", "document_type", "position", "article_no", "article_title", "section_path", first.alias("chapter"), last.alias("section"), "body").mapInPandas(cut, PIECES)
    each = Window.partitionBy("version_id").orderBy("position", "part")
    text = F.when(F.col("lead") != "", F.regexp_replace(F.concat("lead", F.lit("\n\n"), "piece"), r"(?U)^\s+|\s+$", "")).otherwise(F.col("piece"))
    out = pieces.withColumns(article_marks(F.col("piece"))).withColumns({"chunk_index": F.row_number().over(each) - 1, "text": text, "page_start": F.lit(None).cast("int"), "page_end": F.lit(None).cast("int"), "chunk_id": ids.chunk_id(F.col("version_id"), F.col("position") + 1, F.col("article_no"), F.col("part"))})
    return within_limit(refresh(out.drop("piece", "lead", "position", "part"), versions, documents), most)


def over_limit(chunks: DataFrame, most: int = MOST) -> DataFrame:
    return chunks.where(F.col("token_count") > most)


def within_limit(chunks: DataFrame, most: int = MOST) -> DataFrame:
    """``chunks``; an error that names the chunk for each one above ``most`` tokens. A filter, so that it is tested whatever columns are read."""
    above = F.concat(F.lit("chunk above the limit: "), F.col("chunk_id"), F.lit(" = "), F.col("token_count").cast("string"))
    return chunks.where(F.assert_true(F.col("token_count") <= most, above).isNull())


def chunkable(versions: DataFrame) -> DataFrame:
    """Versions that may have chunks: public ones with a text file."""
    return versions.where((F.col("access_level") == "public") & (filled(F.col("normalized_file")) != ""))


def full(versions: DataFrame, documents: DataFrame, **budget: int) -> DataFrame:
    """Chunks of all versions that may have any."""
    return build_chunks(chunkable(versions), documents, **budget)


def orphan_chunks(reference: DataFrame, versions: DataFrame) -> DataFrame:
    return reference.join(versions.select("version_id"), "version_id", "left_anti")


def incremental(versions: DataFrame, documents: DataFrame, reference: DataFrame, **budget: int) -> DataFrame:
    """Reference chunks of known versions refreshed, with their ids and texts, and chunks of the versions that have none.

    ``incremental_errors`` tells whether the step is allowed. Refreshed chunks come first within their version by index and id.
    """
    may = chunkable(versions)
    known = reference.select("version_id").distinct()
    fresh = build_chunks(may.join(known, "version_id", "left_anti"), documents, **budget)
    return refresh(reference, may, documents).unionByName(fresh, allowMissingColumns=True)


def incremental_errors(versions: DataFrame, reference: DataFrame, result: DataFrame) -> DataFrame:
    """(error, key) of an incremental step: chunks of unknown versions, public chunks that would go, chunks that went, chunks whose text changed. Empty if the step is allowed."""
    lost = reference.join(versions.select("version_id"), "version_id", "left_anti").select(F.lit("unknown_version").alias("error"), F.col("version_id").alias("key")).distinct()
    closed = reference.select("version_id").distinct().join(versions, "version_id", "left_semi").join(chunkable(versions).select("version_id"), "version_id", "left_anti")
    closed = closed.select(F.lit("withdrawn_version").alias("error"), F.col("version_id").alias("key"))
    after = result.select("chunk_id", F.col("text").alias("after"))
    removed = reference.join(after, "chunk_id", "left_anti").select(F.lit("removed").alias("error"), F.col("chunk_id").alias("key"))
    changed = reference.select("chunk_id", "text").join(after, "chunk_id").where(~F.col("text").eqNullSafe(F.col("after"))).select(F.lit("text_changed").alias("error"), F.col("chunk_id").alias("key"))
    return lost.unionByName(closed).unionByName(removed).unionByName(changed)


def id_changes(reference: DataFrame, result: DataFrame) -> DataFrame:
    """One row: reference_chunks, chunks, documents_with_chunks, retained_ids, removed_ids, new_ids."""
    both = reference.select("chunk_id", F.lit(1).alias("old")).join(result.select("chunk_id", "document_id", F.lit(1).alias("new")), "chunk_id", "full")
    return both.agg(
        F.count("old").alias("reference_chunks"), F.count("new").alias("chunks"), F.count_distinct("document_id").alias("documents_with_chunks"),
        F.count_if(F.col("old").isNotNull() & F.col("new").isNotNull()).alias("retained_ids"), F.count_if(F.col("new").isNull()).alias("removed_ids"), F.count_if(F.col("old").isNull()).alias("new_ids"),
    )


def make_chunks(mode: str, versions: DataFrame, documents: DataFrame, reference: DataFrame, canonical: bool = False, allow_id_changes: bool = False, check_determinism: bool = False, check_reference: DataFrame | None = None, **budget: int) -> DataFrame:
    """``incremental``, ``preview`` or ``rechunk``; ``canonical`` says that the result replaces the reference.

    ValueError for a preview that would replace it, and for a rechunk that would without ``allow_id_changes``.
    RuntimeError where an incremental step is not allowed, where two builds differ (``check_determinism``) and
    where the result is not the table ``check_reference``.
    """
    if check_determinism or check_reference is not None:
        result = make_chunks(mode, versions, documents, reference, canonical, allow_id_changes, **budget)
        for other in [make_chunks(mode, versions, documents, reference, canonical, allow_id_changes, **budget)] * check_determinism + [check_reference] * (check_reference is not None):
            if table_digest(result, "chunk_id").first() != table_digest(other.select(result.columns), "chunk_id").first():
                raise RuntimeError("chunks differ between two builds or from the table they were compared with")
        return result
    if mode not in ("incremental", "preview", "rechunk"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "preview" and canonical:
        raise ValueError("a preview never replaces the reference chunks")
    if mode == "rechunk" and canonical and not allow_id_changes:
        raise ValueError("replacing all chunks needs allow_id_changes")
    if mode != "incremental":
        return full(versions, documents, **budget)
    result = incremental(versions, documents, reference, **budget)
    errors = incremental_errors(versions, reference, result).limit(5).collect()
    if errors:
        raise RuntimeError(f"incremental step refused: {[(r.error, r.key) for r in errors]}")
    return result


def context(value: Column) -> Column:
    """A result's context: white space collapsed, 280 characters at most."""
    x = clean(value)
    return F.when(F.length(x) > 280, F.concat(F.substring(x, 1, 277), F.lit("..."))).otherwise(x)
