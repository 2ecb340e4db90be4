"""Index, filtered BM25 search and retrieval evaluation."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lawloom.functions import rules, text
from lawloom.operators import chunking, postings, trigrams
from lawloom.operators.postings import Segment
from lawloom.sources.shared import stored
from lawloom.sources.snapshots import Snapshots

# The weights in effect for each field.
WEIGHTS = {"title": 4.0, "aliases": 1.0, "body": 2.0, "compact": 1.0}
# What a shown result consists of.
DISPLAY = ("rank", "title", "document_type", "department", "document_id", "version_id", "validity_status", "status_confidence", "revision_date", "effective_date", "article_no", "section_kind", "context", "normalized_file", "source_page_url", "sha256", "citation_label")
HIDDEN = ("search_text", "compact_text")
TERM = r"[\p{L}\p{N}]+"
#: What substrings are looked for in.
TITLES = ("normalized_title", "compact_title", "normalized_aliases", "compact_aliases")
#: What rows are filtered by besides.
FILTERED = ("document_type", "department", "validity_status", "status_confidence", "article_no", "appendix_no", "revision_date", "effective_date", "is_latest_version", "retrieval_scope")
#: How many times as many rows are looked at where the first do not fill an answer.
MORE = 8
#: A table of so many rows is sent to all tasks, so that texts are not shuffled to be joined with it.
FEW = 20_000


def _plain_letters() -> tuple[str, str]:
    """Letters made of a Latin one and one mark, lower case, and the Latin letters alone."""
    forms = {c: unicodedata.normalize("NFD", c) for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if c == c.lower()}
    found = {c: d[0] for c, d in forms.items() if len(d) == 2 and d[0].isascii()}
    return "".join(found), "".join(found.values())


ACCENTS, PLAIN = _plain_letters()


def terms(value: Column) -> Column:
    """Index terms of a text in order: runs of letters and digits, lower case, Latin letters without their mark."""
    return F.regexp_extract_all(F.translate(F.lower(text.filled(value)), ACCENTS, PLAIN), F.lit(f"({TERM})"), 1)


def value_terms(value: str) -> list[str]:
    """``terms`` of one value."""
    return re.findall(r"[^\W_]+", value.lower().translate(str.maketrans(ACCENTS, PLAIN)))


def query_form(query: str) -> str:
    """``text.search_text`` of one value."""
    return re.sub(r"\s+", " ", re.sub(text.SEPARATORS, " ", text.folded(query))).strip()


def query_phrases(query: str) -> list[list[str]]:
    """What a query asks for: each word of its search form, and its compact form unless that is one of the words, as phrases of terms. Any of them will do."""
    words = query_form(query).split()
    compact = "".join(words)
    asked = words + [compact] * bool(compact and compact not in words)
    return [p for p in map(value_terms, asked) if p]


def semantic_fields(chunks: DataFrame, versions: DataFrame, documents: DataFrame, early: Callable[[DataFrame], DataFrame] = lambda j: j) -> DataFrame:
    """Chunks with their state and class: the version's, else the document's, else what follows from the chunk. A missing column counts as missing in all rows.

    ``early`` is applied to the chunks with ``alternative_titles`` before the versions are joined: what it drops is not shuffled for them.
    """
    states = {"validity_status": "unknown", "validity_evidence": None, "validity_checked_at": None, "status_confidence": "unknown"}
    pick = ["is_latest_version", *states, "source_url_quality", "source_page_url"]
    v = versions.select("version_id", *[F.col(c).alias(f"_v_{c}") for c in pick if c in versions.columns])
    also = [c for c in (*pick, "latest_version_id", "alternative_titles") if c in documents.columns]
    d = documents.select("document_id", *[F.col(c).alias(f"_d_{c}") for c in also])
    named = F.coalesce(*[F.col("_d_alternative_titles")] * ("alternative_titles" in also), F.array().cast("array<string>"))
    j = early(chunks.join(d, "document_id", "left").withColumn("alternative_titles", named)).join(v, "version_id", "left")
    have = lambda *names: [F.col(n) for n in names if n in j.columns]
    found = {c: F.coalesce(*have(f"_v_{c}", f"_d_{c}"), F.lit(default).cast("string")) for c, default in states.items()}
    found["is_latest_version"] = F.coalesce(*have("_v_is_latest_version"), *[F.col("version_id") == x for x in have("_d_latest_version_id")], F.lit(False))
    found["source_url_quality"] = F.coalesce(*have("_v_source_url_quality", "_d_source_url_quality"), text.url_quality(F.col("source_url")) if "source_url" in j.columns else F.lit("unknown"))
    kind = rules.classify_section(F.col("text"), F.col("section_path") if "section_path" in j.columns else F.lit(None).cast("string"))
    for name, part in (("section_kind", "kind"), ("retrieval_scope", "scope"), ("normative_status", "normative")):
        found[name] = F.coalesce(*[F.col(name)] * (name in chunks.columns), kind[part])
    found["source_page_url"] = F.coalesce(*[F.nullif(x, F.lit("")) for x in have("_v_source_page_url", "_d_source_page_url", "source_url")], F.lit(None).cast("string"))
    return j.withColumns(found).drop(*[c for c in j.columns if c.startswith(("_v_", "_d_"))])


def index_rows(chunks: DataFrame, versions: DataFrame, documents: DataFrame) -> DataFrame:
    """Public chunks with what search shows, filters by and looks in."""
    return text_forms(title_forms(semantic_fields(chunks.where("access_level = 'public'"), versions, documents)))


def title_forms(rows: DataFrame) -> DataFrame:
    """Adds ``TITLES``."""
    title = F.col("title")
    listed = lambda f: F.concat(F.lit("|"), F.array_join(f, "|"), F.lit("|"))
    # the search form is taken of the joined list, in which no alias holds the sign between them
    folded = text.search_text(F.array_join("alternative_titles", "\x02"))
    each = F.when(F.size("alternative_titles") > 0, F.transform(F.split(folded, "\x02"), lambda x: F.trim(x))).otherwise(F.array().cast("array<string>"))
    return rows.withColumns(
        {
            "normalized_title": text.search_text(title),
            "compact_title": text.compact_text(title),
            "normalized_aliases": listed(each),
            "compact_aliases": listed(F.transform(each, lambda x: F.regexp_replace(x, " ", ""))),
        }
    )


def text_forms(rows: DataFrame) -> DataFrame:
    """Adds ``HIDDEN``: the forms of title, aliases, department and text together. Each part is folded once, as the blanks between them keep the parts of a form apart."""
    names = F.concat_ws(" ", text.filled(F.col("title")), F.array_join("alternative_titles", " "))
    department = F.coalesce("department", F.lit("None")) if "department" in rows.columns else F.lit("")  # a null is written out by the index format
    rows = rows.withColumns({"_names": text.search_text(names), "_department": text.search_text(department), "_text": text.search_text(F.col("text"))})
    joined = lambda *parts: F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts])
    whole = {"search_text": joined(*map(F.col, ("_names", "_department", "_text"))), "compact_text": F.replace(F.concat("_names", "_text"), F.lit(" "), F.lit(""))}
    return rows.withColumns(whole).drop("_names", "_department", "_text")


def indexed_fields(rows: DataFrame, *also: str) -> DataFrame:
    """(chunk_id, title, aliases, body, compact) of index rows: what is looked in; ``also`` are kept beside."""
    return rows.select(*dict.fromkeys(["chunk_id", "title", *also]), F.array_join("alternative_titles", " ").alias("aliases"), F.col("search_text").alias("body"), F.col("compact_text").alias("compact"))


def term_counts(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, term, field, tf) of every term."""
    marked = lambda f: F.transform(terms(F.col(f)), lambda t: F.struct(t.alias("term"), F.lit(f).alias("field")))
    found = rows.select(key, F.explode(F.concat(*map(marked, fields))).alias("x"))
    return found.groupBy(key, "x.term", "x.field").agg(F.count("*").alias("tf"))


def write_postings(rows: DataFrame, key: str, fields: list[str], path: str, weights: list[float] | None = None) -> None:
    """The inverted index of the terms of ``fields`` at ``path``; each text is cut once for it."""
    postings.write_postings(rows.select(key, *[terms(F.col(f)).alias(f) for f in fields]), key, fields, path, weights)


def write_segment(rows: DataFrame, path: str) -> None:
    """Index rows in folders by the two columns that every search filters by, their postings, and the trigrams of titles and texts."""
    rows.write.mode("overwrite").partitionBy("retrieval_scope", "is_latest_version").option("compression", "zstd").parquet(f"{path}/rows")
    stored = segment_rows(rows.sparkSession, path)
    write_postings(indexed_fields(stored), "chunk_id", list(WEIGHTS), path, list(WEIGHTS.values()))
    trigrams.write_trigrams(stored, "chunk_id", [*TITLES, *HIDDEN], path)


def write_index(rows: DataFrame, path: str) -> None:
    """An index of one segment that is never changed; ``segments`` keeps one that is."""
    write_segment(rows, path)


def segment_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").withColumn("is_latest_version", F.col("is_latest_version").cast("boolean"))


def open_segments(spark: SparkSession, path: str, snapshot: int | None = None) -> list[Segment]:
    """The segments of an index, of its last snapshot by default; an index without a log is one segment. None where no postings were written."""
    state = Snapshots(spark, path).state(snapshot)
    if not state["number"]:
        one = postings.segment_at(spark, path)
        return [one] if one else []
    return [Segment(f"{path}/{s['folder']}", {**s["stats"], **s.get("dead_stats", {})}, f"{path}/{s['dead']}" if s.get("dead") else None) for s in state["notes"]["segments"]]


def spark_rows(spark: SparkSession, path: str, segments: list[Segment] | None = None) -> DataFrame:
    """Live index rows; filters by scope and latest version choose folders."""
    segments = open_segments(spark, path) if segments is None else segments
    if not segments:
        log = Snapshots(spark, path)
        if not log.latest():
            return segment_rows(spark, path)
        return segment_rows(spark, f"{path}/{log.state()['notes']['last']}").limit(0)  # all rows are gone
    live = []
    for s in segments:
        rows = segment_rows(spark, s.path)
        live.append(rows.join(spark.read.parquet(f"{s.dead}/keys"), "chunk_id", "left_anti") if s.dead else rows)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), live)


def bm25_of(spark: SparkSession, path: str, key: str, phrases: list[list[str]], weights: list[float]) -> DataFrame:
    """(key, score, found) of rows that hold a phrase, from the index at ``path``; lower is better. found has (phrase, field, position) of each occurrence.

    Only the postings of the phrases' terms are read. Numbers of rows and lengths are those of all rows.
    """
    return postings.every_row(spark, open_segments(spark, path), key, phrases, weights)


def candidates(limit: int, per_group: int) -> int:
    """How many of the best rows are looked at first; more are where they do not fill the answer."""
    return max(limit * max(per_group, 1) * 5, 50)


def capped(ranked: DataFrame, group: str, order: list[Column], limit: int = 10, per_group: int = 2, among: int | None = None) -> DataFrame:
    """The first rows in order, at most ``per_group`` of a group, then ``limit``; rank from 1. ``among`` asks for those of the first so many rows alone."""
    first = ranked if among is None else ranked.orderBy(*order).limit(among)
    held = first.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_r") <= max(per_group, 1)).drop("_r")
    return held.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def filtered(rows: DataFrame, filters: dict) -> DataFrame:
    """Conjunction of the filters that have a value."""
    tests: list[Column] = []
    form = lambda value: F.lit(query_form(value))
    for name in ("document_type", "department", "validity_status", "article_no", "appendix_no"):
        if filters.get(name):
            tests.append(F.col(name) == filters[name])
    if filters.get("title_exact"):
        t = form(filters["title_exact"])
        tests.append((F.col("normalized_title") == t) | F.col("normalized_aliases").contains(F.concat(F.lit("|"), t, F.lit("|"))))
    if filters.get("title_contains"):
        t = form(filters["title_contains"])
        c = F.regexp_replace(t, " ", "")
        tests.append(F.col("normalized_title").contains(t) | F.col("compact_title").contains(c) | F.col("normalized_aliases").contains(t) | F.col("compact_aliases").contains(c))
    for name, column, up in (("revision_from", "revision_date", False), ("revision_to", "revision_date", True), ("effective_from", "effective_date", False), ("effective_to", "effective_date", True)):
        if filters.get(name):
            tests.append(F.col(column) <= filters[name] if up else F.col(column) >= filters[name])
    if filters.get("current_only"):
        tests.append((F.col("validity_status") == "in_force") & (F.col("status_confidence") == "confirmed"))
    elif not filters.get("include_history"):
        tests.append(F.col("is_latest_version"))
    if not filters.get("include_secondary"):
        tests.append(F.col("retrieval_scope") == "primary")
    return rows.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def result_order() -> list[Column]:
    return [F.asc("score"), F.asc_nulls_first("title"), F.asc("chunk_id")]


def search(spark: SparkSession, path: str, query: str | None = None, filters: dict | None = None, limit: int = 10, per_document: int = 2, among: int | None = None) -> DataFrame:
    """Ranked rows of the index at ``path``, with score, context and rank; of the first ``among`` rows alone where it is given.

    Without a query the score is 0 and the order title, chunk; a query of separators alone finds nothing.
    Without postings in the index the query is looked for as a part of the texts, with score 0.
    """
    filters, segments = filters or {}, open_segments(spark, path)
    rows = spark_rows(spark, path, segments)
    if segments and filters.get("title_contains") and (t := query_form(filters["title_contains"])):
        c = t.replace(" ", "")
        rows = trigrams.holding(spark, segments, rows, "chunk_id", list(zip(TITLES, (t, c, t, c), strict=True)))
    chosen = filtered(rows, filters)
    first = lambda found: capped(found, "document_id", result_order(), limit, per_document, among)
    if not query:
        found = first(chosen.withColumn("score", F.lit(0.0)))
    elif segments:
        k = among or candidates(limit, per_document)
        while True:
            best = postings.top_rows(spark, segments, "chunk_id", query_phrases(query), list(WEIGHTS.values()), k, chosen).rows
            found = first(chosen.join(best.drop("found"), "chunk_id"))
            # documents with many of the best rows leave the answer short: then more rows are looked at, until there are no others
            if among or found.select("chunk_id").count() >= limit or best.select("chunk_id").count() < k:
                break
            k *= MORE
    else:
        found = first(like_fallback(chosen, query))
    return shown(found)


def shown(found: DataFrame) -> DataFrame:
    return found.withColumn("context", chunking.context(F.col("text"))).drop(*HIDDEN)


def occurrences(cut: Column, phrase: list[str]) -> Column:
    """How often a phrase occurs in an array of terms."""
    if len(phrase) == 1:
        return F.size(F.filter(cut, lambda x: x == phrase[0]))
    starts = F.sequence(F.lit(0), F.size(cut) - len(phrase))
    here = lambda at: reduce(lambda a, b: a & b, [F.get(cut, at + i) == t for i, t in enumerate(phrase)])
    return F.when(F.size(cut) >= len(phrase), F.size(F.filter(starts, here))).otherwise(0)


def class_text(chunks: DataFrame) -> Column:
    """The text where the scope has to be found from it, else null."""
    return F.when(F.col("retrieval_scope").isNull(), F.col("text")) if "retrieval_scope" in chunks.columns else F.col("text")


def sent_if_few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def counted_rows(tables: tuple[DataFrame, DataFrame, DataFrame], phrases: list[list[str]]) -> DataFrame:
    """The public chunks of (chunks, versions, documents) with what is filtered by, their number of terms ``dl`` and ``f``, the weighted frequency of each phrase. Each text is read once, and stored nowhere."""
    chunks, versions, documents = tables
    weights = list(WEIGHTS.values())

    def early(j: DataFrame) -> DataFrame:
        cut = indexed_fields(text_forms(j), *j.columns).withColumns({f"_{f}": terms(F.col(f)) for f in WEIGHTS})
        f = [reduce(lambda a, b: a + b, [occurrences(F.col(f"_{n}"), p) * F.lit(w) for n, w in zip(WEIGHTS, weights, strict=True)]) for p in phrases]
        cut = cut.withColumns({"dl": reduce(lambda a, b: a + b, [F.size(f"_{n}") for n in WEIGHTS]), "f": F.array(*f)})
        return cut.withColumn("text", class_text(chunks)).select(*j.columns, "dl", "f")

    rows = title_forms(semantic_fields(chunks.where("access_level = 'public'"), versions, sent_if_few(documents), early))
    kept = [c for c in ("chunk_id", "document_id", "title", *FILTERED, *TITLES, "dl", "f") if c in rows.columns]
    return stored(rows.select(*kept), "counted")


def scan(tables: tuple[DataFrame, DataFrame, DataFrame], queries: list[str | None], filters: dict | None = None, limit: int = 10, per_document: int = 2, among: int | None = None, digits: int | None = None) -> list[DataFrame]:
    """For each query (chunk_id, document_id, title, score, rank) as ``search`` would find them in an index of (chunks, versions, documents); with ``digits``, by the score rounded to so many.

    For tables that are searched once: all texts are read once for all queries, without an index, whose
    building costs many times a scan.
    """
    phrases = [query_phrases(q) if q else [] for q in queries]
    asked = [p for q in phrases for p in q]
    chunks, versions, documents = tables
    if asked:
        rows = counted_rows(tables, asked)
        at = lambda i: F.get("f", F.lit(i))
        sums = rows.agg(F.count("*").alias("n"), F.sum("dl").alias("dl"), *[F.count_if(at(i) > 0).alias(f"n{i}") for i in range(len(asked))]).first()
        avgdl = sums.dl / sums.n if sums.n and sums.dl else 1.0
    else:
        early = lambda j: j.withColumn("text", class_text(chunks))
        rows = title_forms(semantic_fields(chunks.where("access_level = 'public'"), versions, documents, early))
    chosen, out, begin = filtered(rows, filters or {}), [], 0
    for query, own in zip(queries, phrases, strict=True):
        mine = range(begin, begin := begin + len(own))
        found = chosen.withColumn("score", F.lit(0.0))
        if query:
            found = found.where(reduce(lambda a, b: a | b, [at(i) > 0 for i in mine], F.lit(False)))
        for i in mine:
            idf = max(math.log((sums.n - sums[f"n{i}"] + 0.5) / (sums[f"n{i}"] + 0.5)), postings.LEAST_IDF)
            found = found.withColumn("score", F.col("score") - F.lit(idf) * postings.share(at(i), F.col("dl"), avgdl))
        score = F.col("score") if digits is None else F.round("score", digits)
        out.append(capped(found.select("chunk_id", "document_id", "title", score.alias("score")), "document_id", result_order(), limit, per_document, among))
    return out


def scanned_rows(tables: tuple[DataFrame, DataFrame, DataFrame], found: DataFrame) -> DataFrame:
    """What ``search`` returns, of rows found by ``scan`` (chunk_id, score, rank): only theirs are made."""
    chunks, versions, documents = tables
    keys = F.broadcast(found.select("chunk_id").distinct())  # as many as are shown
    return shown(index_rows(chunks.join(keys, "chunk_id", "left_semi"), versions, documents).join(found.drop("document_id", "title"), "chunk_id"))


def like_fallback(rows: DataFrame, query: str, texts: tuple[str, str] = HIDDEN) -> DataFrame:
    """Rows whose search form or compact form holds that of the query, with score 0."""
    q = query_form(query)
    return rows.where(F.col(texts[0]).contains(q) | F.col(texts[1]).contains(q.replace(" ", ""))).withColumn("score", F.lit(0.0))


def substring_rows(spark: SparkSession, path: str, query: str, filters: dict | None = None) -> DataFrame:
    """``like_fallback`` over the rows of an index by its trigrams; for parts of any length."""
    segments = open_segments(spark, path)
    chosen, form = filtered(spark_rows(spark, path, segments), filters or {}), query_form(query)
    return trigrams.holding(spark, segments, chosen, "chunk_id", [(HIDDEN[0], form), (HIDDEN[1], form.replace(" ", ""))]).withColumn("score", F.lit(0.0))


def scanned_substring(tables: tuple[DataFrame, DataFrame, DataFrame], query: str, filters: dict | None = None) -> DataFrame:
    """``like_fallback`` over (chunks, versions, documents) that have no index: texts are read once, and only rows that hold the query go on."""
    chunks, versions, documents = tables
    early = lambda j: like_fallback(text_forms(j), query).withColumn("text", class_text(chunks)).drop(*HIDDEN)
    return filtered(title_forms(semantic_fields(chunks.where("access_level = 'public'"), versions, sent_if_few(documents), early)), filters or {})


def display(results: DataFrame) -> DataFrame:
    """What is shown of results, in order of rank."""
    return results.select(*[c if c in results.columns else F.lit(None).cast("string").alias(c) for c in DISPLAY]).orderBy("rank")


def tsv_lines(results: DataFrame) -> DataFrame:
    """(rank, line): the shown columns between tabs; tabs and line ends in them are blanks, nulls empty."""
    cells = [F.regexp_replace(text.filled(F.col(c).cast("string")), r"[\t\n]", " ") for c in DISPLAY]
    return display(results).select("rank", F.concat_ws("\t", *cells).alias("line"))


def snippets(rows: DataFrame, key: str, column: str, phrases: list[list[str]], size: int = 24, marks: tuple[str, str, str] = ("[", "]", "…")) -> DataFrame:
    """(key, snippet): the ``size`` terms of each text that hold most phrases, with marks around them and a sign where text is left out.

    A phrase counts 1000 when it is new in the window and 1 when it comes again. Windows begin so that what
    they hold lies in their middle, or at the start of a sentence, which counts 100 more, or 120 at the text's start.
    """

    def best(value: str) -> str:
        spans = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", value)]
        found = [value[a:b].lower().translate(str.maketrans(ACCENTS, PLAIN)) for a, b in spans]
        hits = sorted((at, n, len(p)) for n, p in enumerate(phrases) for at in range(len(found) - len(p) + 1) if found[at : at + len(p)] == p)
        opens = [0] + [i for i in range(1, len(spans)) if re.search(r"[.:][ \t\n\r]+$", value[spans[i - 1][1] : spans[i][0]])]

        def score(begin: int) -> tuple[int, int]:
            inside = [h for h in hits if begin <= h[0] < begin + size]
            points = sum(1000 if n not in {x[1] for x in inside[:k]} else 1 for k, (_, n, _) in enumerate(inside))
            if not inside:
                return 0, begin
            first, last = inside[0][0], inside[-1][0] + inside[-1][2]
            return points, max(0, min(first - int((size - (last - first)) / 2), len(found) - size))

        top, start = 0, 0
        for at, _, _ in hits:
            points, moved = score(at)
            if points > top:
                top, start = points, moved
            before = [o for o in opens if o <= at]
            if before and before[-1] < at and len(spans) > size:
                points = score(before[-1])[0] + (120 if before[-1] == 0 else 100)
                if points > top:
                    top, start = points, before[-1]
        if not spans:
            return value
        end = min(start + size, len(spans)) - 1
        out, at = [marks[2]] if start else [], spans[start][0] if start else 0
        inside, k = [h for h in hits if start <= h[0] <= end], 0
        while k < len(inside):
            begin, stop = inside[k][0], inside[k][0] + inside[k][2] - 1
            while k + 1 < len(inside) and inside[k + 1][0] <= stop:
                k += 1
                stop = max(stop, inside[k][0] + inside[k][2] - 1)
            stop = min(stop, end)
            out += [value[at : spans[begin][0]], marks[0], value[spans[begin][0] : spans[stop][1]], marks[1]]
            at, k = spans[stop][1], k + 1
        out += [value[at:]] if end >= len(spans) - 1 else [value[at : spans[end][1]], marks[2]]
        return "".join(out)

    cut = F.pandas_udf(lambda s: s.map(lambda v: None if v is None else best(v)), "string")
    return rows.select(key, cut(F.col(column)).alias("snippet"))


def public_rows(chunks: DataFrame, current_only: bool = True) -> DataFrame:
    """What an adapter loads: public chunks, of current versions only unless told otherwise."""
    rows = chunks.where("access_level = 'public'")
    return rows.where("is_current") if current_only else rows


def adapter_search(spark: SparkSession, chunks: DataFrame, query: str, path: str, limit: int = 10, current_only: bool = True) -> DataFrame:
    """(chunk_id, title, snippet) of the first ``limit`` chunks by id that hold a term of the query in title or text: a small index of its own at ``path``, without filters or ranking."""
    rows = public_rows(chunks, current_only)
    write_postings(rows, "chunk_id", ["title", "text"], path)
    phrases = [[t] for t in dict.fromkeys(value_terms(query))]
    first = bm25_of(spark, path, "chunk_id", phrases, [1.0, 1.0]).select("chunk_id").orderBy("chunk_id").limit(limit)
    hit = rows.join(first, "chunk_id", "left_semi")
    return hit.select("chunk_id", "title").join(snippets(hit, "chunk_id", "text", phrases), "chunk_id").orderBy("chunk_id")


def vector_rows(chunks: DataFrame, include_history: bool = False) -> DataFrame:
    """(chunk_id, text_for_embedding, payload) for a store of vectors; payload is all else as JSON."""
    rows = public_rows(chunks, not include_history)
    return rows.select("chunk_id", "text_for_embedding", F.to_json(F.struct(*[c for c in rows.columns if c not in ("chunk_id", "text_for_embedding")])).alias("payload"))


def cosine_top(vectors: DataFrame, key: str, column: str, query: list[float], limit: int) -> DataFrame:
    """The ``limit`` rows of greatest cosine with ``query``, ties by key; null, zero and shorter vectors are left out."""
    norm = math.sqrt(sum(x * x for x in query))
    dot = F.aggregate(F.zip_with(F.col(column).cast("array<double>"), F.array(*map(F.lit, query)), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    own = F.sqrt(F.aggregate(F.col(column).cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x))
    rows = vectors.select(key, F.try_divide(dot, own * norm).alias("cosine")).where("cosine is not null and not isnan(cosine)")
    return rows.orderBy(F.desc("cosine"), key).limit(limit)


def evaluate(results: DataFrame, expected: DataFrame, forbidden: DataFrame | None = None, least_recall: float = 1.0, least_mrr: float = 1.0, keys: tuple[str, ...] = ("document_id", "version_id")) -> DataFrame:
    """(cases, recall, mrr, passed) of ranked results (case, rank, section_kind and ``keys``) against expected (case and ``keys``).

    A case counts with its first expected result; one with a result of a kind that ``forbidden`` (case,
    section_kind) names counts as missed, as does one without results. The results are the first k of each
    case. Without any case nothing passes.
    """
    hit = expected.join(results.select("case", *keys, "rank"), ["case", *keys], "left").groupBy("case").agg(F.min("rank").alias("rank"))
    if forbidden is not None:
        bad = results.join(forbidden, ["case", "section_kind"], "left_semi").select("case").distinct().withColumn("bad", F.lit(True))
        hit = hit.join(bad, "case", "left").withColumn("rank", F.when(F.col("bad"), None).otherwise(F.col("rank")))
    r = F.when(F.col("rank").isNotNull(), 1 / F.col("rank")).otherwise(0.0)
    out = hit.agg(F.count("*").alias("cases"), F.avg(F.col("rank").isNotNull().cast("int")).alias("recall"), F.avg(r).alias("mrr"))
    return out.withColumn("passed", F.coalesce((F.col("recall") >= least_recall) & (F.col("mrr") >= least_mrr), F.lit(False)))


def evaluate_cases(spark: SparkSession, path: str, cases: list[dict], top_k: int = 5, least_recall: float = 1.0, least_mrr: float = 1.0) -> DataFrame:
    """``evaluate`` over configured cases (name, query, filters, expected, forbidden_section_kinds): one search a case, a document once. ValueError for a case that expects nothing."""
    if not cases or any(not c.get("expected") for c in cases):
        raise ValueError("every case needs expected ids")
    found = [search(spark, path, c.get("query"), c.get("filters"), top_k, 1).select(F.lit(c["name"]).alias("case"), "document_id", "version_id", "section_kind", "rank") for c in cases]
    expected = spark.createDataFrame([(c["name"], e["document_id"], e["version_id"]) for c in cases for e in c["expected"]], "case string, document_id string, version_id string")
    forbidden = spark.createDataFrame([(c["name"], k) for c in cases for k in c.get("forbidden_section_kinds") or []], "case string, section_kind string")
    return evaluate(reduce(DataFrame.unionByName, found), expected, forbidden, least_recall, least_mrr)
