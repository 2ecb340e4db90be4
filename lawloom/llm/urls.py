"""URL verdicts: rules first, then naive Bayes over segmented host and path tokens.

Host labels are cut into words by Viterbi search over a unigram model of the
words of all page titles; a multinomial naive Bayes over those tokens decides
what no rule does. Its classes come from what pages say, not from URLs: a page is
of the blocked class when its text, title and links included, has a sign word.
Sign words are given seeds (a parameter) and words that mostly stand on pages
with a seed. The score reads the URL alone, so it carries what pages say over to
all URLs that share tokens with theirs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEEDS = ("casino", "bet", "bets", "betting", "poker", "slots", "adult", "porn", "sex", "xxx", "escort", "viagra", "pills", "lottery", "jackpot")
#: Letters of the longest word that no title has; words of titles may be longer.
UNKNOWN_WORD = 24
SPAN = 200
MARKUP = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>"
NONE: dict = {}


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path up to ``? #``. Both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does. For lists of rules that a plan can hold."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def title_words(pages: DataFrame) -> DataFrame:
    """(t, n) of every word of all titles, stored."""
    title = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?is)<title[^>]*>([^<]*)", 1))
    words = pages.select(F.explode(F.regexp_extract_all(title, F.lit(r"(\p{L}+)"), 1)).alias("t"))
    return stored(words.groupBy("t").agg(F.count("*").alias("n")), "words")


def long_lengths(counted: DataFrame) -> tuple[int, ...]:
    """The different lengths of words over ``UNKNOWN_WORD`` letters: numbers, at most as many as the longest word has letters."""
    return tuple(sorted(r.n for r in counted.select(F.length("t").alias("n")).where(F.col("n") > UNKNOWN_WORD).distinct().collect()))


def page_words(html: Column) -> Column:
    """The different words of a page's text, title and link texts, lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.regexp_replace(F.coalesce(html, F.lit("")), MARKUP, " ")), F.lit(r"(\p{L}+)"), 1))


def head_and_rest(counts: DataFrame, most: int) -> tuple[list, DataFrame | None]:
    """The rows of the ``most`` frequent t by n, and a table of all others, None without any."""
    top = counts.orderBy(F.desc("n"), "t").limit(most + 1).collect()
    if len(top) <= most:
        return top, None
    last = top[most - 1]
    return top[:most], counts.where((F.col("n") < last.n) | ((F.col("n") == last.n) & (F.col("t") > last.t)))


def sign_words(pages: DataFrame, seeds: tuple[str, ...], least_pages: int = 5) -> DataFrame:
    """(t, n) of the words on ``least_pages`` pages or more, at least half of them with a seed, stored; all of them."""
    seen = pages.select(page_words(F.col("html")).alias("w")).withColumn("seeded", F.arrays_overlap("w", F.array(*map(F.lit, seeds))))
    counts = seen.select("seeded", F.explode("w").alias("t")).groupBy("t").agg(F.count("*").alias("n"), F.count_if("seeded").alias("k"))
    return stored(counts.where((F.col("n") >= least_pages) & (2 * F.col("k") >= F.col("n"))).select("t", "n"), "signs")


def with_signs(pages: DataFrame, taught: DataFrame, seeds: tuple[str, ...], keep: dict[str, Column], most: int = 1000) -> DataFrame:
    """Columns ``keep`` of pages and ``says``: whether the page has a seed or a sign word of ``taught``. The plan holds the ``most`` frequent sign words; all others are joined to the words of the pages that have none of these."""
    top, rest = head_and_rest(sign_words(taught, seeds), most)
    words = page_words(F.col("html"))
    says = F.arrays_overlap(words, F.array(*map(F.lit, sorted({*seeds, *(r.t for r in top)}))))
    if rest is None:
        return pages.select(*[c.alias(k) for k, c in keep.items()], says.alias("says"))
    rows = pages.select(*[c.alias(k) for k, c in keep.items()], says.alias("says"), words.alias("w"))
    rows = stored(rows.withColumn("w", F.when(~F.col("says"), F.col("w"))).withColumn("_row", F.monotonically_increasing_id()), "pages")
    more = rows.select("_row", F.explode("w").alias("t")).join(rest.select("t"), "t").select("_row").distinct().withColumn("_more", F.lit(True))
    return rows.join(more, "_row", "left").select(*keep, (F.col("says") | F.coalesce("_more", F.lit(False))).alias("says"))


def word_model(counted: DataFrame, most: int = 50_000, seeds: tuple[str, ...] = SEEDS) -> tuple[dict[str, float], DataFrame | None, int]:
    """Log probabilities of the ``most`` frequent words of all titles (``title_words``), the counts of all others, and the sum of all counts; seed words have at least the count of a frequent word."""
    top, rest = head_and_rest(counted, most)
    given = list(seeds)
    counts = {r.t: r.n for r in top} | ({r.t: r.n for r in rest.where(F.col("t").isin(given)).collect()} if rest is not None else {})
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    usual = max(1, total // 100)
    for w in given:
        n = max(counts.get(w, 0), usual)
        total += n - counts.get(w, 0)
        counts[w] = n
    model = {w: math.log(n / total) for w, n in counts.items()} | {"": -math.log(total)}
    return model, None if rest is None else rest.where(~F.col("t").isin(given)), total


def unigrams(pages: DataFrame, most: int = 50_000) -> dict[str, float]:
    """The log probabilities of ``word_model``."""
    return word_model(title_words(pages), most)[0]


def attached(rows: DataFrame, keys: DataFrame, table: DataFrame, name: str, salts: int = 16) -> DataFrame:
    """``rows`` (rid, ...) with the list of v that ``table`` (k, v) has for their distinct ``keys`` (rid, k), null without any; the key is salted, as many rows may share one."""
    dealt = table.withColumn("salt", F.explode(F.array(*map(F.lit, range(salts)))))
    found = keys.withColumn("salt", (F.col("rid") % salts).cast("int")).join(dealt, ["k", "salt"])
    return rows.join(found.groupBy("rid").agg(F.collect_list("v").alias(name)), "rid", "left")


def numbered(rows: DataFrame) -> DataFrame:
    return rows if "rid" in rows.columns else stored(rows.withColumn("rid", F.monotonically_increasing_id()), "rows")


def windows(part: str, reach: int = UNKNOWN_WORD) -> list[str]:
    """Pieces of a part; each word of ``reach`` letters at most lies within one."""
    span = max(SPAN, 2 * reach)
    return [part[i : i + span] for i in range(0, len(part), span - reach)]


def with_own_words(rows: DataFrame, rest: DataFrame, common: set[str], longer: tuple[int, ...] = ()) -> DataFrame:
    """``rows`` (host, path, ...), numbered, with the counts of those words of ``rest`` (t, n) that their parts hold, in lists by window."""
    rows = numbered(rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rid, *texts in zip(*(b.column(c).to_pylist() for c in ("rid", "host", "path")), strict=True):
                found = {w for text in texts for part in re.findall(r"[^\W\d_]+", text.lower()) for w in windows(part, max((UNKNOWN_WORD, *longer)))}
                yield pa.RecordBatch.from_arrays([pa.array([rid] * len(found), pa.int64()), pa.array(list(found), pa.string())], names=["rid", "k"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rid, w in zip(b.column("rid").to_pylist(), b.column("window").to_pylist(), strict=True):
                found = {w[i:j] for i in range(len(w)) for j in (*range(i + 1, min(len(w), i + UNKNOWN_WORD) + 1), *(i + n for n in longer if i + n <= len(w)))} - common
                yield pa.RecordBatch.from_arrays([pa.array([rid] * len(found), pa.int64()), pa.array(list(found), pa.string())], names=["rid", "k"])

    keys = rows.select("rid", "host", "path").mapInArrow(cut, "rid long, k string")
    spans = stored(keys.select(F.col("k").alias("window")).distinct().withColumn("rid", F.monotonically_increasing_id()), "windows")
    words = rest.select(F.col("t").alias("k"), F.struct("t", "n").alias("v"))
    held = attached(spans, spans.mapInArrow(pieces, "rid long, k string"), words, "v").where("v is not null")
    return stored(attached(rows, keys, held.select(F.col("window").alias("k"), "v"), "own_words"), "known")


def segment(name: str, model: dict[str, float], own: dict[str, float] = NONE, longer: tuple[int, ...] = ()) -> list[str]:
    """The most probable split of ``name``; a word that ``model`` and ``own`` lack has ``UNKNOWN_WORD`` letters at most and costs ten times more for each letter. ``longer`` has the lengths of longer words that they know."""
    best, cut = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for begin in (*range(max(0, end - UNKNOWN_WORD), end), *(end - n for n in longer if n <= end)):
            w = name[begin:end]
            known = model[w] if w in model else own.get(w)
            if known is None:
                known = model[""] - len(w) * math.log(10) if len(w) <= UNKNOWN_WORD else -math.inf
            if best[begin] + known > best[end]:
                best[end], cut[end] = best[begin] + known, begin
    out, end = [], len(name)
    while end:
        out.append(name[cut[end] : end])
        end = cut[end]
    return out[::-1]


def tokens(host: str, path: str, model: dict[str, float], cache: dict[str, list[str]], own: dict[str, float] = NONE, longer: tuple[int, ...] = ()) -> list[str]:
    """h: words of the host's labels, p: words of the path; numbers are #."""
    out = []
    for mark, text in (("h:", host), ("p:", path.lower())):
        for part in re.findall(r"[^\W\d_]+|\d+", text):
            if part.isdigit():
                out.append(mark + "#")
                continue
            words = cache.get(part)
            if words is None:
                words = segment(part, model, own, longer)
                if len(part) <= SPAN:
                    if len(cache) > 200_000:
                        cache.clear()
                    cache[part] = words
            out += [mark + w for w in words]
    return out


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], most_tokens: int = 50_000, most_words: int = 50_000, seeds: tuple[str, ...] = SEEDS, learn: Column | None = None, most_signs: int = 1000) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page.

    verdict is the longest fitting rule's, else block where naive Bayes finds the blocked class more
    probable, else allow; score is that probability. The blocked class is learned from the URLs of pages whose
    text has a word of ``sign_words``, the other from all others; with ``learn`` only pages that it holds for are
    learned from. Null urls and those without ``://`` have an empty host and path, fit no rule and are judged by
    the prior alone; null pages say nothing. Repeated rows each come back. An empty table gives none. All
    words, tokens and sign words count: the ``most_words``, ``most_tokens`` and ``most_signs`` frequent ones are held by every task, the others are
    joined to the rows that have them.
    """
    counted = title_words(pages)
    model, rest, total = word_model(counted, most_words, seeds)
    longer = long_lengths(counted)
    taught = pages if learn is None else pages.where(learn)
    host, path = url_parts(F.col("url"))
    rows = with_signs(pages, taught, seeds, {"page_id": F.col("page_id"), "host": host, "path": path, "taught": F.lit(True) if learn is None else learn}, most_signs)
    rows = rows.select("page_id", "host", "path", F.when(F.col("taught"), F.col("says")).alias("bad"))
    if rest is not None:
        rows = with_own_words(rows, rest, set(model), longer)

    def token_lists(b: pa.RecordBatch, cache: dict[str, list[str]]) -> list[list[str]]:
        own = b.column("own_words").to_pylist() if "own_words" in b.schema.names else [None] * b.num_rows
        return [tokens(h, p, model, cache, {x["t"]: math.log(x["n"] / total) for v in o for x in v} if o else NONE, longer) for h, p, o in zip(b.column("host").to_pylist(), b.column("path").to_pylist(), own, strict=True)]

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[str]] = {}
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(token_lists(b, cache), pa.list_(pa.string())), b.column("bad")], names=["tokens", "bad"])

    seen = rows.drop("page_id").where("bad is not null").mapInArrow(tokenized, "tokens array<string>, bad boolean")
    rows = rows.drop("bad")
    exploded = seen.select("bad", F.explode(F.concat(F.array(F.lit("")), "tokens")).alias("t"))
    counted = stored(exploded.groupBy("t").agg(F.count_if("bad").alias("b"), F.count_if(~F.col("bad")).alias("a"), F.count("*").alias("n")), "tokens")
    docs_b, docs_a = next(((r.b, r.a) for r in counted.where("t = ''").collect()), (0, 0))
    named = counted.where("t <> ''")
    sum_b, sum_a, kinds = named.agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0)), F.count("*") + 1).first()
    top, rare = head_and_rest(named, most_tokens)

    def log_odds(b: int, a: int) -> float:
        return math.log((b + 1) / (sum_b + kinds)) - math.log((a + 1) / (sum_a + kinds))

    odds = {r.t: log_odds(r.b, r.a) for r in top}
    prior = math.log((docs_b + 1) / (docs_a + 1))

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[str]] = {}
        for b in batches:
            found = [(rid, t) for rid, x in zip(b.column("rid").to_pylist(), token_lists(b, cache), strict=True) for t in {*x} if t not in odds]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())], names=["rid", "k"])

    if rare is not None:
        rows = numbered(rows)
        keys = rows.drop("page_id").mapInArrow(lacking, "rid long, k string")
        rows = attached(rows, keys, rare.select(F.col("t").alias("k"), F.struct("t", "b", "a").alias("v")), "own_tokens")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[str]] = {}
        for b in batches:
            own = b.column("own_tokens").to_pylist() if "own_tokens" in b.schema.names else [None] * b.num_rows
            z = []
            for x, o in zip(token_lists(b, cache), own, strict=True):
                more = {v["t"]: log_odds(v["b"], v["a"]) for v in o} if o else NONE
                z.append(prior + sum(odds[t] if t in odds else more[t] for t in x))
            score = [1 / (1 + math.exp(-max(-700.0, min(700.0, x)))) for x in z]
            yield pa.RecordBatch.from_arrays([b.column("page_id").cast(pa.int64()), b.column("host"), b.column("path"), pa.array(score, pa.float64())], names=["page_id", "host", "path", "score"])

    judged = rows.mapInArrow(scored, "page_id long, host string, path string, score double")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "score")


def agreement(judged: DataFrame, pages: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """One row (pages, said, blocked, both, agree): how the verdicts without a rule agree with what the pages themselves say; for pages that were not learned from."""
    said = with_signs(pages, pages, seeds, {"page_id": F.col("page_id")}).withColumnRenamed("says", "said")
    j = judged.where("rule is null").join(said, "page_id").withColumn("blocked", F.col("verdict") == "block")
    return j.agg(F.count("*").alias("pages"), F.count_if("said").alias("said"), F.count_if("blocked").alias("blocked"), F.count_if(F.col("said") & F.col("blocked")).alias("both"), F.avg((F.col("said") == F.col("blocked")).cast("int")).alias("agree"))


def blocked_share(judged: DataFrame) -> DataFrame:
    """(rule, n, blocked) by rule, a report."""
    return judged.groupBy("rule").agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == "block").alias("blocked")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
