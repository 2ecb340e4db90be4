"""Main text of web pages by two passes of block rules.

A page is cut into blocks of text. The first pass decides by the share of words
in links, by length and by the share of stop words: long running text is kept,
link lists and what stands in menus, comments and the like goes. Short blocks,
and long ones between the limits, stay open; the second pass gives each the
label of the nearest decided block, one of the same container before others.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from lawloom.llm.scratch import released

# Frequent words without content in four languages.
STOP_WORDS = {
    "en": "a about after all also an and any are as at be been but by can do for from had has have he her his if in into is it its more not of on one or our out she so that the their them there they this to was we were what when which who will with would you",
    "de": "aber als am an auch auf aus bei bis das dass dem den der des die du durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch nur oder sich sie sind über um und von vor war wie wird zu zum zur",
    "fr": "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qui sa se ses son sur un une vous",
    "es": "al como con del el ella entre era es esta este fue ha hay las lo los más mi muy no o para pero por que se sin sobre su sus también una uno y ya",
}
# Elements by what they hold.
RAW = frozenset("script style noscript template iframe object svg math canvas audio video select textarea button datalist title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
BODY_TAGS, APART, ROOTS = frozenset(("article", "main")), frozenset("nav footer aside menu dialog search head".split()), frozenset(("html", "body"))
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"td", "th", "tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Parts of class and id names of what is no main text, of what is, and of names that speak of a page's layout.
APART_NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments commentlist disqus respond replies widget toolbar pagination pager search copyright disclaimer".split())
BODY_NAMES = frozenset("article content entry main post story".split())
LAYOUT_NAMES = frozenset("has with without no page layout wrapper container theme".split())

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'<>]|"[^"<]*"|'[^'<]*')*+|[^>]*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORD = re.compile(r"\w+")
OPEN, GOOD, BAD = 0, 1, -1


@dataclass(frozen=True)
class BlockRules:
    """Limits of the first pass. Blocks under ``short`` words are open; others are good from ``high`` stop words a word on, bad below ``low`` outside of the page's body, and open between; a share of link words over ``links`` is bad."""

    short: int = 10
    low: float = 0.05
    high: float = 0.15
    links: float = 0.5
    stop_words: frozenset[str] = frozenset(" ".join(STOP_WORDS.values()).split())


@dataclass
class Block:
    text: str
    words: int
    stop_share: float
    link_share: float
    apart: bool
    body: int  #: number of the article, main or named container it lies in, 0 for none
    container: int
    heading: bool
    label: int = OPEN


def named(attributes: str, inside: bool) -> tuple[bool, bool]:
    """(apart, body) that an element's class, id, role and style say; ``inside`` a body a header is the article's own."""
    apart = body = False
    for key, value in NAMES.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            apart = True
        elif key == "role":
            apart, body = apart or value.lower() in ROLES, body or value.lower() in BODY_TAGS
        elif key in ("class", "id"):
            for name in value.split():
                parts = {*re.findall(r"[a-z]+", f"{name} {re.sub(r'(?<=[a-z])(?=[A-Z])', '-', name)}".lower())}
                if parts & LAYOUT_NAMES:
                    continue
                apart = apart or bool(parts & APART_NAMES) or "header" in parts and not inside and not parts & BODY_NAMES
                body = body or bool(parts & BODY_NAMES)
    return apart, body and not apart


def page_blocks(page: str, rules: BlockRules) -> list[Block]:
    """The blocks of a page in order, labelled by the first pass."""
    out: list[Block] = []
    stack: list[tuple] = []  # (tag, apart, in a form, body, number, link)
    apart = form = link = False
    body = number = opened = bodies = 0
    pieces: list[tuple[str, bool]] = []
    leaf: tuple = ("html", 0)
    breaks = at = 0

    def flush() -> None:
        if not pieces:
            return
        text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
        if text:
            words = WORD.findall(text.lower())
            linked = sum(len(WORD.findall(html.unescape(p))) for p, is_link in pieces if is_link)
            n = len(words)
            block = Block(text, n, sum(w in rules.stop_words for w in words) / max(1, n), linked / max(1, n), apart or form, body, leaf[1] if leaf[0] in BODY_TAGS or len(stack) < 2 else stack[-2][4], leaf[0][0] == "h" and leaf[0][1:].isdigit())
            if block.apart or block.link_share > rules.links:
                block.label = BAD
            elif not block.heading and n >= rules.short:
                block.label = GOOD if block.stop_share >= rules.high else BAD if block.stop_share < rules.low and not body else OPEN
            out.append(block)
        pieces.clear()

    while at < len(page):
        m = TOKEN.search(page, at)
        if (m.start() if m else len(page)) > at:
            pieces.append((page[at : m.start() if m else len(page)], link))
            breaks = breaks if pieces[-1][0].isspace() else 0
        if not m:
            break
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        closing = bool(m[1])
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "a":
            link = not closing
        elif tag == "br":
            breaks += 1
            pieces.append((" ", False))
            if breaks > 1:
                flush()
        elif tag == "hr":
            flush()
        elif tag in BLOCK and tag not in VOID:
            breaks = 0
            flush()
            if closing:
                if any(s[0] == tag for s in stack):
                    while stack:
                        was = stack.pop()
                        _, apart, form, body, number, link = was
                        if was[0] == tag:
                            break
            else:
                drop = CLOSES.get(tag, frozenset())
                while stack and (stack[-1][0] == "p" or stack[-1][0] in drop):
                    _, apart, form, body, number, link = stack.pop()
                opened += 1
                stack.append((tag, apart, form, body, opened, link))
                if tag not in ROOTS:
                    says_apart, says_body = named(m[3], bool(body)) if m[3] and tag not in BODY_TAGS else (False, False)
                    if tag in BODY_TAGS:
                        says_apart, form = named(m[3], True)[0], False
                    apart = apart or says_apart or tag in APART or tag == "header" and not body
                    form = form or tag == "form"
                    if (tag in BODY_TAGS or says_body) and not body and not apart:
                        bodies += 1
                        body = bodies
            leaf = (stack[-1][0], stack[-1][4]) if stack else ("html", 0)
    flush()
    return out


def inherit(blocks: list[Block]) -> None:
    """Second pass: an open block takes the label of the nearest decided one, of its own container if there is one, else of its body, else of the page.

    Of two at the same distance the good one counts within a container or body, and the bad one elsewhere. A body without any
    decided block is good, and so is a page without any.
    """
    far = len(blocks) + 1

    def nearest(order: range) -> list[list[tuple[int, int]]]:
        found: list[list[tuple[int, int]]] = [[]] * len(blocks)
        last: dict[tuple, tuple[int, int]] = {}
        for i in order:
            b = blocks[i]
            keys = [("c", b.container, b.body), ("b", b.body)] if b.body else [("c", b.container, 0), ("p",)]
            found[i] = [(abs(i - j), label) for j, label in (last.get(k, (i + far, OPEN)) for k in keys)]
            if b.label != OPEN:
                for k in (*keys, ("p",)):
                    last[k] = (i, b.label)
        return found

    before, after = nearest(range(len(blocks))), nearest(range(len(blocks) - 1, -1, -1))
    decided = [b.label for b in blocks]
    any_decided = any(x != OPEN for x in decided)
    for i, b in enumerate(blocks):
        if b.label != OPEN:
            continue
        for level, pair in enumerate(zip(before[i], after[i], strict=True)):
            (d, x), (e, y) = pair
            if x == y == OPEN:
                continue
            b.label = x if d < e else y if e < d else x if x == y else GOOD if b.body or level == 0 else BAD
            break
        else:
            b.label = GOOD if b.body or not any_decided else BAD


def labelled(page: str | None, rules: BlockRules) -> tuple[list[Block], list[int]]:
    """(blocks with their final label, labels of the first pass)."""
    blocks = page_blocks(page or "", rules)
    first = [b.label for b in blocks]
    inherit(blocks)
    return blocks, first


def classified_blocks(pages: DataFrame, rules: BlockRules | None = None) -> DataFrame:
    """(page_id, block, text, words, stop_share, link_share, body, heading, first_label, label) of every block; labels are 1 good, -1 bad, 0 open."""
    rules = rules or BlockRules()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for page_id, page in zip(b.column("page_id").to_pylist(), b.column("html"), strict=True):
                blocks, first = labelled(page.as_py(), rules)
                cols = {"page_id": [page_id] * len(blocks), "block": range(len(blocks)), "first_label": first}
                cols |= {c: [getattr(x, c) for x in blocks] for c in ("text", "words", "stop_share", "link_share", "body", "heading", "label")}
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("block", pa.int32()), ("text", pa.string()), ("words", pa.int32()), ("stop_share", pa.float64()), ("link_share", pa.float64()), ("body", pa.int32()), ("heading", pa.bool_()), ("first_label", pa.int32()), ("label", pa.int32())])
    return pages.select("page_id", "html").mapInArrow(released(run), "page_id long, block int, text string, words int, stop_share double, link_share double, body int, heading boolean, first_label int, label int")


def extract_text(pages: DataFrame, rules: BlockRules | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its good blocks, an empty line between them.

    Character references are decoded, white space within a block is one space. Null and empty pages, and pages
    without a good block, have an empty text. A page is one task's row, whatever its length; time and memory
    are linear in it. Repeated rows each come back, an empty table gives none, other columns are not read.
    """
    rules = rules or BlockRules()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ["\n\n".join(x.text for x in labelled(page.as_py(), rules)[0] if x.label == GOOD) for page in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id").cast(pa.int64()), b.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(released(run), "page_id long, url string, text string, n_chars long")
