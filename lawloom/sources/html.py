"""Records from tables and links of pages; what a page means is data of the caller.

A page becomes rows of cells or a list of links, as tables. A layout says by
expressions over those columns which rows are records and what their fields are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.functions import text

FIELDS = ("source_id", "source_record_id", "document_type", "source_group", "title_raw", "title_normalized", "department", "posted_date", "effective_date", "source_page_url", "attachment_url", "attachment_filename", "attachment_role", "sha256", "retrieved_at")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
LINK = "struct<href:string,label:string,script:string>"
CELL = f"struct<text:string,links:array<{LINK}>,action:string,inputs:map<string,string>>"
#: field (a column name) to an expression: SQL text, or a column. ``where`` chooses the rows.
Layout = dict[str, "str | Column"]


class Node:
    """An element: its tag, attributes, and children, which are elements and texts."""

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def own(self, *tags: str) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node) and c.tag in tags]

    def texts(self) -> Iterator[str]:
        for c in self.children:
            if isinstance(c, Node):
                yield from c.texts()
            else:
                yield c

    def text(self) -> str:
        """All texts with blanks between them, white space collapsed."""
        return " ".join(" ".join(self.texts()).split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def tree(html: str | None) -> Node:
    t = _Tree()
    t.feed(html or "")
    t.close()
    return t.root


def _link(a: Node, page: str) -> dict:
    """href is absolute and null for scripts, which have their text instead."""
    href, script = a.attrs.get("href"), a.attrs.get("onclick") or None
    if href is not None and href.strip().lower().startswith("javascript:"):
        href, script = None, script or href
    return {"href": None if href is None else urljoin(page, href), "label": a.text(), "script": script}


def _cell(cell: Node, page: str) -> dict:
    form = next((f for f in cell.all("form") if "action" in f.attrs), None)
    inputs = {i.attrs.get("name") or i.attrs.get("type", ""): i.attrs.get("value", "") for i in cell.all("input")}
    return {"text": cell.text(), "links": [_link(a, page) for a in cell.all("a")], "action": urljoin(page, form.attrs["action"]) if form else None, "inputs": inputs}


def table_rows(pages: DataFrame) -> DataFrame:
    """(url, caption, ordinal, cells) of every table row of pages (url, html) that has a cell; cells have text, links, and the action and inputs of a form. A null page has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for url, page in zip(pdf["url"], pdf["html"], strict=True):
                n = 0
                for table in tree(page).all("table"):
                    caption = next((c.text() for c in table.own("caption")), None)
                    for row in table.all("tr"):
                        if cells := row.own("td", "th"):
                            out.append((url, caption, n, [_cell(c, url or "") for c in cells]))
                            n += 1
            yield pd.DataFrame(out, columns=["url", "caption", "ordinal", "cells"])

    return pages.select("url", "html").mapInPandas(run, f"url string, caption string, ordinal int, cells array<{CELL}>")


def page_links(pages: DataFrame) -> DataFrame:
    """(url, heading, ordinal, href, label, script) of every link of pages (url, html); heading is the first of h2, else of h1 and h3. A page without links is one row with a null ordinal."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for url, page in zip(pdf["url"], pdf["html"], strict=True):
                root = tree(page)
                heading = next((h.text() for tags in (("h2",), ("h1", "h3")) for h in root.all(*tags) if h.text()), None)
                links = [_link(a, url or "") for a in root.all("a")]
                out += [(url, heading, i, x["href"], x["label"], x["script"]) for i, x in enumerate(links)] or [(url, heading, None, None, None, None)]
            found = pd.DataFrame(out, columns=["url", "heading", "ordinal", "href", "label", "script"])
            yield found.astype({"ordinal": "Int32"})

    return pages.select("url", "html").mapInPandas(run, "url string, heading string, ordinal int, href string, label string, script string")


def _as_column(x: str | Column) -> Column:
    return F.expr(x) if isinstance(x, str) else x


def records(rows: DataFrame, layout: Layout, institution: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The records that a layout finds in ``rows``: all of FIELDS, null where the layout has none, and the columns ``keep``.

    title_normalized and attachment_role follow from title and file name where the layout does not give them.
    """
    given = {k: _as_column(v).cast("string").alias(k) for k, v in layout.items() if k != "where"}
    found = rows.where(_as_column(layout["where"])) if "where" in layout else rows
    out = found.select(*keep, *[given.get(f, F.lit(None).cast("string").alias(f)) for f in FIELDS])
    if "title_normalized" not in given:
        out = out.withColumn("title_normalized", text.record_key(F.col("title_raw"), institution))
    if "attachment_role" not in given:
        out = out.withColumn("attachment_role", text.attachment_role(F.col("attachment_filename")))
    return out


def list_records(pages: DataFrame, layout: Layout, institution: str | None = None) -> DataFrame:
    """The records of list pages (url, html), with the page's url and their place in it as ordinal; a layout's expressions are over ``table_rows``."""
    return records(table_rows(pages), layout, institution, ("url", "ordinal"))


def detail_records(listed: DataFrame, pages: DataFrame, layout: Layout, institution: str | None = None) -> DataFrame:
    """A record for each link that the layout takes on the page (url, html) of a listed record, or the record alone.

    A layout's expressions are over the listed record's fields, which it replaces, and over ``page_links``, whose names
    have ``link_`` before them. Records without a page are left out.
    """
    links = page_links(pages)
    links = links.select(F.col("url").alias("source_page_url"), *[F.col(c).alias(f"link_{c}") for c in links.columns if c != "url"])
    rows = listed.select(*FIELDS).join(links, "source_page_url").withColumn("_taken", F.coalesce(_as_column(layout.get("where", "link_ordinal is not null")), F.lit(False)))
    kept = {f: F.col(f) for f in FIELDS if f not in ("title_normalized", "attachment_role")}
    files = records(rows.where("_taken"), {**kept, **{k: v for k, v in layout.items() if k != "where"}}, institution, ("link_ordinal",))
    bare = rows.groupBy(*FIELDS).agg(F.max("_taken").alias("_any"), F.min("link_ordinal").alias("link_ordinal")).where(~F.col("_any")).select("link_ordinal", *FIELDS)
    return files.unionByName(bare).withColumnRenamed("link_ordinal", "ordinal")


def page_facts(pages: DataFrame, key: str, written: bool = False) -> DataFrame:
    """(key, title, h1, links, first_link) of any page: the title, the first heading, how many links have an address, the first of these.

    With ``written`` also title_written: the title with its character references as they stand in the page.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, h in zip(pdf["k"], pdf["html"], strict=True):
                root = tree(h)
                first = lambda tag: next(("".join(n.texts()) for n in root.all(tag)), None)  # noqa: B023, E731
                links = [a.attrs["href"] for a in root.all("a") if "href" in a.attrs]
                source = re.search(r"<title(?:\s[^>]*)?>(.*?)</title\s*>", h or "", re.S | re.I)
                out.append((k, first("title"), first("h1"), len(links), links[0] if links else None, source and source[1]))
            yield pd.DataFrame(out, columns=["k", "title", "h1", "links", "first_link", "title_written"])

    kind = dict(pages.dtypes)[key]
    return pages.select(F.col(key).alias("k"), "html").mapInPandas(run, f"k {kind}, title string, h1 string, links long, first_link string, title_written string").withColumnRenamed("k", key).drop(*["title_written"] * (not written))
