"""Sources read page by page through a client that can be replaced."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from email.message import Message
from functools import reduce
from http.client import RemoteDisconnected
from pathlib import PurePosixPath
from typing import Protocol
from urllib.error import HTTPError, URLError
from urllib.parse import unquote, urlparse
from urllib.request import HTTPCookieProcessor, Request, build_opener

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lawloom.sources import html
from lawloom.sources.shared import stored

CHARSETS = ("utf-8", "cp949", "euc-kr")


class Client(Protocol):
    """What a crawl needs; headers are the answer's."""

    def text(self, url: str) -> tuple[str, Message]: ...

    def content(self, url: str, headers: dict[str, str] | None = None) -> tuple[bytes, Message]: ...


def decode(payload: bytes, charset: str | None) -> str:
    """Text in the named charset, else the first of ``CHARSETS`` that fits, else UTF-8 with replacement signs."""
    for name in filter(None, (charset, *CHARSETS)):
        try:
            return payload.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return payload.decode("utf-8", errors="replace")


def answer_name(url: str, disposition: str | None, given: str | None = None) -> str:
    """The file's name: as given, as the answer says, else the address's last part; safe for a file system."""
    said = disposition or ""
    coded, quoted, plain = (re.search(p, said, re.I) for p in (r"filename\*=UTF-8''([^;]+)", r'filename="([^"]+)"', r"filename=([^;]+)"))
    name = given or (unquote(coded[1]) if coded else quoted[1] if quoted else plain[1].strip() if plain else PurePosixPath(urlparse(url).path).name)
    base = PurePosixPath(unquote(name or "download.bin")).name.strip().replace("\x00", "")
    return re.sub(r'[<>:"/\\|?*]', "_", base) or "download.bin"


class HttpClient:
    """Cookies, a pause after each answer, and retries after growing pauses."""

    def __init__(self, user_agent: str, timeout: float = 30, retries: int = 2, pause: float = 0.5, opener=None):
        self.user_agent, self.timeout, self.retries, self.pause = user_agent, timeout, retries, pause
        self.opener = opener or build_opener(HTTPCookieProcessor())

    def content(self, url: str, headers: dict[str, str] | None = None) -> tuple[bytes, Message]:
        for turn in range(self.retries + 1):
            try:
                with self.opener.open(Request(url, headers={"User-Agent": self.user_agent, **(headers or {})}), timeout=self.timeout) as answer:
                    found = answer.read(), answer.headers
                time.sleep(self.pause)
                return found
            except (HTTPError, URLError, TimeoutError, RemoteDisconnected):
                if turn == self.retries:
                    raise
                time.sleep(self.pause * (turn + 1))
        raise AssertionError("not reached")

    def text(self, url: str) -> tuple[str, Message]:
        payload, headers = self.content(url)
        return decode(payload, headers.get_content_charset()), headers


def chosen_sources(config: dict, selected: list[str] | None = None) -> list[dict]:
    """Enabled sources, or the selected ones of them. ValueError for a name that no source has."""
    every = config.get("sources", [])
    unknown = sorted(set(selected or []) - {s["source_id"] for s in every})
    if unknown:
        raise ValueError(f"unknown sources: {', '.join(unknown)}")
    return [s for s in every if s.get("enabled", True) and (not selected or s["source_id"] in selected)]


def fetched(urls: DataFrame, client: Callable[[], Client]) -> DataFrame:
    """(url, html, error) of each different url, read in tasks with a client made there; stored, so that no page is asked for twice."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = client()
        for pdf in batches:
            out = []
            for url in pdf["url"]:
                try:
                    out.append((url, asked.text(url)[0], None))
                except (ValueError, OSError) as e:
                    out.append((url, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["url", "html", "error"])

    return stored(urls.select("url").distinct().mapInPandas(run, "url string, html string, error string"), "fetched")


def crawl_sources(spark: SparkSession, sources: list[dict], client: Callable[[], Client], institution: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, errors) of sources: source_id, ``lists`` (addresses), list layout, detail layout (optional), page key and most pages.

    All sources are read side by side, a round a page number: a source goes on while its page has records that were
    not seen before. Records without a file are followed to their own page. A page that cannot be read, and a
    source without any record, is a row (source_id, error); others go on.
    """
    lists = spark.createDataFrame([(s["source_id"], u) for s in sources for u in s["lists"]], "source_id string, list string")
    found, errors, going = [], [], {s["source_id"] for s in sources}
    for page in range(1, max((s.get("max_pages", 100) for s in sources), default=0) + 1):
        now = [s for s in sources if s["source_id"] in going and page <= s.get("max_pages", 100)]
        if not now:
            break
        key = spark.createDataFrame([(s["source_id"], s.get("page_key")) for s in now], "source_id string, key string")
        mark = F.when(F.col("list").contains("?"), "&").otherwise("?")
        asked = lists.join(F.broadcast(key), "source_id").withColumn("url", F.when(F.col("key").isNull(), F.col("list")).otherwise(F.concat("list", mark, "key", F.lit(f"={page}"))))  # a row a source
        pages = fetched(asked, client)
        errors.append(asked.join(pages.where("error is not null"), "url").select("source_id", "error"))
        own = [html.list_records(pages.join(asked.where(F.col("source_id") == s["source_id"]), "url", "left_semi"), {**s["list_layout"], "source_id": F.lit(s["source_id"])}, institution) for s in now]
        rows = reduce(DataFrame.unionByName, own).withColumn("page", F.lit(page))
        first = F.row_number().over(Window.partitionBy("source_id", "source_record_id").orderBy("url", "ordinal"))
        rows = rows.withColumn("_n", first).where("_n = 1").drop("_n")
        for before in found:
            rows = rows.join(before.select("source_id", "source_record_id"), ["source_id", "source_record_id"], "left_anti")
        rows = stored(rows, "listed")
        found.append(rows)
        going = {r.source_id for r in rows.select("source_id").distinct().collect()} & {s["source_id"] for s in now if s.get("page_key")}
    listed = reduce(DataFrame.unionByName, found) if found else html.list_records(spark.createDataFrame([], "url string, html string"), {}).withColumn("page", F.lit(0))
    follow = listed.where("attachment_url is null and source_page_url is not null")
    detailed = [s for s in sources if s.get("detail_layout")]
    follow = follow.where(F.col("source_id").isin([s["source_id"] for s in detailed]))
    pages = fetched(follow.select(F.col("source_page_url").alias("url")), client)
    errors.append(follow.join(pages.where("error is not null"), follow.source_page_url == pages.url).select("source_id", "error"))
    details = [html.detail_records(follow.where(F.col("source_id") == s["source_id"]), pages.where("error is null"), s["detail_layout"], institution) for s in detailed]
    alone = listed.join(follow.select("source_id", "source_record_id"), ["source_id", "source_record_id"], "left_anti")
    out = reduce(DataFrame.unionByName, [d.select(*html.FIELDS) for d in details], alone.select(*html.FIELDS))
    empty = [s["source_id"] for s in sources]
    none = spark.createDataFrame([(x,) for x in empty], "source_id string").join(listed.select("source_id").distinct(), "source_id", "left_anti").select("source_id", F.lit("no records").alias("error"))
    return out, reduce(DataFrame.unionByName, errors, none)


def download(record: dict, client: Client, save: Callable[[str, bytes], str], given: str | None = None) -> dict:
    """The record with what its file is: hash, size, name, times. ``save`` (folder/name, bytes) says where the file went; a record without a file only gets the time."""
    now = datetime.now(UTC).isoformat()
    if not record.get("attachment_url"):
        return record | {"retrieved_at": now}
    payload, headers = client.content(record["attachment_url"], {"Referer": record["source_page_url"]})
    name = answer_name(record["attachment_url"], headers.get("Content-Disposition"), given)
    place = save(f"{record['source_id']}/{record.get('effective_date') or 'unknown-date'}/{name}", payload)
    return record | {"attachment_filename": record.get("attachment_filename") or PurePosixPath(place).name, "sha256": hashlib.sha256(payload).hexdigest(), "file_size": len(payload), "retrieved_at": now, "http_etag": headers.get("ETag"), "last_modified": headers.get("Last-Modified")}


def download_batch(records: list[dict], client: Client, save: Callable[[str, bytes], str]) -> list[dict]:
    """Files of a batch (sha256, file_size, attachment_url), each checked against its record. RuntimeError that lists every record that failed."""
    done, errors = [], []
    for r in records:
        name = r.get("version_id") or r.get("source_record_id")
        try:
            client.text(r["source_page_url"])
            got = download(r, client, save, r.get("downloaded_filename") or r.get("attachment_filename"))
            if got["sha256"] != r["sha256"]:
                raise ValueError(f"hash {got['sha256']}")
            if got["file_size"] != int(r["file_size"]):
                raise ValueError(f"size {got['file_size']} instead of {r['file_size']}")
            done.append({"version_id": name, "file": got["attachment_filename"], "sha256": got["sha256"], "file_size": got["file_size"], "status": "verified"})
        except (ValueError, OSError, KeyError) as e:
            errors.append(f"{name}: {e}")
    if errors:
        raise RuntimeError("downloads failed:\n- " + "\n- ".join(errors))
    return done
