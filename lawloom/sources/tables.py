"""Readers of the corpus tables and files."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from urllib.parse import urlparse
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from lawloom.functions.ids import content_digest
from lawloom.functions.rules import extraction_status


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped, a file that is not there is an empty table."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    body = F.regexp_replace("value", "^﻿", "")
    return lines.where(F.trim(body) != "").select(F.from_json(body, schema if isinstance(schema, str) else schema.simpleString()).alias("x")).select("x.*")


def read_json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) without contents."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select("path", "length", F.col("modificationTime").alias("modified")).where(~F.col("path").rlike(r"/(?:\.git|\.venv|__pycache__)/"))


def _office_text(name: str, content: bytes) -> tuple[str | None, str, bool]:
    """(extension, text, failed) of one file: DOCX paragraphs and HWPX texts by their XML, PDF pages where a reader is installed."""
    kind = re.search(r"(\.[^./\\]+)$", name.lower())
    kind = kind[1] if kind else ""
    try:
        if kind == ".docx":
            root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
            ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
            lines = ["".join(t.text or "" for t in p.iter(f"{ns}t")) for p in root.iter(f"{ns}p")]
            return kind, "\n\n".join(x for x in lines if x.strip()), False
        if kind == ".hwpx":
            z = zipfile.ZipFile(io.BytesIO(content))
            parts = sorted(n for n in z.namelist() if re.match(r"Contents/section\d+\.xml$", n, re.I))
            found = [e.text for n in parts for e in ElementTree.fromstring(z.read(n)).iter() if e.tag.endswith("}t") and e.text]
            return kind, "\n".join(found), False
        if kind == ".pdf":
            from pypdf import PdfReader

            pages = [(p.extract_text() or "").strip() for p in PdfReader(io.BytesIO(content)).pages]
            return kind, "\n".join(f"<!-- page: {i} -->\n{t}" for i, t in enumerate(pages, 1) if t), False
    except ModuleNotFoundError:
        return ".none", None, False
    except Exception:  # any damaged file is one result, whatever its reader raises
        return kind, None, True
    return kind, None, False


def extract_office(files: DataFrame) -> DataFrame:
    """(path, text, status) of files (path, content). status is that of ``extraction_status``; PDF files are unsupported where no reader is installed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [_office_text(p, bytes(c)) for p, c in zip(pdf["path"], pdf["content"], strict=True)]
            yield pd.DataFrame({"path": pdf["path"], "kind": [g[0] for g in got], "text": [g[1] for g in got], "failed": [g[2] for g in got]})

    read = files.select("path", "content").mapInPandas(run, "path string, kind string, text string, failed boolean")
    return read.select("path", F.nullif("text", F.lit("")).alias("text"), extraction_status(F.col("kind"), F.col("text"), F.col("failed")).alias("status"))


def read_yaml(path: str) -> dict:
    """One configuration file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def file_digests(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """(path, sha256, length) of all files below a folder, paths relative to ``base`` (the folder itself); pointers to large files have the hash they name."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    root = re.escape(urlparse(base or path).path.rstrip("/"))
    return found.select(F.regexp_replace("path", f"^.*?{root}/", "").alias("path"), content_digest(F.col("content")).alias("sha256"), "length")
