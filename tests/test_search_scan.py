"""Searches without an index, the cap of each document over all rows, and the forms that both look in."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from test_index_blocks import CHUNK

from lawloom.functions import text
from lawloom.operators import search
from lawloom.plans import queries

EVERY = {"include_history": True, "include_secondary": True}


def tables(spark, rows):
    """(chunk, document, title, department, text) as chunks with their versions and documents."""
    chunks = spark.createDataFrame([(i, d, f"V{i}", t, p, x, "regulation", None, None, "제1조", None, None, "public", None) for i, d, t, p, x in rows], CHUNK)
    versions = spark.createDataFrame([(f"V{i}", n % 3 > 0, "in_force", "confirmed") for n, (i, *_) in enumerate(rows)], "version_id string, is_latest_version boolean, validity_status string, status_confidence string")
    names = sorted({d for _, d, *_ in rows})
    documents = spark.createDataFrame([(d, [f"Other {d}", "Gamma·Alpha"][: n % 3]) for n, d in enumerate(names)], "document_id string, alternative_titles array<string>")
    return chunks, versions, documents


def answer(found):
    return [(r.chunk_id, r.document_id, round(r.score, 9), r["rank"]) for r in found.orderBy("rank").collect()]


def test_cap_over_all_rows(spark, tmp_path):
    """A document with hundreds of the best rows does not keep others out."""
    rows = [(f"a{i:03}", "A", "alpha", None, "alpha") for i in range(300)] + [(f"b{i:03}", f"B{i:03}", "other", None, f"alpha {'long ' * 9}") for i in range(20)]
    held, path = tables(spark, rows), f"file://{tmp_path}/x"
    search.write_index(search.index_rows(*held), path)
    by_index, by_scan = answer(search.search(spark, path, "alpha", EVERY)), answer(search.scan(held, ["alpha"], EVERY)[0])
    assert [r[3] for r in by_index] == [r[3] for r in by_scan] == list(range(1, 11))
    assert [r[0] for r in by_index][:2] == ["a000", "a001"] and len({r[1] for r in by_index}) == 9 and by_index == by_scan
    assert len(answer(search.scan(held, ["alpha"], EVERY, among=100)[0])) == 2  # what the cut leaves
    assert len(answer(search.search(spark, path, None, EVERY))) == 10 == len(answer(search.scan(held, [None], EVERY)[0]))


def test_scan_is_the_index(spark, tmp_path):
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma·beta", "Äther", "ﬁne", "제1조", "Straße", "a", "b"]
    some = lambda k: " ".join(rng.choices(words, k=k))
    rows = [(f"c{i:02}", f"D{rng.randint(0, 6)}", some(2), rng.choice([None, "alpha", "en"]), None if i == 7 else some(rng.randint(1, 30))) for i in range(60)]
    held, path = tables(spark, rows), f"file://{tmp_path}/x"
    search.write_index(search.index_rows(*held), path)
    asked = ["alpha", "beta gamma", "gamma+beta", "fine ather strasse", "제1조", "none such", "···", None]
    for filters, few in ((EVERY, asked), ({}, ["beta gamma"]), ({**EVERY, "title_contains": "a b", "department": "en"}, ["alpha"])):
        found = search.scan(held, few, filters, 7, 2)
        for query, one in zip(few, found, strict=True):
            assert answer(one) == answer(search.search(spark, path, query, filters, 7, 2)), (query, filters)
    one = search.scanned_rows(held, search.scan(held, ["alpha"], EVERY)[0])
    same = search.search(spark, path, "alpha", EVERY)
    cells = lambda found: [tuple(r) for r in search.display(found).collect()]
    assert cells(one) == cells(same) and cells(one)
    for part in ("beta a", "제1"):
        for filters in (EVERY, {}):
            got = sorted(r.chunk_id for r in search.scanned_substring(held, part, filters).collect())
            assert got == sorted(r.chunk_id for r in search.substring_rows(spark, path, part, filters).collect())


def test_forms(spark):
    """The parts of a form, folded one by one, give the form of the whole; the short test for unusual signs is the long one."""
    old = "[^\x00-\x7f·À-ÖØ-Þà-öø-ÿ–—‘’“”•‧・가-힣]"
    signs = [(chr(c),) for c in [*range(0x3100), *range(0xABF0, 0xAC10), *range(0xD790, 0xD7B0), *range(0xF900, 0x10000), 0x10400, 0x1F600]]
    got = spark.createDataFrame(signs, "c string").select("c", F.col("c").rlike(text.UNUSUAL).alias("u")).collect()
    assert all(r.u == bool(re.search(old, r.c)) for r in got)
    rng = random.Random(2)
    some = lambda: "".join(rng.choices(["a", "B", " ", "́", "e", "Σ", "ß", "·", "ᄀ", "ᅡ", "¨", "\n", "가", "ﬁ", "-"], k=rng.randint(0, 8)))
    rows = [(some(), [some() for _ in range(rng.randint(0, 2))], rng.choice([None, some()]), rng.choice([None, some()])) for _ in range(400)]
    df = search.text_forms(spark.createDataFrame(rows, "title string, alternative_titles array<string>, department string, text string"))
    whole = [" ".join([t, " ".join(a), "None" if d is None else d, x or ""]) for t, a, d, x in rows]
    lean = [" ".join([t, " ".join(a), x or ""]) for t, a, _, x in rows]
    for r, w, n in zip(df.collect(), whole, lean, strict=True):
        assert r.search_text == search.query_form(w) and r.compact_text == search.query_form(n).replace(" ", "")


@pytest.mark.parametrize("name", ["search_bm25", "search_history", "search_title_exact"])
def test_whole_queries_against_sql(spark, tmp_path, name):
    """The SQL on a table where one source has the best 300 rows, and many scores are equal as shown."""
    rows = [(i, "license para und " if i < 300 else f"license {'long ' * 30}", "en", "books" if i < 300 else f"s{i}", 9) for i in range(1, 400)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{path}")
    got = sorted(tuple(r) for r in queries.QUERIES[name](spark, f"file://{tmp_path}").collect())
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{path}/*.parquet'")
    assert got == sorted(duck.sql(queries.ORACLES[name]).fetchall())
    assert len(got) == {"search_bm25": 10, "search_history": 10, "search_title_exact": 1}[name]
