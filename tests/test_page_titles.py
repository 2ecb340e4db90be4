"""Titles of pages with character references that are cut or not ``&amp;``."""

from lawloom.sources import html


def test_title_as_written(spark):
    pages = spark.createDataFrame([(1, "<title>a &amp; b&amp</title>"), (2, "<head><TITLE lang='x'>&quot;c&quot;</title >"), (3, "<p>no</p>"), (4, None)], "id int, html string")
    got = {r.id: (r.title, r.title_written) for r in html.page_facts(pages, "id", written=True).collect()}
    assert got == {1: ("a & b&", "a &amp; b&amp"), 2: ('"c"', "&quot;c&quot;"), 3: (None, None), 4: (None, None)}
