"""Every sign word counts, also those beyond the ones that a plan holds."""

from pyspark.sql import functions as F

from lawloom.llm import urls


def test_signs_beyond_the_held_ones(spark):
    rows = [(i, f"http://a{i}.net/", f"casino rare{i % 4}") for i in range(24)] + [(100 + i, "http://b.net/", f"rare{i}") for i in range(4)] + [(200, "http://c.net/", "plain"), (201, None, None), (201, None, None)]
    pages = spark.createDataFrame([(i, u, None if h is None else " ".join(h.translate(str.maketrans("0123", "abcd")).split())) for i, u, h in rows], "page_id long, url string, html string")
    said = lambda most: sorted((r.page_id, r.says) for r in urls.with_signs(pages, pages, ("casino",), {"page_id": F.col("page_id")}, most).collect())
    assert said(1) == said(1000) and [x for x in said(1) if x[0] >= 100] == [(100, True), (101, True), (102, True), (103, True), (200, False), (201, False), (201, False)]
    verdicts = lambda most: sorted((r.page_id, r.verdict, r.score) for r in urls.judge_urls(pages, [], seeds=("casino",), most_signs=most).collect())
    assert verdicts(1) == verdicts(1000)
