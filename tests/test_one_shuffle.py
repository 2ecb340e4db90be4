"""The index is built with one shuffle of its postings."""

import contextlib
import io

from pyspark.sql import functions as F

from lawloom.operators import postings


def test_blocks(spark):
    rows = spark.range(3000).select((F.col("id") % 3 + F.when(F.col("id") < 2000, 0).otherwise(1)).cast("string").alias("g"), F.col("id").cast("string").alias("k"))
    blocks = postings.in_blocks(rows, ["g"], [F.col("k")], 64, ["k"])
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        blocks.explain()
    assert out.getvalue().count("Exchange") == 1
    got = blocks.collect()
    want = {}
    for r in rows.collect():
        want.setdefault(r.g, []).append(r.k)
    for g, keys in want.items():
        assert [m.k for r in sorted((r for r in got if r.g == g), key=lambda r: r.block) for m in r.members] == sorted(keys)
    assert all(r.n == len(r.members) <= 64 for r in got) and len({(r.g, r.block) for r in got}) == len(got)


def test_terms(spark):
    rows = spark.createDataFrame([("a", 4, ["x", "y", "x"], ["x"]), ("b", 1, None, ["y"]), ("c", 0, [], None)], "k string, dl int, f array<string>, g array<string>")
    got = {(r.k, r.dl, r.term): [(p.field, p["at"]) for p in r.places] for r in postings.by_term(rows, "k", ["f", "g"], 2).collect()}
    assert got == {("a", 4, "x"): [(0, 0), (0, 2), (1, 0)], ("a", 4, "y"): [(0, 1)], ("b", 1, "y"): [(1, 0)]}
