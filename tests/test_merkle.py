"""Tables compared by their trees of digests."""

import random

import pytest
from pyspark.sql import functions as F

from lawloom.operators import merkle


def test_differences(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, f"v{rng.randint(0, 99)}", None if i % 7 == 0 else i / 3) for i in range(3000)] + [(5, "twice", 1.0)] * 2 + [(None, "no key", 0.0)]
    schema, p = "k long, v string, x double", f"file://{tmp_path}"
    a = spark.createDataFrame(rows, schema)
    changed = [r for r in rows if r[0] not in (17, 1200)]  # two removed
    changed = [(r[0], "other", r[2]) if r[0] in (40, 2999) else r for r in changed]  # two changed
    changed.remove((5, "twice", 1.0))  # once instead of twice
    changed += [(9000, "new", None), (None, "no key", 0.5)]
    b = spark.createDataFrame(rng.sample(changed, len(changed)), schema).repartition(5)
    merkle.write_digested(a, "k", f"{p}/a", 12)
    merkle.write_digested(b.select("x", "v", "k"), "k", f"{p}/b", 12)
    merkle.write_digested(a.orderBy(F.desc("v")), "k", f"{p}/c", 12)
    got = sorted(str((r.side, r.k, r.v, r.x)) for r in merkle.differences(spark, f"{p}/a", f"{p}/b").collect())
    old = {r[0]: r for r in rows[:3000]}
    want = [("a", *old[17]), ("a", *old[1200]), ("a", *old[40]), ("a", *old[2999]), ("b", 40, "other", old[40][2]), ("b", 2999, "other", old[2999][2]), ("a", 5, "twice", 1.0), ("b", 9000, "new", None), ("b", None, "no key", 0.5)]
    assert got == sorted(map(str, want))
    leaves = merkle.differing_leaves(spark, f"{p}/a", f"{p}/b")
    assert 1 <= leaves.count() <= 8  # of 3,000 rows in 4,096 leaves those of the differences alone
    chosen = [r.node for r in leaves.collect()]
    assert merkle._rows(spark, f"{p}/a").where(F.col("_leaf").isin(chosen)).count() < 30
    assert merkle.differences(spark, f"{p}/a", f"{p}/c").count() == 0 and merkle.differing_leaves(spark, f"{p}/a", f"{p}/c").count() == 0
    merkle.write_digested(a.limit(0), "k", f"{p}/none", 12)
    assert merkle.differences(spark, f"{p}/none", f"{p}/a").count() == len(rows)
    merkle.write_digested(a, "k", f"{p}/d", 4)
    with pytest.raises(ValueError):
        merkle.differences(spark, f"{p}/a", f"{p}/d")
    with pytest.raises(ValueError):
        merkle.differences(spark, f"{p}/a", f"{p}/nothing")
