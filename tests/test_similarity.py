"""The set-similarity join against all pairs."""

import random

import pytest

from lawloom.operators import similarity

SETS = "part string, id string, items array<string>"


def plain(left, right, least):
    out = set()
    for p, a, x in left:
        for q, b, y in right:
            if p is not None and p == q and x and y:
                score = round(len({*x} & {*y}) / min(len(x), len(y)), 6)
                if score >= least:
                    out.add((a, b, score))
    return out


def test_all_pairs(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]  # some elements are in nearly every set

    def side(mark, n):
        rows = []
        for i in range(n):
            items = list(dict.fromkeys(rng.choices(words, weights, k=rng.randint(1, 60))))
            rows.append((rng.choice("xyz"), f"{mark}{i}", items))
            if i % 5 == 0:
                rows.append((rows[-1][0], f"{mark}{i}s", items[: max(1, len(items) // 3)]))
        return [*rows, (None, f"{mark}-null", ["w1"]), ("x", f"{mark}-none", None), ("x", f"{mark}-empty", [])]

    left, right = side("a", 60), side("b", 60)
    right += [(p, "copy" + a, x) for p, a, x in left[:20]]
    l, r = spark.createDataFrame(left, SETS), spark.createDataFrame(right, SETS)
    for least in (0.15, 0.35, 0.5, 1.0):
        got = [tuple(x) for x in similarity.overlap_join(l, r, least).collect()]
        assert len(got) == len(set(got)) and set(got) == plain(left, right, least)
    assert similarity.overlap_join(l.limit(0), r, 0.5).count() == 0
    with pytest.raises(ValueError):
        similarity.overlap_join(l, r, 0.0)


def test_few_pairs_are_compared(spark):
    """One part of 300 sets a side that share common elements: the pairs compared follow the result, not the square."""
    rng = random.Random(8)
    common = [f"c{i}" for i in range(30)]
    rows = [[*rng.sample(common, 20), *(f"{i}-{j}" for j in range(60))] for i in range(300)]
    left = spark.createDataFrame([("x", f"a{i}", s) for i, s in enumerate(rows)], SETS)
    right = spark.createDataFrame([("x", f"b{i}", s[5:]) for i, s in enumerate(rows)], SETS)
    assert similarity.overlap_join(left, right, 0.35).count() == 300
    assert similarity.candidate_pairs(left, right, 0.35).count() <= 330
