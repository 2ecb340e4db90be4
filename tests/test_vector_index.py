"""The nearest vectors from folders against a scan."""

import numpy as np
import pytest

from lawloom.operators import search, vector_index


def test_nearest(spark, tmp_path):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((25, 16))
    x = np.vstack([c + 0.15 * rng.standard_normal((80, 16)) for c in centres])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, x[5].tolist()), (9001, (3 * x[5]).tolist()), (9002, None), (9003, []), (9004, [0.0] * 16), (9005, [float("nan")] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    path = f"file://{tmp_path}/v"
    vector_index.write_vectors(df, "vec_id", "embedding", path)
    good = df.where("vec_id < 9002")
    opened = []
    for q, k in [(x[5], 10), (x[700], 100), (rng.standard_normal(16), 3), (x[5], 5000)]:
        got, folders = vector_index.nearest(spark, path, "vec_id", "embedding", q.tolist(), k)
        want = search.cosine_top(good, "vec_id", "embedding", q.tolist(), k)
        assert [(r.vec_id, round(r.cosine, 12)) for r in got.collect()] == [(r.vec_id, round(r.cosine, 12)) for r in want.collect()]
        opened.append(folders)
    assert opened[0] < 10 and opened[3] > 20
    assert vector_index.nearest(spark, path, "vec_id", "embedding", [0.0] * 16, 3)[1] == 0
    with pytest.raises(ValueError):
        vector_index.write_vectors(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"), "vec_id", "embedding", path)
    vector_index.write_vectors(df.limit(0), "vec_id", "embedding", f"{path}-none")
    assert vector_index.nearest(spark, f"{path}-none", "vec_id", "embedding", [1.0], 3)[0].count() == 0
