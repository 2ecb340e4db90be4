"""The queries that SQL can express against it, and the stored bytes of media against their digests."""

import hashlib

import duckdb
import pytest

from lawloom.llm import media
from lawloom.llm import queries as q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = q.QUERIES[name](spark, SF)
    want = duck.sql(q.ORACLES[name])
    assert sorted(want.columns) == sorted(df.columns)
    order = [want.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(r[i] for i in order) for r in want.fetchall())


def test_stored_media(spark):
    stored = media.media_table(spark.read.parquet(f"{SF}/documents.parquet"))
    kept = {r.doc_id: bytes(r.media) for r in stored.collect()}
    for r in media.image_features(stored).collect():
        assert (r.media_bytes, r.media_sha256) == (len(kept[r.doc_id]), hashlib.sha256(kept[r.doc_id]).hexdigest())
