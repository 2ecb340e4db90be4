"""Version ids have eight digits of a hash, so versions of different documents may share one."""

import pytest
from pyspark.sql import functions as F
from test_updates import SHA, batch, record, some_documents, some_versions

from lawloom.operators import updates, validate


@pytest.fixture(scope="module")
def applied(spark):
    files = spark.createDataFrame([("f x.hwp", SHA["g"], 10), ("y.hwp", SHA["h"], 5)], "file_name string, actual_sha256 string, actual_size long")
    b = batch(spark, record(), record(document_id="D2", attachment_filename="y.hwp", sha256=SHA["h"], file_size=5, title="을 지침"))
    ok = updates.validate_batch(b.withColumn("version_id", F.lit("VER-20240101-00000000")), some_documents(spark), some_versions(spark), files)
    manifest = spark.createDataFrame([], "archive_file string, sha256 string")
    d, v, _ = updates.apply_batch(ok, some_documents(spark), some_versions(spark), manifest, "2025-02-02")
    return d.cache(), v.cache()


def test_batch_apply_keeps_both(applied):
    got = {(r.document_id, r.sha256): r.previous_version_id for r in applied[1].where("version_id = 'VER-20240101-00000000'").collect()}
    assert got == {("D1", SHA["g"]): "v2", ("D2", SHA["h"]): "v4"}


def test_batch_documents_shows_both(applied):
    assert {r.document_id: r.sha256 for r in applied[0].where("latest_version_id = 'VER-20240101-00000000'").collect()} == {"D1": SHA["g"], "D2": SHA["h"]}


def test_a_shared_head_is_linked_in_its_document_alone(spark):
    files = spark.createDataFrame([("f x.hwp", SHA["g"], 10)], "file_name string, actual_sha256 string, actual_size long")
    shared = some_versions(spark).withColumn("version_id", F.when(F.col("version_id") == "v4", "v2").otherwise(F.col("version_id")))
    ok = updates.validate_batch(batch(spark, record()), some_documents(spark), shared, files)
    _, v, _ = updates.apply_batch(ok, some_documents(spark), shared, spark.createDataFrame([], "archive_file string, sha256 string"), "2025-02-02")
    got = {r.document_id: r.next_version_id for r in v.where("version_id = 'v2'").collect()}
    assert got["D1"].startswith("VER-20240101-") and got["D2"] is None


def test_a_held_hash_is_found_whatever_else_has_the_id(spark):
    files = spark.createDataFrame([("f x.hwp", SHA["g"], 10)], "file_name string, actual_sha256 string, actual_size long")
    for hashes in (("g", "a"), ("a", "g")):
        old = some_versions(spark).where(F.col("version_id").isin("v1", "v4")).withColumns({"sha256": F.when(F.col("version_id") == "v1", SHA[hashes[0]]).otherwise(SHA[hashes[1]]), "version_id": F.lit("VER-20240101-00000000")}).coalesce(1)
        r = updates.validate_batch(batch(spark, record()).withColumn("version_id", F.lit("VER-20240101-00000000")), some_documents(spark), old, files).first()
        assert r.error_code is None and r.already_present


def test_checks_go_by_document(spark):
    rows = [("x", "A", None, "y"), ("y", "A", "x", None), ("w", "B", None, "x"), ("x", "B", "w", None), ("y", "C", None, "x"), ("x", "C", "y", None)]
    v = spark.createDataFrame(rows, "version_id string, document_id string, previous_version_id string, next_version_id string")
    assert validate.asymmetric_links(v).count() == 0 and validate.chain_cycles(v).count() == 0
    bent = v.withColumn("previous_version_id", F.when((F.col("document_id") == "B") & (F.col("version_id") == "x"), "y").otherwise(F.col("previous_version_id")))
    assert {(r.document_id, r.way, r.to) for r in validate.asymmetric_links(bent).collect()} == {("B", "next", "x"), ("B", "previous", "y")}
    round_ = v.withColumn("next_version_id", F.when((F.col("document_id") == "C") & (F.col("version_id") == "x"), "y").otherwise(F.col("next_version_id")))
    assert sorted(r.version_id for r in validate.chain_cycles(round_).collect()) == ["x", "y"]
    across = spark.createDataFrame([("p", "A", "q"), ("q", "B", "p")], "version_id string, document_id string, next_version_id string")
    assert validate.chain_cycles(across).count() == 2
