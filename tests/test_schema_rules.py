"""Every keyword of the schemas with rows that keep it and rows that break it."""

import json

import pytest

from lawloom.operators import migration, schema_rules, validate


def failures(df, schema):
    return {(r.field, r.rule): r.failures for r in schema_rules.schema_failures(df, schema).collect() if r.failures}


def lines(spark, schema, *rows):
    return spark.read.schema(schema).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows])) if rows else spark.createDataFrame([], schema)


@pytest.mark.parametrize(
    "kind, keyword, good, bad",
    [
        ("string", {"type": "string"}, ["x", "", None], []),
        ("string", {"type": ["string", "null"]}, ["x", None], []),
        ("int", {"type": "string"}, [None], [1]),
        ("int", {"type": "number"}, [1], []),
        ("double", {"type": "integer"}, [2.0, None], [2.5]),
        ("boolean", {"type": ["integer", "null"]}, [None], [True]),
        ("string", {"const": "public"}, ["public", None], ["x"]),
        ("int", {"const": 3}, [3], [4]),
        ("int", {"enum": ["a"]}, [None], [1]),
        ("string", {"enum": ["a", "b", None]}, ["a", "b", None], ["c", ""]),
        ("string", {"pattern": "^[0-9a-f]{4}$"}, ["00ff"], ["00fg", "00ff0"]),
        ("string", {"minLength": 2}, ["가나", "😀😀"], ["가", ""]),
        ("string", {"maxLength": 2}, ["가나", ""], ["가나다"]),
        ("string", {"format": "date"}, ["2024-02-29"], ["2023-02-29", "2024-2-9", "x"]),
        ("string", {"format": "date-time"}, ["2024-02-29T01:02:03Z", "2024-01-01t00:00:00.5+09:00"], ["2024-02-30T01:02:03Z", "2024-01-01", "2024-01-01T25:00:00Z"]),
        ("string", {"format": "other"}, ["anything"], []),
        ("int", {"minimum": 1}, [1, 2, None], [0]),
        ("double", {"maximum": 1}, [1.0], [1.01]),
        ("int", {"exclusiveMinimum": 1}, [2], [1]),
        ("int", {"exclusiveMaximum": 1}, [0], [1]),
        ("array<string>", {"type": "array"}, [[], ["x"]], []),
        ("array<string>", {"minItems": 1}, [["x"], None], [[]]),
        ("array<string>", {"maxItems": 1}, [["x"], []], [["x", "y"]]),
        ("array<string>", {"uniqueItems": True}, [["x", "y"], []], [["x", "x"]]),
        ("struct<a:int,b:int>", {"additionalProperties": False, "properties": {"a": {}}}, [{"a": 1}, None], [{"a": 1, "b": 2}]),
        ("map<string,int>", {"additionalProperties": False, "properties": {"a": {}}}, [{"a": 1}], [{"b": 1}]),
    ],
)
def test_keywords(spark, kind, keyword, good, bad):
    schema, name = {"type": "object", "properties": {"v": keyword}}, next(iter(keyword))
    assert failures(lines(spark, f"v {kind}", *({"v": x} for x in good)), schema) == {}
    want = {("v", name): len(bad)} if bad else {}
    got = failures(lines(spark, f"v {kind}", *({"v": x} for x in [*good, *bad])), schema)
    assert got == want


def test_nested(spark):
    schema = {
        "type": "object", "required": ["id", "maybe", "list"],
        "properties": {"id": {"type": "string"}, "maybe": {"type": ["string", "null"]}, "list": {"type": "array", "items": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 1}, "tags": {"type": "array", "items": {"enum": ["a"]}}}}}, "inner": {"type": "object", "required": ["k"], "properties": {"k": {"pattern": "^x"}}}},
        "additionalProperties": False,
    }
    columns = "id string, maybe string, list array<struct<n:int,tags:array<string>>>, inner struct<k:string>, more string"
    rows = [
        {"id": "1", "list": [{"n": 1, "tags": ["a"]}, {"n": 2}], "inner": {"k": "xy"}}, {"id": "2", "maybe": "m", "list": []},
        {"list": [{"n": 0}, {"tags": ["a", "b"]}], "inner": {"k": "y"}, "more": "z"}, {"id": "4", "inner": {}}, {"id": "5", "list": [None]},
    ]
    df = lines(spark, columns, *rows)
    assert failures(df, schema) == {("id", "required"): 1, ("list", "required"): 1, ("list[].n", "required"): 1, ("list[].n", "minimum"): 1, ("list[].tags[]", "enum"): 1, ("list[]", "type"): 1, ("inner.k", "required"): 1, ("inner.k", "pattern"): 1, ("", "additionalProperties"): 1}
    found = {r.id: r.errors for r in schema_rules.broken_rows(df, schema, "id").collect()}
    assert found.keys() == {None, "4", "5"} and found["5"] == ["list[]: type"] and "additionalProperties" in found[None]
    assert failures(df.drop("list"), schema)[("list", "required")] == 5  # a column that the table lacks
    assert schema_rules.schema_failures(df.limit(0), schema).agg({"failures": "sum"}).first()[0] == 0
    for wrong in ({"properties": {"id": {"oneOf": []}}}, {"allOf": []}):
        with pytest.raises(ValueError):
            schema_rules.schema_failures(df, wrong)


def test_own_tables(spark):
    """The digest pattern, the nested manifest, and a migration map that breaks its schema."""
    one = spark.createDataFrame([("c", 1, 2, 1, 3, ("0" * 64, "x"))], "corpus_id string, documents long, versions long, current_documents long, chunks long, sha256 struct<documents:string,chunks:string>")
    assert failures(one, validate.SCHEMAS["corpus_manifest"]) == {("sha256.chunks", "pattern"): 1}
    columns = "chunk_id string, document_id string, version_id string, text string, section_path string, article_no string"
    old = spark.createDataFrame([("a", "D", "V", "글 하나", None, None), ("b", "D", "V", "다른 글", None, None)], columns)
    mapped = migration.migration_map(old, old)
    assert migration.proven(mapped, old, old).count() == 2
    with pytest.raises(RuntimeError, match="relation: enum"):
        migration.proven(mapped.replace("unchanged", "same", "relation"), old, old)
