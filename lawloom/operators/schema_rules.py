"""JSON Schema documents as column expressions: every rule of a table's rows in one aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DecimalType, DoubleType, FloatType, IntegralType, MapType, StringType, StructType

#: What a format admits; days and times must be in the calendar too.
FORMATS = {"date": r"^\d{4}-\d{2}-\d{2}$", "date-time": r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"}
#: Keywords that say nothing about rows.
SILENT = frozenset(("$schema", "$id", "title", "description", "examples", "default", "$comment"))
KNOWN = frozenset("type const enum pattern format minLength maxLength minimum maximum exclusiveMinimum exclusiveMaximum items minItems maxItems uniqueItems properties required additionalProperties".split())


@dataclass
class Rule:
    """A keyword at a place, and whether a row breaks it."""

    path: str
    keyword: str
    broken: Column


def _json_type(kind: DataType) -> str:
    if isinstance(kind, IntegralType):
        return "integer"
    for types, name in (((DoubleType, FloatType, DecimalType), "number"), (BooleanType, "boolean"), (ArrayType, "array"), ((StructType, MapType), "object"), (StringType, "string")):
        if isinstance(kind, types):
            return name
    return "string" if kind.typeName() in ("date", "timestamp", "timestamp_ntz") else "null"


def _types(schema: dict) -> list[str]:
    given = schema.get("type", [])
    return [given] if isinstance(given, str) else given


def _wrong_type(schema: dict, kind: DataType, value: Column) -> Column:
    have, may = _json_type(kind), _types(schema)
    if have in may or (have == "integer" and "number" in may) or have == "null":
        return F.lit(False)
    if have == "number" and "integer" in may:
        return value.isNotNull() & (value != F.floor(value))
    return value.isNotNull()


def rules_of(schema: dict, kind: DataType, value: Column, path: str = "") -> list[Rule]:
    """The rules of ``schema`` for a value of this type; a ValueError for a keyword that is not known.

    A null is an absent value: no keyword but ``required`` of its parent speaks of it, and that only where the
    property's type is not ``null`` too. A column of a type that the schema does not allow breaks ``type`` in every
    row that has a value.
    """
    if unknown := schema.keys() - KNOWN - SILENT:
        raise ValueError(f"unknown keywords at {path or 'the root'}: {sorted(unknown)}")
    out: list[Rule] = []
    there = value.isNotNull()

    def add(keyword: str, broken: Column) -> None:
        out.append(Rule(path, keyword, F.coalesce(there & broken, F.lit(False))))

    have = _json_type(kind)
    if "type" in schema:
        add("type", _wrong_type(schema, kind, value))
    for keyword, values in (("const", [schema.get("const")]), ("enum", schema.get("enum", []))):
        if keyword in schema:
            same = [v for v in values if v is not None and not isinstance(v, (list, dict)) and {"string": str, "boolean": bool, "integer": int, "number": (int, float)}.get(have, ()) and isinstance(v, {"string": str, "boolean": bool, "integer": int, "number": (int, float)}[have])]
            add(keyword, ~value.isin(same) if same else F.lit(True))
    if have == "string":
        text = value.cast("string")
        if "pattern" in schema:
            add("pattern", ~text.rlike(schema["pattern"]))
        if "minLength" in schema:
            add("minLength", F.length(text) < schema["minLength"])
        if "maxLength" in schema:
            add("maxLength", F.length(text) > schema["maxLength"])
        if schema.get("format") in FORMATS:
            shape = text.rlike(FORMATS[schema["format"]])
            day = F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
            add("format", ~shape | day.isNull() | (F.lit(False) if schema["format"] == "date" else F.try_to_timestamp(F.upper(text)).isNull()))
    if have in ("integer", "number"):
        for keyword, broken in (("minimum", lambda v: value < v), ("maximum", lambda v: value > v), ("exclusiveMinimum", lambda v: value <= v), ("exclusiveMaximum", lambda v: value >= v)):
            if keyword in schema:
                add(keyword, broken(schema[keyword]))
    if isinstance(kind, ArrayType):
        if "minItems" in schema:
            add("minItems", F.size(value) < schema["minItems"])
        if "maxItems" in schema:
            add("maxItems", F.size(value) > schema["maxItems"])
        if schema.get("uniqueItems"):
            add("uniqueItems", F.size(F.array_distinct(value)) < F.size(value))
        if "items" in schema:
            inner = rules_of(schema["items"], kind.elementType, F.lit(None).cast(kind.elementType), f"{path}[]")
            broken = lambda i: lambda x: rules_of(schema["items"], kind.elementType, x, f"{path}[]")[i].broken
            out += [Rule(rule.path, rule.keyword, F.coalesce(there & F.exists(value, broken(i)), F.lit(False))) for i, rule in enumerate(inner)]
            if "null" not in _types(schema["items"]) and _types(schema["items"]):
                out.append(Rule(f"{path}[]", "type", F.coalesce(there & F.exists(value, lambda x: x.isNull()), F.lit(False))))
    if isinstance(kind, StructType):
        out += _object_rules(schema, kind, lambda name: value[name], there, path)
    if isinstance(kind, MapType):
        for name in schema.get("required", []):
            out.append(Rule(f"{path}.{name}".lstrip("."), "required", F.coalesce(there & value[name].isNull(), F.lit(False))))
        for name, inner in schema.get("properties", {}).items():
            out += rules_of(inner, kind.valueType, value[name], f"{path}.{name}".lstrip("."))
        if schema.get("additionalProperties") is False:
            add("additionalProperties", F.size(F.array_except(F.map_keys(value), F.array(*map(F.lit, schema.get("properties", {}))))) > 0)
    return out


def _object_rules(schema: dict, kind: StructType, field, there: Column, path: str) -> list[Rule]:
    """Rules of an object whose fields are columns or a struct's."""
    out, kinds = [], {f.name: f.dataType for f in kind.fields}
    at = lambda name: f"{path}.{name}".lstrip(".")
    inner = schema.get("properties", {})
    for name in schema.get("required", []):
        if "null" in _types(inner.get(name, {})) and name in kinds:
            continue  # null is a value of it
        out.append(Rule(at(name), "required", there & (field(name).isNull() if name in kinds else F.lit(True))))
    for name, part in inner.items():
        if name in kinds:
            out += rules_of(part, kinds[name], field(name), at(name))
    if schema.get("additionalProperties") is False and (extra := [n for n in kinds if n not in inner]):
        out.append(Rule(path, "additionalProperties", there & F.greatest(F.lit(False), *[field(n).isNotNull() for n in extra])))
    return out


def row_rules(df: DataFrame, schema: dict) -> list[Rule]:
    """The rules of a schema of type object for the rows of a table, whose columns are its properties."""
    if unknown := schema.keys() - KNOWN - SILENT:
        raise ValueError(f"unknown keywords at the root: {sorted(unknown)}")
    return _object_rules(schema, df.schema, lambda name: df[name], F.lit(True), "")


def schema_failures(df: DataFrame, schema: dict) -> DataFrame:
    """(field, rule, failures) of a table: how many rows break each rule, in one pass over it, zeros included."""
    rules = row_rules(df, schema)
    if not rules:
        return df.sparkSession.createDataFrame([], "field string, rule string, failures long")
    counts = df.agg(*[F.count_if(r.broken).alias(f"x{i}") for i, r in enumerate(rules)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(r.path).alias("field"), F.lit(r.keyword).alias("rule"), F.col(f"x{i}").alias("failures")) for i, r in enumerate(rules)])))


def broken_rows(df: DataFrame, schema: dict, key: str) -> DataFrame:
    """(key, errors) of the rows that break a rule, with the rules they break."""
    errors = F.array_compact(F.array(*[F.when(r.broken, F.lit(f"{r.path}: {r.keyword}".removeprefix(": "))) for r in row_rules(df, schema)]))
    return df.select(key, errors.alias("errors")).where(F.size("errors") > 0)
