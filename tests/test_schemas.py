"""Schema documents: every keyword on values that keep and that break it, and whole documents."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tillstar.functions import json as J
from tillstar.operators import quality, schemas

CASES = [
    ({"type": "integer"}, [1, -5, 10 ** 25], ["1", 1.5, None, True, [1], {}]),
    ({"type": ["string", "null"]}, ["", None], [1, False]),
    ({"type": "number"}, [1, 1.5, 1e300], ["1", True]),
    ({"type": "object"}, [{}, {"a": 1}], [[], "x"]),
    ({"type": "array"}, [[], [1]], [{}, None]),
    ({"type": "boolean"}, [True], [1, "true"]),
    ({"minimum": 3}, [3, 3.0, 4, "2", None], [2, 2.999, -1e300]),
    ({"maximum": 3.5}, [3.5, 3, "9", 9007199254740993 - 9007199254740992], [3.51, 1e300]),
    ({"minimum": 9007199254740993}, [9007199254740993], [9007199254740992]),
    ({"minimum": 3, "exclusiveMinimum": True}, [4], [3, 2]),
    ({"maximum": 3, "exclusiveMaximum": False}, [3], [4]),
    ({"exclusiveMinimum": 3, "exclusiveMaximum": 5}, [4, "x"], [3, 5]),
    ({"multipleOf": 0.1}, [0.3, 7, "x"], [0.35]),
    ({"multipleOf": 3}, [0, -9], [4]),
    ({"minLength": 2, "maxLength": 3}, ["éé", "abc", 1], ["", "a", "abcd"]),
    ({"pattern": "^a.c|x"}, ["abcd", "yx", 7], ["ab", ""]),
    ({"enum": ["a", 1, None, [1, 2]]}, ["a", 1, 1.0, None, [1, 2]], ["b", 2, [2, 1], "1"]),
    ({"const": {"a": 1}}, [{"a": 1}], [{"a": 2}, {}, 1]),
    ({"items": {"type": "integer", "minimum": 2}}, [[], [2, 3], "x"], [[2, "a"], [1], [None]]),
    ({"items": [{"type": "integer"}, {"type": "string"}], "additionalItems": False}, [[], [1], [1, "a"]], [["a"], [1, 2], [1, "a", 0]]),
    ({"items": [{}], "additionalItems": {"type": "null"}}, [[1], [1, None]], [[1, 2]]),
    ({"minItems": 1, "maxItems": 2}, [[1], [1, 2], "x", {}], [[], [1, 2, 3]]),
    ({"uniqueItems": True}, [[], [1, "1"], [1, 2]], [[1, 1.0], ["a", "a"]]),
    ({"contains": {"minimum": 5}}, [[1, 7], {}], [[], [1]]),
    ({"properties": {"a": {"properties": {"b": {"maximum": 1}}}}}, [{}, {"a": {"b": 1}}, {"a": 1}, []], [{"a": {"b": 2}}]),
    ({"properties": {"a'\"b": {"type": "string"}}}, [{"a'\"b": "x"}], [{"a'\"b": 1}]),
    ({"required": ["a", "b"]}, [{"a": None, "b": 1}, "x"], [{"a": 1}, {}]),
    ({"properties": {"a": {}}, "additionalProperties": False}, [{}, {"a": 1}, [1]], [{"b": 1}]),
    ({"properties": {"a": {}}, "additionalProperties": {"type": "integer"}}, [{"a": "x", "b": 1}], [{"b": "x"}]),
    ({"patternProperties": {"^n_": {"type": "number"}}, "additionalProperties": False}, [{"n_a": 1}], [{"n_a": "x"}, {"m": 1}]),
    ({"propertyNames": {"maxLength": 2}}, [{"ab": 1}, 5], [{"abc": 1}]),
    ({"minProperties": 1, "maxProperties": 1}, [{"a": 1}, 5], [{}, {"a": 1, "b": 2}]),
    ({"dependencies": {"a": ["b"], "c": {"required": ["d"]}}}, [{}, {"a": 1, "b": 1}, {"c": 1, "d": 1}], [{"a": 1}, {"c": 1}]),
    ({"allOf": [{"minimum": 1}, {"maximum": 2}]}, [1, 2], [0, 3]),
    ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, ["x", 5], [4]),
    ({"oneOf": [{"type": "integer"}, {"minimum": 5}]}, [1, 5.5], [7, 1.5]),
    ({"not": {"type": "string"}}, [1], ["x"]),
    ({"definitions": {"p": {"type": "integer"}}, "properties": {"x": {"$ref": "#/definitions/p"}}}, [{"x": 1}], [{"x": "1"}]),
    ({"$schema": "http://json-schema.org/draft-06/schema#", "title": "t"}, [1, None, {}], []),
    ({"properties": {"a": False}}, [{}], [{"a": 1}]),
]


def test_every_keyword(spark):
    values = [(i, j, ok, json.dumps(v)) for i, (_, good, bad) in enumerate(CASES)
              for ok, group in ((True, good), (False, bad)) for j, v in enumerate(group)]
    df = spark.createDataFrame(values, "i int, j int, ok boolean, doc string")
    wrong = []
    for start in range(0, len(CASES), 8):
        found = F.lit(None).cast("boolean")
        for i in range(start, min(start + 8, len(CASES))):
            found = F.when(F.col("i") == i, schemas.is_valid("doc", CASES[i][0])).otherwise(found)
        some = df.filter(F.col("i").between(start, start + 7)).withColumn("found", found)
        wrong += [(CASES[r.i][0], r.doc, r.ok) for r in some.filter("found <> ok OR found IS NULL").collect()]
    assert wrong == []


GEO = """{"id": "http://json-schema.org/geo", "$schema": "http://json-schema.org/draft-06/schema#", "type": "object",
"description": "a place", "properties": {"latitude": {"type": "number"}, "longitude": {"type": "number"}},
"required": ["latitude", "longitude"]}"""


def test_violations_name_path_and_keyword(spark):
    docs = spark.createDataFrame([("1", '{"latitude": 1, "longitude": 2.5}'), ("2", '{"latitude": "x"}'), ("3", "{"), ("4", "[1]")],
                                 "_id string, doc string")
    got = sorted((r["_id"], r.rule) for r in schemas.violations(docs, GEO).collect())
    assert got == [("2", "$.latitude: type"), ("2", "$.longitude: required"), ("3", "$: json"), ("4", "$: type")]
    assert schemas.violations(docs, GEO, "OFF").collect() == []
    with pytest.raises(quality.ConstraintError) as e:
        schemas.require_valid(docs, GEO)
    assert e.value.report == {"$.latitude: type": 1, "$.longitude: required": 1, "$: json": 1, "$: type": 1}
    good = docs.filter("_id = '1'")
    assert schemas.require_valid(good, GEO).count() == 1 and schemas.require_valid(docs, GEO, "OFF").count() == 4


@pytest.mark.parametrize("schema", [
    "{", "[]", {"minimun": 1}, {"type": "text"}, {"properties": {"a": 5}}, {"multipleOf": 0},
    {"$ref": "elsewhere.json"}, {"definitions": {"n": {"properties": {"n": {"$ref": "#/definitions/n"}}}}, "$ref": "#/definitions/n"}])
def test_wrong_schemas_are_refused(spark, schema):
    docs = spark.createDataFrame([("1", "{}")], "_id string, doc string")
    for level in ("STRICT", "OFF"):
        with pytest.raises(ValueError):
            schemas.violations(docs, schema, level)


def test_descent_follows_the_number_of_values(spark):
    """Four times the members take about four times as long, not sixteen times."""
    def seconds(n):
        doc = json.dumps({f"k{i}": {"a": [i]} for i in range(n)})
        df = spark.createDataFrame([(doc,)], "doc string").select(
            F.size(J.find_all(J.parsed("doc"), "$**.a")), J.contains(J.parsed("doc"), n - 1))
        df.collect()
        best = 9e9
        for _ in range(3):
            start = time.perf_counter()
            assert tuple(df.collect()[0]) == (n, False)
            best = min(best, time.perf_counter() - start)
        return best

    small, large = seconds(2000), seconds(8000)
    assert large < 8 * small + 1
    tricky = json.dumps({"a\\": ["]}", '\\"]', "\\\\"], "b": [[{"c": "{[[["}]]})
    got = spark.createDataFrame([(tricky,)], "doc string").select(F.size(J._levels(J.parsed("doc"))),
                                                                   F.size(J.find_all(J.parsed("doc"), "$**.c")))
    assert tuple(got.collect()[0]) == (4, 1)
    deep = "[" * 300 + "7" + "]" * 300
    got = spark.createDataFrame([(deep,)], "doc string").select(J.contains(J.parsed("doc"), 7)).collect()
    assert got[0][0] is True
