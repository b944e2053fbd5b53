import json
import random

import pytest
from pyspark.sql import functions as F

from tillstar.functions import json as J
from tillstar.operators import documents as D


def collection(spark, *docs):
    return D.documents(spark, docs)


def bodies(docs):
    out = []
    for r in docs.collect():
        body = json.loads(r.doc)
        body.pop("_id", None)
        out.append(body)
    return out


def one(docs):
    (body,) = bodies(docs)
    return body


def test_set_needs_a_true_condition(spark):
    docs = collection(spark, {})
    docs = D.modify(docs, "true", D.set_("a", "first"))
    docs = D.modify(docs, "1 == 1", D.set_("$.b", "second"))
    docs = D.modify(docs, "false", D.set_("c", "Value for c"))
    docs = D.modify(docs, F.lit(None).cast("boolean"), D.set_("d", 1))
    assert one(docs) == {"a": "first", "b": "second"}
    for empty in (None, " "):
        with pytest.raises(ValueError):
            D.modify(docs, empty, D.set_("y", 1))
        with pytest.raises(ValueError):
            D.remove(docs, empty)


def test_set_nested_values_and_cells(spark):
    docs = collection(spark, {"a": {"b": {"c": 1}}, "l": [1, {"x": 1}], "n": None})
    docs = D.modify(
        docs, "true", D.set_("$.a.b.c", {"deep": [1, None]}), D.set_("$.a.b.d", True), D.set_("$.l[1].x", 2.5),
        D.set_("$.l[9]", "end"), D.set_("$.n", "set"), D.set_("$.no.where", 1), D.set_("$.a[0]", 1),
    )
    assert one(docs) == {
        "a": 1, "l": [1, {"x": 2.5}, "end"], "n": "set",  # cell 0 of what is no array is the value itself
    }
    assert one(D.modify(docs, "true", D.set_("$", {"new": 1}))) == {"new": 1}


def test_set_from_a_column(spark):
    docs = collection(spark, {"x": 2})
    docs = D.modify(docs, "true", D.set_("y", D.field("x", "int") * 10))
    assert one(docs) == {"x": 2, "y": 20}


def test_unset(spark):
    docs = collection(spark, {"x": "100", "y": "200", "z": 1}, {"a": "100", "b": "200", "c": 1})
    docs = D.modify(docs, "true", D.unset("$.x"), D.unset("$.y"))
    docs = D.modify(docs, "true", D.unset("$.a", "$.b"))
    assert sorted(bodies(docs), key=str) == [{"c": 1}, {"z": 1}]
    nested = collection(spark, {"a": {"b": 1, "c": [1, 2, 3]}})
    assert one(D.modify(nested, "true", D.unset("$.a.b", "$.a.c[1]", "$.q.r"))) == {"a": {"c": [1, 3]}}


def test_change(spark):
    docs = collection(spark, {"x": 100, "n": None})
    docs = D.modify(docs, "true", D.change("$.x", "99"), D.change("$.y", 1), D.change("$.n", 0))
    assert one(docs) == {"x": "99", "n": 0}


def test_array_append_and_insert(spark):
    docs = D.modify(collection(spark, {"x": [8, 16, 32]}), "true", D.array_append("$.x", "64"))
    assert one(docs) == {"x": [8, 16, 32, "64"]}
    docs = D.modify(collection(spark, {"x": [1, 2]}), "true", D.array_insert("$.x[1]", 43), D.array_insert("$.x[3]", 44))
    assert one(docs) == {"x": [1, 43, 2, 44]}
    assert one(D.modify(collection(spark, {"x": 22}), "true", D.array_insert("$.x[1]", 44))) == {"x": 22}
    assert one(D.modify(collection(spark, {"x": 1}), "true", D.array_append("$.x", 2))) == {"x": [1, 2]}
    with pytest.raises(ValueError):
        D.array_insert("$.x", 1)


def test_merge_patch(spark):
    docs = collection(
        spark,
        {"_id": "1", "name": "Nora", "address": {"zip": "10001", "street": "5 Oak lane"}},
        {"_id": "2", "name": "Omar", "address": {"zip": "70100", "city": "Riverton", "street": "9 Elm road"}},
    )
    docs = D.modify(docs, "_id = '1'", D.patch({"name": "Nina", "address": {"zip": "20002"}}))
    first, second = bodies(docs.orderBy("_id"))
    assert first == {"name": "Nina", "address": {"zip": "20002", "street": "5 Oak lane"}}
    docs = D.modify(docs, "_id = '1'", D.patch({"address": None, "new": {"deep": {"x": None, "y": 1}}}))
    assert bodies(docs.orderBy("_id")) == [{"name": "Nina", "new": {"deep": {"y": 1}}}, second]


def test_patch_of_a_scalar_member(spark):
    assert one(D.modify(collection(spark, {"a": 1}), "true", D.patch({"a": {"b": 2}}))) == {"a": {"b": 2}}


def test_ids_are_protected(spark):
    for edit in (D.set_, D.change):
        with pytest.raises(ValueError):
            D.modify(collection(spark, {}), "true", edit("$._id", 1))
    with pytest.raises(ValueError):
        D.patch({"_id": "x"})
    with pytest.raises(ValueError):
        D.modify(collection(spark, {}), "true", D.unset("$.a[*]"))


def test_ids(spark):
    docs = collection(spark, {"_id": "mine"}, {}, {})
    ids = [r["_id"] for r in docs.collect()]
    assert "mine" in ids and len(set(ids)) == 3
    assert all(len(i) == 28 and int(i, 16) >= 0 for i in ids if i != "mine")
    assert sorted(ids) == sorted(r["_id"] for r in collection(spark, {"_id": "mine"}, {}, {}).collect())
    assert D.add(docs, collection(spark)).count() == 3
    twice = D.duplicate_ids(D.add(docs, collection(spark, {"_id": "mine"})))
    assert [(r["_id"], r.n_rows) for r in twice.collect()] == [("mine", 2)]


def test_add_or_replace(spark):
    docs = collection(spark, {"_id": "id1", "a": 1})
    grown = D.add_or_replace_one(docs, "id2", {"a": 2})
    assert sorted(b["a"] for b in bodies(grown)) == [1, 2]
    assert one(D.add_or_replace_one(docs, "id1", {"_id": "id1", "a": 3})) == {"a": 3}
    effect = D.upsert_effect(docs, collection(spark, {"_id": "id1"}, {"_id": "id2"}))
    assert {r["_id"]: r.affected for r in effect.collect()} == {"id1": 2, "id2": 1}
    with pytest.raises(ValueError):
        D.add_or_replace_one(docs, "id1", {"_id": "other"})
    assert one(D.replace_one(docs, "id1", {"b": 1})) == {"b": 1}
    assert one(D.replace_one(docs, "nobody", {"b": 1})) == {"a": 1}
    assert D.get_one(docs, "id1").count() == 1 and D.remove_one(docs, "id1").count() == 0


def test_find_limit_offset_and_projection(spark):
    docs = collection(spark, *[{"_id": str(i), "g": i} for i in range(4)])
    got = D.find(docs, order_by=["_id"], limit=3, offset=1)
    assert [r["_id"] for r in got.collect()] == ["1", "2", "3"]
    made = D.project_document(D.get_one(docs, "1"), q=F.lit(1) + 1, g2=-20 * D.field("g", "int"))
    assert one(made) == {"q": 2, "g2": -20}
    named = D.fields(docs, key=F.col("_id"), g=("g", "int")).filter("g = 2").collect()
    assert [tuple(r) for r in named] == [("2", 2)]


def test_modify_and_remove_with_limit(spark):
    docs = collection(spark, *[{"_id": str(i), "g": i} for i in range(5)])
    got = D.modify(docs, "true", D.set_("top", True), order_by=[D.field("g", "int").desc()], limit=2)
    assert sorted(r["_id"] for r in got.collect() if "top" in r.doc) == ["3", "4"]
    left = D.remove(docs, "true", [D.field("g", "int")], 2)
    assert sorted(r["_id"] for r in left.collect()) == ["2", "3", "4"]


def test_table_round_trip(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, n string, m double")
    assert [tuple(r) for r in D.as_table(D.from_table(df, "id"), "id INT, n STRING, m DOUBLE").collect()] == [
        ("1", 1, "a", None)
    ]


def test_validate(spark):
    docs = collection(spark, {"_id": "1", "a": 1, "b": "x"}, {"_id": "2", "b": 2}, {"_id": "3", "a": 1.5, "b": None})
    bad = D.validate(docs, ["a"], {"a": "integer", "b": "string"})
    assert sorted((r.rule, r["_id"]) for r in bad.collect()) == [
        ("required(a)", "2"), ("type(a:integer)", "3"), ("type(b:string)", "2"), ("type(b:string)", "3"),
    ]
    assert D.validate(docs, ["a"], level="OFF").count() == 0
    with pytest.raises(ValueError):
        D.validate(docs, level="MAYBE")


def scalar(spark, column):
    return spark.range(1).select(column.alias("c")).first()[0]


def test_overlaps(spark):
    def ov(a, b):
        return scalar(spark, J.overlaps(J.literal(a), J.literal(b)))

    assert [ov([1, 2, 3], x) for x in ([2, 3], [3, 4], [5, 6])] == [True, True, False]
    assert ov(2, [1, 2]) and not ov(5, [1, 2]) and ov(7, 7)
    assert ov({"a": 1, "b": 2}, {"b": 2}) and not ov({"a": 1}, {"a": 2})


def test_contains(spark):
    doc = {"a": 1, "b": [1, "x", {"c": 2}], "d": {"e": None}}

    def has(candidate, of=doc):
        return scalar(spark, J.contains(J.literal(of), candidate))

    assert has({"a": 1}) and not has({"a": 2}) and not has({"z": 1})
    assert has({"b": [1]}) and has({"b": ["x", 1]}) and has({"b": [{"c": 2}]}) and not has({"b": [5]})
    assert has({"d": {"e": None}}) and has(1, [3, 1]) and not has("1", [3, 1])


def test_wildcards(spark):
    doc = {"a": [{"b": 1}, {"b": 2}], "c": {"b": 3, "d": {"b": 4}}}

    def found(path):
        return sorted(json.loads(scalar(spark, F.to_json(F.transform(J.find_all(J.literal(doc), path), lambda x: F.to_json(x))))))

    assert found("$.a[*].b") == ["1", "2"]
    assert found("$.c.*") == ["3", '{"b":4}']
    assert found("$**.b") == ["1", "2", "3", "4"]
    assert found("$.a[1].b") == ["2"] and found("$.no") == []
    with pytest.raises(ValueError):
        J.steps("$.a..b")


# -- random documents against a plain implementation ------------------------------------------------------------------------


def random_value(rnd, depth):
    if depth == 0 or rnd.random() < 0.4:
        return rnd.choice([None, True, 7, -3, 2.5, "x", "", "a b"])
    if rnd.random() < 0.3:
        return [random_value(rnd, depth - 1) for _ in range(rnd.randrange(4))]
    return {k: random_value(rnd, depth - 1) for k in rnd.sample("abcd", rnd.randrange(4))}


def merged(target, patch):
    if not isinstance(patch, dict):
        return patch
    target = dict(target) if isinstance(target, dict) else {}
    for k, v in patch.items():
        if v is None:
            target.pop(k, None)
        else:
            target[k] = merged(target.get(k), v)
    return target


@pytest.mark.parametrize("seed", range(6))
def test_patch_matches_a_plain_merge(spark, seed):
    rnd = random.Random(seed)
    docs = [{k: random_value(rnd, 3) for k in rnd.sample("abcd", 3)} for _ in range(25)]
    patch = {k: random_value(rnd, 3) for k in rnd.sample("abcd", 3)}
    coll = D.documents(spark, [{"_id": str(i), **d} for i, d in enumerate(docs)])
    got = {r["_id"]: json.loads(r.doc) for r in D.modify(coll, "true", D.patch(patch)).collect()}
    assert got == {str(i): {"_id": str(i), **merged(d, patch)} for i, d in enumerate(docs)}


def plain_set(value, path, new, create):
    if not path:
        return new
    step, rest = path[0], path[1:]
    if isinstance(step, int):
        if not isinstance(value, list):  # its own cell 0
            if step == 0:
                return plain_set(value, rest, new, create)
            return [value, new] if create and not rest else value
        if step < len(value):
            return [plain_set(x, rest, new, create) if i == step else x for i, x in enumerate(value)]
        return value + [new] if create and not rest else value
    if not isinstance(value, dict):
        return value
    if step in value:
        return {**value, step: plain_set(value[step], rest, new, create)}
    return {**value, step: new} if create and not rest else value


@pytest.mark.parametrize("path", ["$.a", "$.a.b", "$.b[1]", "$.a.b.c", "$.c[0].a", "$.d[0][1]"])
def test_set_and_change_match_a_plain_edit(spark, path):
    rnd = random.Random(path)
    docs = [{k: random_value(rnd, 4) for k in rnd.sample("abcd", 4)} for _ in range(25)]
    coll = D.documents(spark, [{"_id": str(i), **d} for i, d in enumerate(docs)])
    for edit, create in ((D.set_, True), (D.change, False)):
        got = {r["_id"]: json.loads(r.doc) for r in D.modify(coll, "true", edit(path, {"n": [1]})).collect()}
        want = {str(i): {"_id": str(i), **plain_set(d, J.steps(path), {"n": [1]}, create)} for i, d in enumerate(docs)}
        assert got == want
