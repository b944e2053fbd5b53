"""Collections of JSON documents: frames of ``(_id STRING, doc STRING)`` and transforms over them.

Documents are edited as VARIANT values inside one expression per row. An edited document is printed with its keys in
order; a document no statement touches keeps its text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions import json as J
from tillstar.operators import quality, tables
from tillstar.operators.tables import Predicate

ID, DOC = "_id", "doc"
ID_DIGITS = 28

Edit = Callable[[Column], Column]


# -- adding and replacing whole documents -------------------------------------------------------------------------------


def generated_id(doc: Column, sequence: Column) -> Column:
    """A 28-digit hexadecimal id. The same document and sequence always give the same id, also on a retry."""
    return F.substring(F.sha2(F.concat_ws("|", sequence.cast("string"), doc), 256), 1, ID_DIGITS)


def with_ids(docs: DataFrame, sequence: Column) -> DataFrame:
    """Take ``_id`` from the documents, or generate it where it is missing."""
    own = F.get_json_object(F.col(DOC), "$._id")
    return docs.select(F.coalesce(own, generated_id(F.col(DOC), sequence)).alias(ID), DOC)


def documents(spark, docs: Sequence[Mapping | str], first: int = 0) -> DataFrame:
    """A collection of literal documents, numbered from ``first`` for their generated ids."""
    rows = [(first + i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return with_ids(spark.createDataFrame(rows, f"n bigint, {DOC} string"), F.col("n"))


def add(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Add documents. An id that occurs twice afterwards is reported by ``duplicate_ids``."""
    return existing.unionByName(new.select(ID, DOC))


def duplicate_ids(docs: DataFrame) -> DataFrame:
    return quality.unique(docs, [ID])


def upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Add documents, replacing those of the same id. The ids of ``new`` must be unique (see ``duplicate_ids``)."""
    return existing.join(new.select(ID), ID, "left_anti").unionByName(new.select(ID, DOC))


def upsert_effect(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Per new id the number of affected rows: 1 when it was added, 2 when it replaced one."""
    known = existing.select(ID, F.lit(2).alias("affected"))
    return new.select(ID).join(known, ID, "left").select(ID, F.coalesce("affected", F.lit(1)).alias("affected"))


def _same_id(doc_id: str, doc: Mapping) -> str:
    if ID in doc and doc[ID] != doc_id:
        raise ValueError(f"document has _id {doc[ID]!r}, expected {doc_id!r}")
    return json.dumps({ID: doc_id, **doc})


def add_or_replace_one(existing: DataFrame, doc_id: str, doc: Mapping) -> DataFrame:
    row = [(doc_id, _same_id(doc_id, doc))]
    return upsert(existing, existing.sparkSession.createDataFrame(row, f"{ID} string, {DOC} string"))


def replace_one(existing: DataFrame, doc_id: str, doc: Mapping) -> DataFrame:
    """Replace the document of an id; nothing happens when there is none."""
    text = F.lit(_same_id(doc_id, doc))
    return existing.withColumn(DOC, F.when(F.col(ID) == doc_id, text).otherwise(F.col(DOC)))


def replace_matching(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Replace the documents whose id occurs in ``new``; ids only ``new`` has are ignored."""
    return existing.join(new.select(ID, F.col(DOC).alias("_new")), ID, "left").select(
        ID, F.coalesce("_new", DOC).alias(DOC)
    )


def get_one(docs: DataFrame, doc_id: str) -> DataFrame:
    return docs.filter(F.col(ID) == doc_id)


def remove_one(docs: DataFrame, doc_id: str) -> DataFrame:
    return docs.filter(F.col(ID) != doc_id)


def split_malformed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that are JSON, the others with ``reject_reason``): malformed text or a member named twice."""
    bad = F.try_parse_json(DOC).isNull()
    why = F.when(F.col(DOC).isNull(), "no document").otherwise("malformed document")
    return docs.filter(~bad), docs.filter(bad).withColumn("reject_reason", why)


# -- reading ------------------------------------------------------------------------------------------------------------


def field(path: str, kind: str = "string") -> Column:
    """The value at a path of the current document."""
    return J.get(F.col(DOC), path, kind)


def find(docs: DataFrame, where: Predicate | None = None, **kwargs) -> DataFrame:
    """Documents that meet a condition; takes grouping, order, limit and offset as ``tables.select`` does."""
    return tables.select(docs, *kwargs.pop("columns", ()), where=where, **kwargs)


def fields(docs: DataFrame, **named: Column | str) -> DataFrame:
    """Named values: a path, a (path, type) pair, or any column expression. The document is parsed once."""

    def member(v):
        path, kind = (v, "string") if isinstance(v, str) else v
        return F.try_variant_get("_parsed", J.variant_path(path), kind)

    return docs.withColumn("_parsed", J.parsed(DOC)).select(
        *[(v if isinstance(v, Column) else member(v)).alias(n) for n, v in named.items()]
    )


def project_document(docs: DataFrame, **members: Column) -> DataFrame:
    """New documents built from expressions; a NULL member is kept as JSON null."""
    body = F.struct(*[v.alias(n) for n, v in members.items()])
    return docs.select(ID, F.to_json(body, {"ignoreNullFields": "false"}).alias(DOC))


def as_table(docs: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The documents as columns of a schema."""
    return docs.select(ID, F.from_json(F.col(DOC), schema).alias("_row")).select(ID, "_row.*")


def from_table(df: DataFrame, id_column: str) -> DataFrame:
    """The rows of a table as documents."""
    return df.select(
        F.col(id_column).cast("string").alias(ID),
        F.to_json(F.struct(*[c for c in df.columns]), {"ignoreNullFields": "false"}).alias(DOC),
    )


# -- editing ------------------------------------------------------------------------------------------------------------


def _object(members: Column) -> Column:
    return F.to_variant_object(members)


def _has(members: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(members, key), F.lit(False))


def _put(members: Column, key: str, v: Column) -> Column:
    return _object(F.map_concat(F.map_filter(members, lambda k, _: k != key), F.create_map(F.lit(key), v)))


def _replace_cell(cells: Column, index: int, edit: Edit) -> Column:
    return _object(F.transform(cells, lambda x, i: F.when(i == index, edit(x)).otherwise(x)))


def _at(v: Column, path: list[str | int], edit: Edit) -> Column:
    """Apply ``edit`` to the value at ``path``; a path that leads nowhere leaves the document as it is.

    What is no array is its own cell 0.
    """
    if not path:
        return edit(v)
    step, rest = path[0], path[1:]

    def inner(x: Column) -> Column:
        return _at(x, rest, edit)

    def rebuild(here: Column) -> Column:
        if isinstance(step, int):
            edited = F.when(F.size(here) > step, _replace_cell(here, step, inner))
            return (edited.when(here.isNull(), inner(v)) if step == 0 else edited).otherwise(v)
        return F.when(_has(here, step), _put(here, step, inner(F.try_element_at(here, F.lit(step))))).otherwise(v)

    return J.let(J.as_array(v) if isinstance(step, int) else J.as_object(v), rebuild)


def _path(path: str) -> list[str | int]:
    found = J.steps(path)
    if found and found[0] == ID:
        raise ValueError("the _id of a document cannot be edited")
    if any(s in ("[*]", ".*", "**") for s in found):
        raise ValueError(f"an edit needs a path without wildcards, not {path!r}")
    return found


def _container_edit(path: str, in_object: Callable, in_array: Callable) -> Edit:
    """An edit of the object or array that holds the last step of ``path``."""
    *parent, last = _path(path)

    def leaf(x: Column) -> Column:
        if isinstance(last, int):
            return J.let(J.as_array(x), lambda here: in_array(x, here, last))
        return J.let(J.as_object(x), lambda here: in_object(x, here, last))

    return lambda v: _at(v, parent, leaf)


def set_(path: str, new: Any) -> Edit:
    """Set the value at a path, creating its last member; ``$`` replaces the document."""
    value = J.literal(new)
    if not _path(path):
        return lambda v: value

    def in_array(x: Column, here: Column, index: int) -> Column:
        # what is no array counts as one of a single cell
        single = value if index == 0 else _object(F.array(x, value))
        return (
            F.when(F.size(here) > index, _replace_cell(here, index, lambda _: value))
            .when(here.isNotNull(), _object(F.array_append(here, value)))
            .when(x.isNotNull(), single)
        )

    return _container_edit(
        path, lambda x, here, key: F.when(here.isNotNull(), _put(here, key, value)).otherwise(x), in_array
    )


def change(path: str, new: Any) -> Edit:
    """Replace the value at a path if there is one."""
    value = J.literal(new)
    return lambda v: _at(v, _path(path), lambda _: value)


def unset(*paths: str) -> Edit:
    """Remove the values at the paths; a path that leads nowhere is no error."""
    edits = [
        _container_edit(
            p,
            lambda x, here, key: F.when(
                here.isNotNull(), _object(F.map_filter(here, lambda k, _: k != key))
            ).otherwise(x),
            lambda x, here, index: F.when(
                here.isNotNull(), _object(F.filter(here, lambda _, i: i != index))
            ).otherwise(x),
        )
        for p in paths
    ]

    def edit(v: Column) -> Column:
        for one in edits:
            v = J.let(v, one)
        return v

    return edit


def array_append(path: str, new: Any) -> Edit:
    """Append to the array at a path; a scalar there becomes the first cell."""
    found, value = _path(path), J.literal(new)
    return lambda v: _at(
        v, found, lambda x: _object(F.array_append(F.coalesce(J.as_array(x), F.array(x)), value))
    )


def array_insert(path: str, new: Any) -> Edit:
    """Insert before the cell the path names, counting from 0; past the end it appends."""
    value = J.literal(new)
    if not isinstance(_path(path)[-1], int):
        raise ValueError(f"the path must end in an array index: {path!r}")

    def in_array(x: Column, here: Column, index: int) -> Column:
        spot = F.least(F.lit(index), F.size(here)) + 1
        return F.when(here.isNotNull(), _object(F.array_insert(here, spot, value))).otherwise(x)

    return _container_edit(path, lambda x, here, key: x, in_array)


def patch(changes: Mapping) -> Edit:
    """Merge patch: members are merged recursively, null removes a member."""
    if ID in changes:
        raise ValueError("the _id of a document cannot be edited")

    def merge(v: Column, part: Mapping) -> Column:
        def members(here: Column) -> Column:
            kept = F.map_filter(here, lambda k, _: ~k.isin(list(part))) if part else here
            pairs = []
            for key, sub in part.items():
                if sub is None:
                    continue
                old = F.try_element_at(here, F.lit(key))
                pairs += [F.lit(key), merge(old, sub) if isinstance(sub, Mapping) else J.literal(sub)]
            return _object(F.map_concat(kept, F.create_map(*pairs)) if pairs else kept)

        return J.let(F.coalesce(J.as_object(v), F.create_map().cast(J.OBJECT)), members)

    return lambda v: merge(v, changes)


def modify(docs: DataFrame, where: Predicate, *edits: Edit, order_by: Sequence | None = None,
           limit: int | None = None) -> DataFrame:
    """Apply edits, in order, to the documents that meet the condition (which must not be empty)."""
    marked, hit = tables.mark(docs, where, order_by, limit, [ID], required=True)
    v = J.parsed(DOC)
    for edit in edits:
        v = J.let(v, edit)
    return marked.select(ID, F.when(hit, F.to_json(v)).otherwise(F.col(DOC)).alias(DOC))


def remove(docs: DataFrame, where: Predicate, order_by: Sequence | None = None, limit: int | None = None) -> DataFrame:
    tables.predicate(where, required=True)
    return tables.delete(docs, where, order_by, limit, [ID])


# -- validation -----------------------------------------------------------------------------------------------------------

# JSON type names and the schema text Spark gives a value of that type.
_TYPES = {
    "object": r"^OBJECT<.*",
    "array": r"^ARRAY<.*",
    "string": r"^STRING$",
    "boolean": r"^BOOLEAN$",
    "integer": r"^BIGINT$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)$",
    "null": r"^VOID$",
}


def validate(docs: DataFrame, required: Sequence[str] = (), types: Mapping[str, str] | None = None,
             level: str = "STRICT") -> DataFrame:
    """Documents that lack a required member or hold a value of the wrong type, once per broken rule."""
    if level not in ("STRICT", "OFF"):
        raise ValueError(f"level must be STRICT or OFF, not {level!r}")
    v = J.parsed(DOC)
    rules = {f"required({p})": F.try_variant_get(v, J.variant_path(p), "variant").isNull() for p in required}
    for path, kind in (types or {}).items():
        found = F.schema_of_variant(F.try_variant_get(v, J.variant_path(path), "variant"))
        rules[f"type({path}:{kind})"] = F.coalesce(~found.rlike(_TYPES[kind]), F.lit(False))
    if level == "OFF" or not rules:
        return docs.select(F.lit("").alias("rule"), ID, DOC).filter(F.lit(False))
    return quality.row_violations(docs, rules, [ID, DOC])
