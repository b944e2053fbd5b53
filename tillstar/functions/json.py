"""Expressions over JSON held as VARIANT: paths, wildcards, containment and overlap."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"
ARRAY = "array<variant>"


def parsed(doc: Column | str) -> Column:
    """The document as VARIANT; NULL when the text is no JSON (``documents.split_malformed`` finds such rows)."""
    return F.try_parse_json(F.col(doc) if isinstance(doc, str) else doc)


def literal(value: Any) -> Column:
    """A Python value, or a scalar column, as VARIANT."""
    return value.cast("variant") if isinstance(value, Column) else F.parse_json(F.lit(json.dumps(value)))


def as_object(v: Column) -> Column:
    """The members of a JSON object; NULL when the value is no object."""
    return v.try_cast(OBJECT)


def as_array(v: Column) -> Column:
    return v.try_cast(ARRAY)


def let(v: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``v``, computed once however often the body names it.

    Nested edits name their container several times per level; without the binding the expression would grow
    exponentially with the depth of the path.
    """
    return F.get(F.transform(F.array(v), lambda x: body(x)), F.lit(0))


def is_null(v: Column) -> Column:
    """The value is the JSON null (not: absent)."""
    return F.is_variant_null(v)


def steps(path: str) -> list[str | int]:
    """The steps of a document path: ``$.a.b[0]`` gives ``['a', 'b', 0]``, wildcards stay as text."""
    body = path[1:] if path.startswith("$") else f".{path}"
    found = re.findall(r'\*\*|\[\*\]|\.\*|\[(\d+)\]|\.("(?:[^"]*)"|[^.\[\]"*]+)', body)
    tokens = re.findall(r'\*\*|\[\*\]|\.\*|\[\d+\]|\.(?:"[^"]*"|[^.\[\]"*]+)', body)
    if "".join(tokens) != body:
        raise ValueError(f"bad document path {path!r}")
    out: list[str | int] = []
    for token, (index, name) in zip(tokens, found):
        if index:
            out.append(int(index))
        elif name:
            out.append(name.strip('"'))
        else:
            out.append(token)
    return out


def get(doc: Column | str, path: str, kind: str = "string") -> Column:
    """The value at a path, NULL when it is absent or of another kind."""
    return F.try_variant_get(parsed(doc), variant_path(path), kind)


def variant_path(path: str) -> str:
    """A path without wildcards in Spark's own notation, which quotes every member."""
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else "[" + json.dumps(s, ensure_ascii=False) + "]" for s in steps(path))


def _children(v: Column) -> Column:
    empty = F.array().cast(ARRAY)
    return F.concat(F.coalesce(as_array(v), empty), F.coalesce(F.map_values(as_object(v)), empty))


def _member(step: str | int) -> Callable[[Column], Column]:
    if isinstance(step, int):
        return lambda x: F.get(as_array(x), F.lit(step))
    return lambda x: F.try_element_at(as_object(x), F.lit(step))


def _levels(v: Column) -> Column:
    """Numbers from 1 to the nesting depth of a value: the most brackets that are open at once in its text."""
    # without escaped backslashes and quotes a string ends at the next quote
    text = F.replace(F.replace(F.to_json(v), F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    brackets = F.regexp_replace(F.regexp_replace(text, '"[^"]*"', ""), r"[^\[\]{}]", "")
    none = F.struct(F.lit(0).alias("open"), F.lit(0).alias("most"))

    def step(acc: Column, bracket: Column) -> Column:
        now = acc["open"] + F.when(bracket.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("open"), F.greatest(acc["most"], now).alias("most"))

    depth = F.aggregate(F.filter(F.split(brackets, ""), lambda b: b != ""), none, step, lambda acc: acc["most"])
    return F.sequence(F.lit(1), F.greatest(F.lit(1), depth))


def _descend(start: Column, levels: Column, children: Callable[[Column], Column]) -> Column:
    """``start`` and, level by level down to the last one, what ``children`` gives for the level above.

    There are as many steps as levels, and the levels are kept apart until the end: the work follows the number of values
    times the depth.
    """
    empty = F.array().cast(ARRAY)
    none = F.struct(F.array().cast(f"array<{ARRAY}>").alias("above"), F.coalesce(start, empty).cast(ARRAY).alias("level"))

    def step(acc: Column, _: Column) -> Column:
        below = F.flatten(F.transform(acc["level"], lambda x: F.coalesce(children(x), F.array().cast(ARRAY))))
        above = F.concat(acc["above"], F.array(acc["level"])).cast(f"array<{ARRAY}>")
        return F.struct(above.alias("above"), below.cast(ARRAY).alias("level"))

    return F.aggregate(levels, none, step, lambda acc: F.flatten(F.concat(acc["above"], F.array(acc["level"]))))


def find_all(v: Column, path: str) -> Column:
    """All values a path with wildcards reaches, as ``array<variant>``.

    ``[*]`` steps into every array cell, ``.*`` into every member, ``**`` into every descendant however deep.
    """
    empty = F.array().cast(ARRAY)
    found = F.array(v)
    for step in steps(path):
        if step == "[*]":
            found = F.flatten(F.transform(found, lambda x: F.coalesce(as_array(x), empty)))
        elif step == ".*":
            found = F.flatten(F.transform(found, lambda x: F.coalesce(F.map_values(as_object(x)), empty)))
        elif step == "**":
            found = _descend(found, _levels(v), _children)
        else:
            found = F.transform(found, _member(step))
        found = F.filter(found, lambda x: x.isNotNull())
    return found


_NUMBER = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def is_number(v: Column) -> Column:
    return F.schema_of_variant(v).rlike(_NUMBER)


def plain_text(v: Column) -> Column:
    """JSON text of a value in which equal numbers read alike: 100, 100.0 and 1e2 are ``100``."""
    exact = v.try_cast("decimal(38,10)").cast("string")
    short = F.regexp_replace(F.regexp_replace(exact, r"0+$", ""), r"\.$", "")
    # a number beyond the decimal's digits keeps its text, so it equals only the same text
    fits = v.try_cast("decimal(38,10)").cast("double") == v.try_cast("double")
    return F.when(is_number(v) & F.coalesce(fits, F.lit(False)), short).otherwise(F.to_json(v))


def cells(v: Column) -> Column:
    """The cells of an array, or the scalar itself, as text that compares by value."""
    return F.coalesce(F.transform(as_array(v), plain_text), F.array(plain_text(v)))


def _elements(v: Column) -> Column:
    """The value itself and all elements of it and of the arrays it nests, however deep."""
    return _descend(F.array(v), _levels(v), as_array)


def contains(v: Column, candidate: Any) -> Column:
    """The document contains the candidate.

    A scalar is contained in an equal scalar, numbers by value; an object in an object whose members of the same names
    contain its members; both also in an array that has such an element, itself maybe an array. An array is contained
    in an array when each of its cells is contained in an element.
    """
    if isinstance(candidate, dict):
        def whole(x: Column) -> Column:
            members = as_object(x)
            ok = members.isNotNull()
            for key, sub in candidate.items():
                ok = ok & F.coalesce(contains(F.try_element_at(members, F.lit(key)), sub), F.lit(False))
            return ok

        return F.coalesce(F.exists(_elements(v), whole), F.lit(False))
    if isinstance(candidate, list):
        ok = as_array(v).isNotNull()
        for sub in candidate:
            ok = ok & F.coalesce(F.exists(as_array(v), _containing(sub)), F.lit(False))
        return ok
    wanted = plain_text(literal(candidate))
    return F.coalesce(F.exists(_elements(v), lambda x: plain_text(x) == wanted), F.lit(False))


def _containing(candidate: Any) -> Callable[[Column], Column]:
    return lambda x: contains(x, candidate)


def overlaps(a: Column, b: Column) -> Column:
    """Two arrays share a cell, two objects share a member, a scalar is a cell of the other side; numbers by value."""

    def members(v: Column) -> Column:
        return F.transform(F.map_entries(as_object(v)), lambda e: F.concat(e["key"], F.lit(":"), plain_text(e["value"])))

    both = as_object(a).isNotNull() & as_object(b).isNotNull()
    return F.when(both, F.arrays_overlap(members(a), members(b))).otherwise(F.arrays_overlap(cells(a), cells(b)))
