"""JSON schema documents as native conditions on documents.

A schema is compiled once, on the driver, into named rules: conditions on a VARIANT that tell where a document breaks it.
All of them run in one pass over the documents, without Python. Keywords are those of drafts 4 and 6; annotations are
skipped, and a keyword that is not known is an error, so that no rule is silently left out.

As in the drafts, a keyword applies only to values of its kind: ``minLength`` says nothing about a number. A member that
is absent breaks ``required`` alone; the JSON null is a value. Patterns are searched for, as Java regular expressions.
Numbers compare by value, exactly up to 28 digits before the point and 10 after it. Text lengths count characters.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import json as J
from tillstar.operators import quality

Rule = tuple[str, Column]

# JSON type names and the text that Spark gives for the schema of a value of that type.
TYPES = {
    "object": r"^OBJECT<.*",
    "array": r"^ARRAY<.*",
    "string": r"^STRING$",
    "boolean": r"^BOOLEAN$",
    "integer": r"^(BIGINT|DECIMAL\((19|2\d|3\d),0\))$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)$",
    "null": r"^VOID$",
}
# Keywords that describe and do not restrict.
ANNOTATIONS = {"$schema", "$id", "id", "title", "description", "default", "examples", "format", "definitions", "$comment"}


def is_a(v: Column, kind: str) -> Column:
    if kind not in TYPES:
        raise ValueError(f"unknown type {kind!r}")
    return F.coalesce(F.schema_of_variant(v).rlike(TYPES[kind]), F.lit(False))


def _sure(bad: Column) -> Column:
    """A condition that does not apply (NULL) is not broken."""
    return F.coalesce(bad, F.lit(False))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


class Compiler:
    """Rules of one schema document; ``$ref`` looks up definitions of the same document."""

    def __init__(self, schema: Mapping[str, Any] | bool):
        self.root = schema

    def rules(self, v: Column, schema: Mapping[str, Any] | bool, at: str, open_refs: tuple[str, ...] = ()) -> Iterator[Rule]:
        if isinstance(schema, bool):
            if not schema:
                yield f"{at}: false", F.lit(True)
            return
        if not isinstance(schema, Mapping):
            raise ValueError(f"{at}: a schema is an object, not {schema!r}")
        if "$ref" in schema:  # takes the place of all that stands beside it
            ref = schema["$ref"]
            if ref in open_refs:
                raise ValueError(f"{ref} refers to itself; documents of unbounded depth have no single condition")
            yield from self.rules(v, self.definition(ref), at, (*open_refs, ref))
            return
        for keyword, value in schema.items():
            if keyword in ANNOTATIONS:
                continue
            method = getattr(self, f"_{keyword}", None)
            if method is None:
                raise ValueError(f"{at}: unknown keyword {keyword!r}")
            for where, bad in method(v, value, schema, at, open_refs):
                yield where, _sure(bad)

    def definition(self, ref: str) -> Any:
        if not ref.startswith("#"):
            raise ValueError(f"{ref} is outside the schema document")
        found = self.root
        for step in ref[1:].split("/")[1:]:
            found = found[step.replace("~1", "/").replace("~0", "~")]
        return found

    def broken(self, v: Column, schema: Any, refs: tuple[str, ...]) -> Column:
        """Some rule of a schema is broken."""
        return _any([bad for _, bad in self.rules(v, schema, "", refs)])

    # -- any value

    def _type(self, v, value, schema, at, refs):
        kinds = [value] if isinstance(value, str) else value
        yield f"{at}: type", ~_any([is_a(v, k) for k in kinds])

    def _enum(self, v, value, schema, at, refs):
        yield f"{at}: enum", ~J.plain_text(v).isin(*[J.plain_text(J.literal(x)) for x in value])

    def _const(self, v, value, schema, at, refs):
        yield f"{at}: const", J.plain_text(v) != J.plain_text(J.literal(value))

    def _allOf(self, v, value, schema, at, refs):
        for sub in value:
            yield from self.rules(v, sub, at, refs)

    def _anyOf(self, v, value, schema, at, refs):
        yield f"{at}: anyOf", reduce(Column.__and__, [self.broken(v, sub, refs) for sub in value])

    def _oneOf(self, v, value, schema, at, refs):
        good = [F.when(self.broken(v, sub, refs), 0).otherwise(1) for sub in value]
        yield f"{at}: oneOf", reduce(Column.__add__, good) != 1

    def _not(self, v, value, schema, at, refs):
        yield f"{at}: not", ~self.broken(v, value, refs)

    # -- numbers

    def _compared(self, v: Column, bound: Any, compare: Callable[[Column, Column], Column]) -> Column:
        exact = compare(v.try_cast("decimal(38,10)"), F.lit(Decimal(str(bound))).cast("decimal(38,10)"))
        rough = compare(v.try_cast("double"), F.lit(float(bound)))  # beyond the decimal's digits
        return is_a(v, "number") & F.coalesce(exact, rough)

    def _minimum(self, v, value, schema, at, refs):
        strict = schema.get("exclusiveMinimum") is True  # draft 4 has a flag, draft 6 a number
        yield f"{at}: minimum", self._compared(v, value, (lambda a, b: a <= b) if strict else (lambda a, b: a < b))

    def _maximum(self, v, value, schema, at, refs):
        strict = schema.get("exclusiveMaximum") is True
        yield f"{at}: maximum", self._compared(v, value, (lambda a, b: a >= b) if strict else (lambda a, b: a > b))

    def _exclusiveMinimum(self, v, value, schema, at, refs):
        if not isinstance(value, bool):
            yield f"{at}: exclusiveMinimum", self._compared(v, value, lambda a, b: a <= b)

    def _exclusiveMaximum(self, v, value, schema, at, refs):
        if not isinstance(value, bool):
            yield f"{at}: exclusiveMaximum", self._compared(v, value, lambda a, b: a >= b)

    def _multipleOf(self, v, value, schema, at, refs):
        if value <= 0:
            raise ValueError(f"{at}: multipleOf must be above 0")
        yield f"{at}: multipleOf", self._compared(v, value, lambda a, b: a % b != 0)

    # -- text

    def _text(self, v: Column, condition: Callable[[Column], Column]) -> Column:
        return is_a(v, "string") & condition(v.try_cast("string"))

    def _minLength(self, v, value, schema, at, refs):
        yield f"{at}: minLength", self._text(v, lambda t: F.char_length(t) < value)

    def _maxLength(self, v, value, schema, at, refs):
        yield f"{at}: maxLength", self._text(v, lambda t: F.char_length(t) > value)

    def _pattern(self, v, value, schema, at, refs):
        yield f"{at}: pattern", self._text(v, lambda t: ~t.rlike(value))

    # -- arrays

    def _items(self, v, value, schema, at, refs):
        cells = J.as_array(v)
        if not isinstance(value, list):
            yield from self._each(cells, value, f"{at}[*]", refs)
            return
        for i, sub in enumerate(value):
            cell = F.get(cells, F.lit(i))
            for where, bad in self.rules(cell, sub, f"{at}[{i}]", refs):
                yield where, cell.isNotNull() & bad
        rest = schema.get("additionalItems", True)
        if rest is not True:
            yield from self._each(F.slice(cells, len(value) + 1, 1 << 30), rest, f"{at}[{len(value)}..]", refs)

    def _each(self, values: Column, sub: Any, at: str, refs) -> Iterator[Rule]:
        """Rules that every value must keep, each reported once for all values."""
        for where, _ in self.rules(F.lit(None).cast("variant"), sub, at, refs):
            yield where, F.exists(values, self._nth(sub, at, refs, where))

    def _nth(self, sub: Any, at: str, refs, where: str) -> Callable[[Column], Column]:
        return lambda x: _any([bad for name, bad in self.rules(x, sub, at, refs) if name == where])

    def _additionalItems(self, v, value, schema, at, refs):
        return iter(())  # with ``items``

    def _minItems(self, v, value, schema, at, refs):
        yield f"{at}: minItems", F.size(J.as_array(v)) < F.when(J.as_array(v).isNotNull(), value)

    def _maxItems(self, v, value, schema, at, refs):
        yield f"{at}: maxItems", F.size(J.as_array(v)) > value

    def _uniqueItems(self, v, value, schema, at, refs):
        if value:
            texts = F.transform(J.as_array(v), lambda x: F.concat(F.schema_of_variant(x).rlike(TYPES["string"]).cast("string"),
                                                                  J.plain_text(x)))
            yield f"{at}: uniqueItems", F.size(F.array_distinct(texts)) < F.size(texts)

    def _contains(self, v, value, schema, at, refs):
        yield f"{at}: contains", ~F.exists(J.as_array(v), lambda x: ~self.broken(x, value, refs))

    # -- objects

    def _member(self, v: Column, name: str) -> Column:
        if '"' in name or "]" in name or "\\" in name:  # cannot be written in a path
            return F.try_element_at(J.as_object(v), F.lit(name))
        return F.try_variant_get(v, f'$["{name}"]', "variant")

    def _properties(self, v, value, schema, at, refs):
        for name, sub in value.items():
            member = self._member(v, name)
            for where, bad in self.rules(member, sub, f"{at}.{name}", refs):
                yield where, member.isNotNull() & bad

    def _required(self, v, value, schema, at, refs):
        if isinstance(value, bool):
            raise ValueError(f"{at}: required is a list of names")
        for name in value:
            yield f"{at}.{name}: required", is_a(v, "object") & self._member(v, name).isNull()

    def _others(self, v: Column, schema: Mapping[str, Any]) -> Column:
        """The members that neither ``properties`` nor ``patternProperties`` name."""
        names, patterns = list(schema.get("properties", {})), list(schema.get("patternProperties", {}))
        return F.map_filter(J.as_object(v), lambda k, _: ~(
            k.isin(*names) if names else F.lit(False)) & ~_any([k.rlike(p) for p in patterns]))

    def _additionalProperties(self, v, value, schema, at, refs):
        if value is False:
            others = F.map_keys(self._others(v, schema))
            yield f"{at}: additionalProperties", F.exists(others, lambda k: F.lit(True))
        elif value is not True:
            yield from self._each(F.map_values(self._others(v, schema)), value, f"{at}.*", refs)

    def _patternProperties(self, v, value, schema, at, refs):
        for pattern, sub in value.items():
            found = F.map_values(F.map_filter(J.as_object(v), self._matching(pattern)))
            yield from self._each(found, sub, f"{at}./{pattern}/", refs)

    @staticmethod
    def _matching(pattern: str) -> Callable[[Column, Column], Column]:
        return lambda k, _: k.rlike(pattern)

    def _propertyNames(self, v, value, schema, at, refs):
        names = F.transform(F.map_keys(J.as_object(v)), lambda k: k.cast("variant"))
        yield from self._each(names, value, f"{at}: propertyNames", refs)

    def _minProperties(self, v, value, schema, at, refs):
        members = J.as_object(v)
        yield f"{at}: minProperties", members.isNotNull() & (F.size(members) < value)

    def _maxProperties(self, v, value, schema, at, refs):
        members = J.as_object(v)
        yield f"{at}: maxProperties", members.isNotNull() & (F.size(members) > value)

    def _dependencies(self, v, value, schema, at, refs):
        for name, needs in value.items():
            there = self._member(v, name).isNotNull()
            if isinstance(needs, list):
                for need in needs:
                    yield f"{at}.{need}: required with {name}", there & self._member(v, need).isNull()
            else:
                for where, bad in self.rules(v, needs, at, refs):
                    yield f"{where} with {name}", there & bad


def parse(schema: str | Mapping[str, Any] | bool) -> Mapping[str, Any] | bool:
    if isinstance(schema, str):
        try:
            schema = json.loads(schema)
        except ValueError as e:
            raise ValueError(f"the schema is no JSON: {e}") from None
    if not isinstance(schema, (Mapping, bool)):
        raise ValueError("a schema is a JSON object")
    return schema


def rules(schema: str | Mapping[str, Any], v: Column) -> dict[str, Column]:
    """The rules of a schema over a VARIANT column, by name: the path and the keyword. True means broken."""
    schema, out = parse(schema), {}
    for name, bad in Compiler(schema).rules(v, schema, "$"):
        out[name] = out[name] | bad if name in out else bad
    return out


def is_valid(doc: Column | str, schema: str | Mapping[str, Any]) -> Column:
    """The document is JSON and keeps the schema; NULL for a NULL document."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    v = J.parsed(doc)
    return F.when(doc.isNotNull(), v.isNotNull() & ~_any(list(rules(schema, v).values())))


def violations(docs: DataFrame, schema: str | Mapping[str, Any], level: str = "STRICT",
               doc: str = "doc", keep: Sequence[str] = ("_id", "doc")) -> DataFrame:
    """Documents that break the schema, once per broken rule; a text that is no JSON breaks ``$: json``."""
    if level not in ("STRICT", "OFF"):
        raise ValueError(f"level must be STRICT or OFF, not {level!r}")
    v = F.col("_value")
    found = {name: v.isNotNull() & bad for name, bad in rules(schema, v).items()}  # also for OFF: a wrong schema is an error
    found["$: json"] = v.isNull()
    if level == "OFF":
        found = {"$: json": F.lit(False)}
    return quality.row_violations(docs.withColumn("_value", J.parsed(doc)), found, keep)


def require_valid(docs: DataFrame, schema: str | Mapping[str, Any], level: str = "STRICT") -> DataFrame:
    """``docs``, after a check that refuses them all when one breaks the schema (``quality.ConstraintError``)."""
    broken = violations(docs, schema, level)
    counts = broken.groupBy("rule").agg(F.count("*").alias("n")).collect()  # one row a rule
    if counts:
        raise quality.ConstraintError({r["rule"]: r["n"] for r in counts})
    return docs
