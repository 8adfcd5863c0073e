"""Conditions on documents of any shape, in the language of watch filters, as Column expressions over VARIANT.

A path leads to values: through objects by name, through arrays by place and into each of their objects. A condition holds if one of the
values meets it, or one element of a value that is an array. Conditions are true or false, never null: values of another type don't meet one, and
what is missing equals null.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)$"
#: Names of types, with what a variant's schema says of them.
TYPES = {"string": "^STRING$", "bool": "^BOOLEAN$", "object": "^OBJECT", "array": "^ARRAY", "null": "^VOID$", "number": NUMERIC, "int": "^(BIGINT|INT)$", "long": "^(BIGINT|INT)$", "double": "^(DECIMAL.*|DOUBLE)$"}
NOTHING = "array<variant>"


def _type(v: Column, name: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).rlike(TYPES[name]), F.lit(False))


def _elements(v: Column) -> Column:
    """The elements of an array; none of anything else."""
    return F.coalesce(F.when(_type(v, "array"), v.cast("array<variant>")), F.array().cast(NOTHING))


def _field(v: Column, name: str) -> Column:
    return F.when(_type(v, "object"), F.try_element_at(v.cast("map<string,variant>"), F.lit(name)))


def _step(v: Column, name: str) -> Column:
    """What a name leads to: a field, a field of each object of an array, a place in an array."""
    found = [F.array(_field(v, name)), F.transform(_elements(v), lambda e: _field(e, name))]
    if name.isdigit():
        found.append(F.array(F.try_element_at(_elements(v), F.lit(int(name) + 1))))
    return F.array_compact(F.concat(*found))


def reached(v: Column, path: Sequence[str]) -> Column:
    """The values that a path leads to from a variant, as an array."""
    values = F.array_compact(F.array(v))
    for name in path:
        values = _next(values, name)
    return values


def _next(values: Column, name: str) -> Column:
    return F.flatten(F.transform(values, lambda v: _step(v, name)))


def _any(values: Column, test: Callable[[Column], Column]) -> Column:
    """Whether a value, or an element of one, meets a test."""
    return F.exists(F.concat(values, F.flatten(F.transform(values, _elements))), lambda v: F.coalesce(test(v), F.lit(False)))


def _compare(want: object, op: Callable[[Column, Column], Column]) -> Callable[[Column], Column]:
    """A comparison with a value of the same type."""
    if isinstance(want, bool):
        return lambda v: _type(v, "bool") & op(F.try_variant_get(v, "$", "boolean"), F.lit(want))
    if isinstance(want, int | float):
        return lambda v: _type(v, "number") & op(F.try_variant_get(v, "$", "double"), F.lit(float(want)))
    if isinstance(want, str):
        return lambda v: _type(v, "string") & op(F.try_variant_get(v, "$", "string"), F.lit(want))
    if isinstance(want, dict | list):
        text = F.to_json(F.parse_json(F.lit(json.dumps(want))))
        return lambda v: op(F.to_json(v), text)
    raise ValueError(f"can't compare with {want!r}")


def _equals(values: Column, want: object) -> Column:
    if want is None:
        return (F.size(values) == 0) | _any(values, lambda v: F.is_variant_null(v))
    return _any(values, _compare(want, lambda a, b: a == b))


def _in(values: Column, wanted: Sequence[object]) -> Column:
    return reduce(lambda a, b: a | b, (_equals(values, w) for w in wanted), F.lit(False))


def _regex(values: Column, pattern: str, options: str = "") -> Column:
    text = f"(?{options}){pattern}" if options else pattern
    return _any(values, lambda v: _type(v, "string") & F.try_variant_get(v, "$", "string").rlike(text))


ORDER: dict[str, Callable[[Column, Column], Column]] = {"$gt": lambda a, b: a > b, "$gte": lambda a, b: a >= b, "$lt": lambda a, b: a < b, "$lte": lambda a, b: a <= b}


def tested(values: Column, spec: object) -> Column:
    """Whether values meet what is asked of a field: a value, or an object of operators."""
    if not (isinstance(spec, dict) and spec and all(k.startswith("$") for k in spec)):
        return _equals(values, spec)
    out = F.lit(True)
    for name, want in spec.items():
        match name:
            case "$eq":
                test = _equals(values, want)
            case "$ne":
                test = ~_equals(values, want)
            case "$in":
                test = _in(values, want)
            case "$nin":
                test = ~_in(values, want)
            case "$gt" | "$gte" | "$lt" | "$lte":
                test = _any(values, _compare(want, ORDER[name]))
            case "$exists":
                test = (F.size(values) > 0) if want else (F.size(values) == 0)
            case "$not":
                test = ~(tested(values, want) if isinstance(want, dict) else _regex(values, want))
            case "$regex":
                test = _regex(values, want, spec.get("$options", ""))
            case "$options":
                continue
            case "$size":
                test = _has_size(values, want)
            case "$all":
                test = reduce(lambda a, b: a & b, (_equals(values, w) for w in want), F.lit(bool(want)))
            case "$elemMatch":
                test = _elem_match(values, want)
            case "$type":
                if want not in TYPES:
                    raise ValueError(f"unknown type {want!r}")
                test = _has_type(values, want)
            case "$mod":
                test = _mod(values, *want)
            case _:
                raise ValueError(f"unknown operator {name!r}")
        out &= test
    return out


def _elem_match(values: Column, spec: dict) -> Column:
    """Whether one element meets all of it: operators on the element itself, or conditions on its fields."""
    plain = all(k.startswith("$") and k not in ("$and", "$or", "$nor") for k in spec)
    one = (lambda e: tested(F.array(e), spec)) if plain else (lambda e: _type(e, "object") & matched(spec, lambda path: reached(e, path)))
    return F.exists(F.flatten(F.transform(values, _elements)), one)


def _has_size(values: Column, n: int) -> Column:
    return F.exists(values, lambda v: _type(v, "array") & (F.size(_elements(v)) == n))


def _has_type(values: Column, name: str) -> Column:
    return _any(values, lambda v: _type(v, name))


def _mod(values: Column, by: int, rest: int) -> Column:
    return _any(values, lambda v: _type(v, "number") & (F.try_variant_get(v, "$", "bigint") % by == rest))


def matched(spec: dict, values_of: Callable[[list[str]], Column]) -> Column:
    """The condition of a $match stage. values_of: an array of the variants that a path leads to."""
    out = F.lit(True)
    for key, want in spec.items():
        if key in ("$and", "$or", "$nor"):
            if not isinstance(want, list) or not want:
                raise ValueError(f"{key} needs a list of conditions")
            parts = [matched(s, values_of) for s in want]
            out &= reduce(lambda a, b: a & b, parts) if key == "$and" else reduce(lambda a, b: a | b, parts) if key == "$or" else ~reduce(lambda a, b: a | b, parts)
        elif key.startswith("$"):
            raise ValueError(f"unknown operator {key!r}")
        else:
            out &= tested(values_of(key.split(".")), want)
    return out


def matches(document: Column, spec: dict) -> Column:
    """Whether a VARIANT document meets the condition of a $match stage; what is no document meets what nothing meets."""
    return matched(spec, lambda path: reached(document, path))
