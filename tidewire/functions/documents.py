"""Documents without a schema: JSON text or VARIANT of any shape and depth, walked document by document.

Built-in functions reach into values whose types are known; what is nested to any depth, and different in each row, is walked by small Arrow functions.
They only take a document apart and put it together again, numbers as they were written: what is done to its values is done by Column expressions.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Nested calls that a walk may take: JSON is read to a depth of 1,000.
DEPTH = 10_000


class Number(str):
    """A number as its text."""


def _constant(name: str) -> Any:
    raise ValueError(f"{name} is no JSON")


def loads(text: str) -> Any:
    """JSON with its numbers as Number."""
    sys.setrecursionlimit(max(DEPTH, sys.getrecursionlimit()))
    return json.loads(text, parse_int=Number, parse_float=Number, parse_constant=_constant)


def dumps(value: Any) -> str:
    """What loads() reads, in compact form."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{dumps(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(dumps, value)) + "]"
    return str(value) if isinstance(value, Number) else json.dumps(value, ensure_ascii=False)


def edited(text: Column, change: Callable[[Any], Any]) -> Column:
    """JSON text with its value changed by a function; null stays."""

    @F.pandas_udf("string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield s.map(lambda x: None if x is None else dumps(change(loads(x))))

    return run(text)


def edited_variant(value: Column, change: Callable[[Any], Any]) -> Column:
    return F.try_parse_json(edited(F.to_json(value), change))


def without(value: Any, paths: Sequence[Sequence[str]]) -> Any:
    """Without these paths; unknown ones and those under plain values are passed over."""
    if not isinstance(value, dict):
        return value
    gone = {p[0] for p in paths if len(p) == 1}
    under = {k: [p[1:] for p in paths if p[0] == k and len(p) > 1] for k in {p[0] for p in paths}}
    return {k: without(v, under[k]) if under.get(k) else v for k, v in value.items() if k not in gone}


def with_prefixes(value: Any, prefix: str, listed: Sequence[str] | None, path: str = "") -> Any:
    """prefix_name for all fields of objects, or for the listed original paths; names with _ first, and what is below them, stay."""
    if not isinstance(value, dict):
        return value
    out = {}
    for k, v in value.items():
        own = f"{path}.{k}" if path else k
        if k.startswith("_"):
            out[k] = v
        else:
            out[f"{prefix}_{k}" if listed is None or own in listed else k] = with_prefixes(v, prefix, listed, own)
    return out


#: Says that a value is left out of its object (in an array it becomes null), and that it stays and is looked into.
GONE, STAYS = object(), object()


def rewritten(value: Any, visit: Callable[[str, Any, bool], Any], path: str = "", keep: frozenset[str] = frozenset()) -> Any:
    """value with everything below it visited in order, containers before what is in them: visit(path, value, whether it is a leaf) gives what stands
    there instead, GONE or STAYS. keep: names of the value itself that aren't visited."""

    def one(own: str, v: Any) -> Any:
        inner = isinstance(v, dict | list)
        new = visit(own, v, not inner)
        return new if new is not STAYS else rewritten(v, visit, own) if inner else v

    if isinstance(value, dict):
        made = ((k, v if k in keep else one(f"{path}.{k}" if path else k, v)) for k, v in value.items())
        return {k: v for k, v in made if v is not GONE}
    if isinstance(value, list):
        return [None if v is GONE else v for v in (one(f"{path}[{k}]", v) for k, v in enumerate(value))]
    return value
