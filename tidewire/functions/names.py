"""Columns by their exact names, and schemas from what variants say of theirs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def column(name: str) -> Column:
    """The column of this name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def struct_of(variant_schema: str) -> StructType:
    """The struct type behind a variant's schema text; fields that are null throughout are text. Empty for what is no object."""
    if not variant_schema.startswith("OBJECT<"):
        return StructType()
    # Types stand after a colon or in an array; names before one, quoted or not, stay.
    types = {"OBJECT": "STRUCT", "VOID": "STRING"}
    text = re.sub(r"(`(?:[^`]|``)*`)|((?:^|: |ARRAY<))(OBJECT|VOID)\b", lambda m: m[1] or m[2] + types[m[3]], "doc: " + variant_schema)
    return StructType.fromDDL(text)["doc"].dataType
