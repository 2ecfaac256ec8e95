"""Predicates on JSON text columns."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parsed(doc: Column, test: Callable[[Column], Column]) -> Column:
    """What ``test`` says of the parsed document, which is parsed once however often the test uses it."""
    return F.get(F.transform(F.array(F.try_parse_json(doc)), test), F.lit(0))


def _member(v: Column, key: str) -> Column:
    return F.try_variant_get(v, "$['" + key.replace("'", "\\'") + "']", "variant")


def _holds_in(literal, x: Column) -> Column:
    return _holds(x, literal)


def _holds(v: Column, literal) -> Column:
    kind = F.schema_of_variant(v)
    if isinstance(literal, dict):
        test = kind.startswith("OBJECT")
        for key, inner in literal.items():
            test = test & F.coalesce(_holds(_member(v, key), inner), F.lit(False))
        return test
    if isinstance(literal, list):
        items = F.try_variant_get(v, "$", "array<variant>")
        test = kind.startswith("ARRAY")
        for inner in literal:
            test = test & F.coalesce(F.exists(items, partial(_holds_in, inner)), F.lit(False))
        return test
    if literal is None:
        return kind == "VOID"
    if isinstance(literal, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == literal)
    if isinstance(literal, str):
        return (kind == "STRING") & (F.try_variant_get(v, "$", "string") == literal)
    number = ~kind.isin("STRING", "BOOLEAN", "VOID") & ~kind.rlike("^(OBJECT|ARRAY)")
    return number & (F.try_variant_get(v, "$", "double") == float(literal))


def json_contains(c, literal: dict | list | str) -> Column:
    """True when the document holds every path of ``literal``; NULL for a NULL document."""
    doc = _col(c)
    wanted = json.loads(literal) if isinstance(literal, str) else literal
    return F.when(doc.isNotNull(), F.coalesce(_parsed(doc, lambda v: _holds(v, wanted)), F.lit(False)))


def json_text(c, key: str) -> Column:
    """Member as text."""
    return F.get_json_object(_col(c), f"$.{key}")


def json_has_key(c, key: str) -> Column:
    """Top-level member exists, or a top-level array holds the string."""
    doc = _col(c)
    holds = lambda x: (F.schema_of_variant(x) == "STRING") & (F.try_variant_get(x, "$", "string") == key)
    in_array = _parsed(
        doc, lambda v: F.when(F.schema_of_variant(v).startswith("ARRAY"), F.exists(F.try_variant_get(v, "$", "array<variant>"), holds))
    )
    in_object = F.array_contains(F.json_object_keys(doc), key)
    return F.when(doc.isNotNull(), F.coalesce(in_array, in_object, F.lit(False)))
