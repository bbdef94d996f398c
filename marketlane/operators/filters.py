"""Saved filters: a JSON of groups (any) of conditions (all), compiled to one Column.

The compiled predicate is an ordinary expression, so comparisons on plain columns reach the scan.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.functions import dates

# Operators of each field type, with the number of values they take.
OPERATORS = {
    "number": {"lt": 1, "lte": 1, "eq": 1, "gte": 1, "gt": 1, "between": 2, "isnull": 0, "notnull": 0},
    "date": {"before": 1, "after": 1, "within": 1, "between": 2, "isnull": 0, "notnull": 0},
    "text": {"contains": 1, "ncontains": 1, "eq": 1, "isnull": 0},
    "enum": {"eq": 1, "neq": 1},
    "bool": {"true": 0, "false": 0},
}


@dataclass(frozen=True)
class Field:
    kind: str
    get: Callable[[], Column]


def column(kind: str, name: str) -> Field:
    return Field(kind, lambda: F.col(name))


def per_day(total: str, since: str, as_of: str) -> Field:
    """A total divided by whole days since registration; the total itself on the first day or without a date."""

    def get() -> Column:
        days = dates.whole_days(F.col(since), F.lit(as_of).cast("timestamp_ntz"))
        return F.when(F.coalesce(days, F.lit(0)) == 0, F.col(total).cast("double")).otherwise(F.col(total) / days)

    return Field("number", get)


class FilterError(ValueError):
    pass


def validated(text: str, fields: dict[str, Field]) -> dict:
    """The filter, or an error for unknown fields, operators that the field's type lacks, or empty groups."""
    found = json.loads(text)
    if not isinstance(found, dict) or not isinstance(found.get("groups"), list):
        raise FilterError("groups are missing")
    for group in found["groups"]:
        if not group.get("conditions"):
            raise FilterError("a group has no conditions")
        for c in group["conditions"]:
            if c.get("field") not in fields:
                raise FilterError(f"unknown field: {c.get('field')}")
            if c.get("op") not in OPERATORS[fields[c["field"]].kind]:
                raise FilterError(f"unknown operator: {c.get('op')}")
    return found


def _given(value) -> bool:
    return value is not None and value != ""


def _complete(c: dict, fields: dict[str, Field]) -> bool:
    if c.get("field") not in fields:
        return False
    n = OPERATORS[fields[c["field"]].kind].get(c.get("op"), 1)
    return n == 0 or (_given(c.get("value")) and (n == 1 or _given(c.get("value2"))))


def _number(v: Column, c: dict) -> Column:
    a, b = (F.lit(float(c[k])) if _given(c.get(k)) else None for k in ("value", "value2"))
    return {"lt": lambda: v < a, "lte": lambda: v <= a, "eq": lambda: v == a, "gte": lambda: v >= a, "gt": lambda: v > a, "between": lambda: v.between(a, b)}[c["op"]]()


def _date(v: Column, c: dict, as_of: str) -> Column:
    if c["op"] == "within":
        return v >= F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(int(c["value"])))
    a, b = (dates.any_timestamp(F.lit(str(c[k]))).cast("timestamp_ntz") if _given(c.get(k)) else None for k in ("value", "value2"))
    return {"before": lambda: v < a, "after": lambda: v > a, "between": lambda: v.between(a, b)}[c["op"]]()


def _condition(c: dict, fields: dict[str, Field], as_of: str) -> Column:
    field, op = fields[c["field"]], c["op"]
    v = field.get()
    if field.kind == "enum":
        same = v.eqNullSafe(F.lit(c["value"]))
        return same if op == "eq" else ~same
    if field.kind == "bool":
        return v.eqNullSafe(F.lit(op == "true"))
    if field.kind == "text":
        if op == "isnull":
            return v.isNull() | (v == "")
        low, q = F.lower(v), str(c["value"]).lower()
        return {"contains": lambda: F.coalesce(low.contains(q), F.lit(False)), "ncontains": lambda: F.coalesce(~low.contains(q), F.lit(True)), "eq": lambda: F.coalesce(low == q, F.lit(False))}[op]()
    if op in ("isnull", "notnull"):
        return v.isNull() if op == "isnull" else v.isNotNull()
    return F.coalesce(_number(v, c) if field.kind == "number" else _date(v, c, as_of), F.lit(False))


def compiled(filter_: dict | None, fields: dict[str, Field], as_of: str) -> Column:
    """Incomplete conditions and then empty groups count as absent; nothing left passes every row."""
    groups = [[c for c in g.get("conditions") or [] if _complete(c, fields)] for g in (filter_ or {}).get("groups") or []]
    groups = [[_condition(c, fields, as_of) for c in g] for g in groups if g]
    if not groups:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, g) for g in groups])


def search(df: DataFrame, text: str | None = None, columns: tuple[str, ...] = (), **equal) -> DataFrame:
    """Rows equal in every given column, with the text in one of ``columns``; None clauses don't count."""
    for name, value in equal.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    if text:
        df = df.filter(reduce(lambda a, b: a | b, [F.coalesce(F.lower(c).contains(text.lower()), F.lit(False)) for c in columns]))
    return df


def like(c: Column, text: str, form: str = "contains") -> Column:
    """``LIKE`` for a text as it stands, its % and _ escaped: ``contains``, ``prefix`` or ``suffix``; null is no match."""
    bare = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    pattern = {"contains": f"%{bare}%", "prefix": f"{bare}%", "suffix": f"%{bare}"}[form]
    return F.coalesce(c.like(pattern), F.lit(False))


def path_level(c: Column, level: int, sep: str = "/") -> Column:
    """Does a path have so many parts?"""
    return F.size(F.split(F.coalesce(c, F.lit("")), f"[{sep}]")) == level


def due(at: Column, now: str) -> Column:
    """What has no time yet is due, as is what has come."""
    return at.isNull() | (at <= F.lit(now).cast("timestamp_ntz"))


def in_shard(c: Column, shards: int) -> Column:
    """The shard of a text by its CRC32; null counts as empty."""
    return F.crc32(F.encode(F.coalesce(c, F.lit("")), "UTF-8")) % shards
