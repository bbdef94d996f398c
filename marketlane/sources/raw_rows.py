"""One shape for the products of many shops: each shop declares where its fields come from, and what makes a row invalid."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The common shape. A field that a shop doesn't declare is null.
RAW = {
    "source_site": "string",
    "mall_product_id": "string",
    "brand_name_en": "string",
    "product_name": "string",
    "p_name_full": "string",
    "model_id": "string",
    "category_path": "string",
    "original_price": "long",
    "raw_price": "long",
    "stock_status": "string",
    "raw_json_data": "string",
    "product_url": "string",
}
#: Characters of a product's name that are kept.
NAME_LENGTH = 255


@dataclass(frozen=True)
class Field:
    """Where a field comes from; what stands for a missing value; and, by reason, what a value must fulfil."""

    value: Column
    default: object = None
    must: Mapping[str, Column] = None  # type: ignore[assignment]


def number(c: Column) -> Column:
    """A price as shops write it: digits with separators and signs of money around them; null for anything else."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?i)[\s,₩원$]|krw", ""), r"\.[0-9]*$", "")
    return bare.try_cast("long")


def mapped(rows: DataFrame, site: str, fields: Mapping[str, Field]) -> DataFrame:
    """``rows`` in the common shape, and ``reasons``: why a row is invalid, in the order of the fields; empty if it isn't."""
    unknown = set(fields) - set(RAW)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    why = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for f in fields.values() for reason, ok in (f.must or {}).items()]

    def one(name: str, kind: str) -> Column:
        if name == "source_site":
            return F.lit(site)
        if name not in fields:
            return F.lit(None)
        f = fields[name]
        value = F.coalesce(f.value.cast(kind), F.lit(f.default).cast(kind))
        return F.substring(value, 1, NAME_LENGTH) if name == "product_name" else value

    reasons = F.array_compact(F.array(*why)) if why else F.array().cast("array<string>")
    return rows.select(*(one(n, k).cast(k).alias(n) for n, k in RAW.items()), reasons.alias("reasons"))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size("reasons") == 0).drop("reasons")


def rejected(rows: DataFrame) -> DataFrame:
    """source_site, mall_product_id, reason: a row for each reason of each invalid row."""
    return rows.select("source_site", "mall_product_id", F.explode("reasons").alias("reason"))
