"""Options of products as shops nest them, brought to one flat form; and stock status with its fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that are sizes; numbers such as 28, 5.5, 230 and 95호 or 240MM are, too.
SIZE_WORDS = (
    "XXS", "XS", "S", "M", "L", "XL", "XXL", "XXXL", "XXXXL", "2XL", "3XL", "4XL", "5XL",
    "F", "FREE", "FREESIZE", "ONESIZE", "ONE SIZE", "UNI", "UNISEX", "UNISIZE",
)
SIZE_NUMBER = r"^([0-9]{1,3}(\.[0-9])?|[0-9]{2,3}\s?(호|CM|MM|INCH)?)$"
#: What ``by_axes`` reads: items, each with the values of its axes in the order the shop names them.
ITEM = "code string, number long, sold_out boolean, activated boolean, deleted boolean, axes array<struct<axis:string,value:string>>"
#: What both normalisers return.
OPTION = "color string, tag_size string, status string, option_code string"


def is_size(value: Column) -> Column:
    bare = F.trim(F.replace(F.upper(F.trim(value)), F.lit("SIZE")))
    return bare.isin(*SIZE_WORDS) | bare.rlike(SIZE_NUMBER)


def mostly_sizes(values: Column) -> Column:
    """At least half of the values that aren't empty are sizes; no values are none."""
    full = F.filter(values, lambda v: F.coalesce(v, F.lit("")) != "")
    return (F.size(full) > 0) & (2 * F.size(F.filter(full, is_size)) >= F.size(full))


def axis_role(name: Column, values: Column) -> Column:
    """``size`` or ``color``, by what the axis' name says, else by its values: names such as S, C or NONE say little."""
    said = F.upper(F.trim(name))
    size = name.contains("사이즈") | said.contains("SIZE") | (said == "S")
    color = name.contains("색상") | name.contains("컬러") | said.contains("COLOR") | (said == "C")
    return F.when(size, "size").when(color, "color").when(mostly_sizes(values), "size").otherwise("color")


def by_axes(products: DataFrame, key: str, items: str = "items") -> DataFrame:
    """A row for each option of products with nested items (``ITEM``): key, and ``OPTION`` by the roles of a product's axes.

    Where two axes get one role, the first is the size if its values are sizes and the second's aren't, and the colour
    otherwise. An axis that a product lacks is FREE. Stock is what ``sold_out`` says; where it is null, what is active and
    not deleted counts as there. A missing code is the item's number. Roles are found once a product, from all its items.
    """
    name = lambda x: F.coalesce(x["axis"], F.lit(""))
    read = products.select(key, F.col(items).alias("items"), F.flatten(F.transform(items, lambda i: F.coalesce(i["axes"], F.array()))).alias("values"))
    of = lambda a: F.transform(F.filter("values", lambda x: name(x) == a), lambda x: x["value"])
    judge = lambda a: F.struct(a.alias("axis"), axis_role(a, of(a)).alias("role"), mostly_sizes(of(a)).alias("sizes"))
    judged = read.select(key, "items", F.transform(F.array_distinct(F.transform("values", name)), judge).alias("judged"))
    first, second = F.get("judged", F.lit(0)), F.get("judged", F.lit(1))
    clash = (F.size("judged") == 2) & (first["role"] == second["role"])
    size_first = first["sizes"] & ~second["sizes"]
    sizes = F.when(clash, F.array(F.when(size_first, first["axis"]).otherwise(second["axis"])))
    sizes = sizes.otherwise(F.transform(F.filter("judged", lambda j: j["role"] == "size"), lambda j: j["axis"]))
    each = judged.select(key, sizes.alias("sizes"), "items").select(key, "sizes", F.explode("items").alias("i"))

    axes = F.coalesce("i.axes", F.array())
    last = lambda on: F.element_at(F.concat(F.array(F.lit("")), F.transform(on, lambda x: F.coalesce(x["value"], F.lit("")))), -1)
    free = lambda v: F.coalesce(F.nullif(v, F.lit("")), F.lit("FREE"))
    there = F.coalesce(~F.col("i.sold_out"), F.coalesce("i.activated", F.lit(False)) & ~F.coalesce("i.deleted", F.lit(False)))
    return each.select(
        key,
        free(last(F.filter(axes, lambda x: ~F.array_contains("sizes", name(x))))).alias("color"),
        free(last(F.filter(axes, lambda x: F.array_contains("sizes", name(x))))).alias("tag_size"),
        F.when(there, "in_stock").otherwise("out_of_stock").alias("status"),
        F.coalesce(F.nullif("i.code", F.lit("")), F.nullif("i.number", F.lit(0)).cast("string")).alias("option_code"),
    )


def by_fields(products: DataFrame, key: str, items: str = "items") -> DataFrame:
    """As ``by_axes``, of items that name their axes (number, color, size, stock as text): stock that is no number is none."""
    said = lambda c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("FREE"))
    there = F.coalesce(F.col("i.stock").try_cast("long"), F.lit(0)) > 0
    return products.select(key, F.explode(items).alias("i")).select(
        key,
        said("i.color").alias("color"),
        said("i.size").alias("tag_size"),
        F.when(there, "in_stock").otherwise("out_of_stock").alias("status"),
        F.nullif("i.number", F.lit("")).alias("option_code"),
    )


def stock_status(statuses: Column, single: Column, marked: Column) -> Column:
    """``in_stock`` if any option is; without options by the single stock number; without that by the mark of being sold out."""
    there = F.when(F.size(statuses) > 0, F.array_contains(statuses, "in_stock")).when(single.isNotNull(), single > 0).otherwise(~F.coalesce(marked, F.lit(False)))
    return F.when(there, "in_stock").otherwise("out_of_stock")
