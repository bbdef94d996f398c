"""What a search lists, summed up; and labels put right by a catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane.functions import text
from marketlane.operators.matching import same_brand


def search_results(items: DataFrame, key: str, own: Column) -> DataFrame:
    """For each key: n, floor_price, top_item, top_seller, top_price, our_rank (the first), our_ranks (all, in one text), is_ours.

    Rows are ranked by price, then by id. Everything but our own places comes from one aggregate, so a window sees only
    keys in which we are at all.
    """
    order = F.struct("current_price", "item_id")
    first = F.min_by(F.struct("item_id", "seller_id", "current_price"), order)
    sums = items.groupBy(key).agg(F.count("*").alias("n"), F.min("current_price").alias("floor_price"), first.alias("top"), F.bool_or(own).alias("any_own"))
    there = items.withColumn("own", own).join(sums.filter("any_own").select(key), key, "left_semi")
    ranks = there.select(key, "own", F.row_number().over(Window.partitionBy(key).orderBy("current_price", "item_id")).cast("long").alias("r")).filter("own")
    ours = ranks.groupBy(key).agg(F.min("r").alias("our_rank"), F.array_join(F.sort_array(F.collect_list("r")).cast("array<string>"), " ").alias("our_ranks"))
    out = sums.join(ours, key, "left")
    return out.select(
        key,
        "n",
        "floor_price",
        F.col("top.item_id").alias("top_item"),
        F.col("top.seller_id").alias("top_seller"),
        F.col("top.current_price").alias("top_price"),
        "our_rank",
        F.coalesce("our_ranks", F.lit("")).alias("our_ranks"),
        F.coalesce(F.col("our_rank") == 1, F.lit(False)).alias("is_ours"),
    )


def corrected_labels(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """id, outcome, label: labels held against what the maker is called, and against the store's catalogue.

    ``rows``: id, store, label, maker; ``catalogue``: store, name, english. ``missing``: no maker; ``keep``: label and maker
    are one family; ``hangul``: a maker in Hangul isn't touched; ``replaced`` by the catalogue's spelling; else
    ``unmapped``, with the maker as it stands. Of several spellings of one key the first by text counts.
    """
    spelling = F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.nullif(F.trim("english"), F.lit("")))
    keys = F.array_distinct(F.array(text.alnum_upper(F.col("name")), text.alnum_upper(F.col("english"))))
    known = catalogue.select("store", spelling.alias("spelling"), F.explode(keys).alias("key")).filter("key <> '' AND spelling IS NOT NULL")
    first = known.groupBy("store", "key").agg(F.min("spelling").alias("spelling"))
    maker = F.trim(F.coalesce("maker", F.lit("")))
    made = rows.withColumn("maker", maker).withColumn("key", text.alnum_upper(F.col("maker"))).join(first, ["store", "key"], "left")
    hangul = text.has_hangul(F.col("maker"))
    outcome = (
        F.when((F.col("key") == "") & ~hangul, "missing")
        .when((F.col("key") != "") & same_brand(F.col("label"), F.col("maker")), "keep")
        .when(hangul, "hangul")
        .when(F.col("spelling").isNotNull(), "replaced")
        .otherwise("unmapped")
    )
    new = F.when(outcome == "replaced", F.col("spelling")).when(outcome == "unmapped", F.col("maker")).otherwise(F.col("label"))
    return made.select("id", outcome.alias("outcome"), new.alias("label"))
