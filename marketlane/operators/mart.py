"""The wide dashboard table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.functions import money


def build(listings: DataFrame, offers: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per listing: its own columns, its sources, the market's side of it, sales, status and expected margin."""
    active = F.col("is_active") == 1
    o = offers.groupBy("listing_id").agg(F.count("*").alias("n_sources"), F.count_if(active).alias("n_active"), F.min(F.when(active, F.col("purchase_price"))).alias("cheapest"), F.array_join(F.array_sort(F.collect_set("source_site")), ",").alias("sites"))
    owner = F.split("item_id", "-")[0].cast("long").alias("listing_id")
    m = items.groupBy(owner).agg(F.count("*").alias("n_market"), F.min("current_price").alias("market_lowest"), F.max("fav_count").alias("top_fav"), F.sum("view_count").alias("views"))
    s = orders.groupBy(owner).agg(F.count("*").alias("n_orders"), F.sum("qty").alias("qty"), F.max("sale_date").alias("last_sale"))
    j = listings.join(o, "listing_id", "left").join(m, "listing_id", "left").join(s, "listing_id", "left")
    status = F.when(F.col("is_published") == 1, "on_sale").when(F.coalesce("n_active", F.lit(0)) == 0, "sold_out").when(F.col("market_lowest").isNull(), "no_lowest").otherwise("waiting")
    j = j.withColumn("status", status).withColumn("available_lowest", money.break_even(F.col("cheapest"), F.lit(None).cast("long")))
    base = F.when(F.col("status") == "on_sale", F.col("price")).otherwise(F.col("market_lowest"))
    return j.withColumn("expected_margin", money.expected_margin(base, F.col("available_lowest")))
