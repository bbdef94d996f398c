"""Demand cells of a market and the score of drafts by a ladder of cells.

Cells come from one pass over the items with grouping sets: global, by category and price band, and by brand too; a row
counts towards a level only if it has that level's keys. Densities shrink towards the next coarser level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane.config import DemandParams
from marketlane.functions import dates, money, text
from marketlane.operators import relational
from marketlane.sources import sinks

P = DemandParams()


def recent_orders(orders: DataFrame, as_of: str, days: int = P.window_days) -> DataFrame:
    """(item_id, ord): orders of each item since ``days`` before ``as_of``."""
    return orders.filter(F.col("sale_date") >= dates.cutoff(as_of, days)).groupBy("item_id").agg(F.count("*").alias("ord"))


def shrunk(orders: Column, active: Column, parent: Column, p: DemandParams = P) -> Column:
    return (orders + p.shrink_k * parent) / (active + p.shrink_k)


def _keyed(items: DataFrame, orders: DataFrame, as_of: str, p: DemandParams) -> DataFrame:
    active = F.col("status") == "ACTIVE"
    return (
        items.join(recent_orders(orders, as_of, p.window_days), "item_id", "left")
        .withColumn("ord", F.coalesce("ord", F.lit(0).cast("long")))
        .withColumn("act", active.cast("long"))
        .withColumn("fav", F.when(active, F.col("fav_count")).otherwise(0))
        .withColumn("brand_key", text.market_brand_key(F.col("brand")))
        .withColumn("cat", text.market_category_key(F.col("category_path")))
        .withColumn("band", money.price_band(F.col("current_price")))
    )


def keyed_items(items: DataFrame, orders: DataFrame, as_of: str, p: DemandParams = P) -> DataFrame:
    """The items with their keys and recent orders, stored: both kinds of cells count from them."""
    return sinks.stored(_keyed(items, orders, as_of, p).select("brand_key", "cat", "band", "act", "ord", "fav", "model_no"), "keyed-items")


def demand_cells(items: DataFrame, orders: DataFrame, as_of: str, p: DemandParams = P) -> DataFrame:
    """level, cell_key, n_active, ord90, density, avg_fav for L6, L4 and L3."""
    return _levels(_keyed(items, orders, as_of, p), p)


def _levels(keyed: DataFrame, p: DemandParams) -> DataFrame:
    sums = (F.sum("act").alias("n_active"), F.sum("ord").alias("ord90"), F.sum("fav").alias("fav_sum"))
    # Rows without a brand take part with a null key, which is dropped from the finest level only.
    keys = keyed.withColumn("b", F.when((F.col("brand_key") != "") & (F.col("cat") != ""), F.col("brand_key"))).withColumn("c", F.when(F.col("cat") != "", F.col("cat")))
    # The finest cells are summed first, so that the sets multiply cells and not items.
    fine = keys.groupBy("b", "c", "band").agg(*sums)
    sets = fine.groupingSets([["b", "c", "band"], ["c", "band"], []], "b", "c", "band").agg(F.grouping_id().alias("gid"), *(F.sum(c).alias(c) for c in ("n_active", "ord90", "fav_sum")))
    # Three levels come from one table; it has a row for each cell, so it is small beside the items.
    sets = sinks.stored(sets, "demand-sets")
    l3 = sets.filter("gid = 0 AND b IS NOT NULL AND c IS NOT NULL")
    l4 = sets.filter("gid = 4 AND c IS NOT NULL").withColumn("density", shrunk(F.col("ord90"), F.col("n_active"), F.lit(p.global_density), p))
    l6 = sets.filter("gid = 7").withColumn("density", F.lit(p.global_density))
    parents = l4.select("c", "band", F.col("density").alias("parent"))
    l3 = l3.join(parents, ["c", "band"]).withColumn("density", shrunk(F.col("ord90"), F.col("n_active"), F.col("parent"), p))
    average = F.try_divide("fav_sum", "n_active").alias("avg_fav")
    out = lambda df, level, key: df.select(F.lit(level).alias("level"), key.alias("cell_key"), "n_active", "ord90", "density", average)
    return (
        out(l6, "L6", F.lit("GLOBAL"))
        .unionByName(out(l4, "L4", F.concat_ws("|", "c", "band")))
        .unionByName(out(l3, "L3", F.concat_ws("|", "b", "c", "band")))
    )


def code_cells(items: DataFrame, orders: DataFrame, as_of: str, p: DemandParams = P) -> DataFrame:
    """code, brand_key, n_active, ord90, max_fav; each code counts once per item, empty cells are left out."""
    return _codes(_keyed(items, orders, as_of, p))


def cells_and_codes(items: DataFrame, orders: DataFrame, as_of: str, p: DemandParams = P) -> tuple[DataFrame, DataFrame]:
    """Both kinds of cells from one pass over items and orders."""
    keyed = keyed_items(items, orders, as_of, p)
    return sinks.stored(_levels(keyed, p), "demand-cells"), _codes(keyed)


def _codes(keyed: DataFrame) -> DataFrame:
    # Items of a brand and model are summed first: each model's text is read once, not once an item.
    models = keyed.filter("brand_key <> ''").groupBy("brand_key", "model_no").agg(F.sum("act").alias("act"), F.sum("ord").alias("ord"), F.max(F.when(F.col("act") == 1, F.col("fav"))).alias("fav"))
    codes = models.withColumn("code", F.explode(text.model_tokens(F.col("model_no"))))
    cells = codes.groupBy("code", "brand_key").agg(F.sum("act").alias("n_active"), F.sum("ord").alias("ord90"), F.coalesce(F.max("fav"), F.lit(0)).cast("long").alias("max_fav"))
    return cells.filter("n_active > 0 OR ord90 > 0")


def draft_scores(listings: DataFrame, cells: DataFrame, codes: DataFrame, p: DemandParams = P) -> DataFrame:
    """listing_id, d_level, d_cell_key, density, d_adj, expected_daily: the first level of L1, L3, L4, L6 that has a cell."""
    l = listings.select("listing_id", "price", "model_no", text.listing_brand_key(F.col("brand_name")).alias("bk"), text.listing_category_key(F.col("paths"), F.col("category_name")).alias("ck"), money.price_band(F.col("price")).alias("band"))
    l = l.withColumn("k4", F.when(F.col("ck") != "", F.concat_ws("|", "ck", "band"))).withColumn("k3", F.when((F.col("bk") != "") & (F.col("ck") != ""), F.concat_ws("|", "bk", "ck", "band")))
    level = lambda n: cells.filter(F.col("level") == f"L{n}").select(F.col("cell_key").alias(f"k{n}"), F.col("density").alias(f"d{n}"), F.col("avg_fav").alias(f"fav{n}"))
    l = l.join(level(4), "k4", "left").join(level(3), "k3", "left")
    d6 = cells.filter("level = 'L6'").agg(F.max("density").alias("d6"))
    l = l.crossJoin(F.broadcast(d6)).withColumn("d6", F.coalesce("d6", F.lit(p.global_density)))
    # The choice among an item's codes: strong ones that have a cell, by active items, orders, then the code itself.
    strong = l.filter("bk <> ''").select("listing_id", "bk", F.explode(text.model_tokens(F.col("model_no"))).alias("code")).filter(F.length("code") >= p.strong_len)
    hits = strong.join(codes.withColumnRenamed("brand_key", "bk"), ["code", "bk"])
    best = hits.groupBy("listing_id").agg(F.min_by(F.struct("code", "n_active", "ord90", "max_fav"), F.struct(-F.col("n_active"), -F.col("ord90"), F.col("code"))).alias("hit"))
    l = l.join(best, "listing_id", "left")
    parent = F.coalesce("d3", "d4", "d6")
    # A level counts as found by its density; its average may still be null.
    fav = F.when(F.col("d3").isNotNull() & F.col("fav3").isNotNull(), F.col("fav3")).otherwise(F.col("fav4"))
    found = F.col("hit").isNotNull()
    density = F.when(found, shrunk(F.col("hit.ord90"), F.col("hit.n_active"), parent, p)).otherwise(parent)
    adj = F.when(found & (fav > 0), money.clipped(F.col("hit.max_fav") / fav, p.adj_low, p.adj_high)).otherwise(1.0)
    step = F.when(found, "L1").when(F.col("d3").isNotNull(), "L3").when(F.col("d4").isNotNull(), "L4").otherwise("L6")
    key = F.when(found, F.concat_ws("|", "hit.code", "bk")).when(F.col("d3").isNotNull(), F.col("k3")).when(F.col("d4").isNotNull(), F.col("k4")).otherwise("GLOBAL")
    out = l.select("listing_id", step.alias("d_level"), key.alias("d_cell_key"), density.alias("density"), adj.alias("d_adj"))
    return out.withColumn("expected_daily", p.kappa * F.col("density") * F.col("d_adj") / p.window_days)


def capture(scored: DataFrame, sold: str, score: str, parts: int = 10) -> DataFrame:
    """Backtest: for each tenth of the score, rows, sales, rate and the share of all sales captured so far.

    Ranks come from counts per score and their running sum, which no single task computes.
    """
    by = scored.groupBy(score).agg(F.count("*").alias("n"), F.sum(sold).alias("s"))
    upto = relational.running_sum(by, score, "n", "upto", descending=True)
    ranked = upto.crossJoin(F.broadcast(upto.agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))))
    tenth = F.least(F.lit(parts), F.floor((F.col("upto") - 1) * parts / F.col("all_n")) + 1)
    out = ranked.withColumn("tenth", tenth.cast("int")).groupBy("tenth").agg(F.sum("n").alias("n"), F.sum("s").alias("sold"), F.max("all_s").alias("all_s"))
    return out.select("tenth", "n", "sold", F.round(F.col("sold") / F.col("n"), 6).alias("rate"), F.round(F.sum("sold").over(Window.orderBy("tenth")) / F.col("all_s"), 6).alias("captured"))


def auc(scored: DataFrame, hit: str, score: str) -> DataFrame:
    """One row, auc: how likely a row with ``hit`` 1 scores above one with 0, where equal scores count half; null without both.

    That is the rank sum with averaged ranks of ties, from counts per score and their running sum: no sort of all rows.
    """
    by = scored.groupBy(score).agg(F.count_if(F.col(hit) > 0).alias("ones"), F.count_if(F.col(hit) <= 0).alias("zeros"))
    upto = relational.running_sum(by, score, "zeros", "upto")
    won = F.sum(F.col("ones") * (F.col("upto") - F.col("zeros") / 2))
    return upto.agg(F.try_divide(won, F.sum("ones") * F.sum("zeros")).alias("auc"))
