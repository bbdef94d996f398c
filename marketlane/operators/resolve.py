"""Resolving a listing's offers: margins, the winner, its options; modes and keepers of reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlane.functions import money
from marketlane.operators.relational import first_by, grid


def member_margins(listings: DataFrame, offers: DataFrame) -> DataFrame:
    """Every active offer of a listing with margin_amount, margin_percent and eligible (a positive margin)."""
    m = offers.filter("is_active = 1").join(listings.select("listing_id", "price"), "listing_id")
    amount = money.margin_amount(F.col("price"), F.col("purchase_price"), F.col("shipping"))
    percent = money.margin_percent(F.col("price"), F.col("purchase_price"), F.col("shipping"))
    return m.withColumns({"margin_amount": amount, "margin_percent": percent, "eligible": F.coalesce(amount > 0, F.lit(False))})


def winners(members: DataFrame) -> DataFrame:
    """The cheapest eligible offer of each listing; of equally cheap ones that of the smallest id."""
    return first_by(members.filter("eligible").select("listing_id", "offering_id", "source_site", "purchase_price", "margin_amount"), ["listing_id"], [F.col("purchase_price"), F.col("offering_id")])


def option_union(members: DataFrame, options: DataFrame) -> DataFrame:
    """For each listing, colour and size in stock at an eligible offer: the cheapest such offer."""
    there = members.filter("eligible").select("listing_id", "offering_id", "purchase_price").join(options.filter("in_stock = 1"), "offering_id")
    return first_by(there.select("listing_id", "color", "size", "offering_id", "purchase_price"), ["listing_id", "color", "size"], [F.col("purchase_price"), F.col("offering_id")])


def completed_grid(union: DataFrame) -> DataFrame:
    """All colours by all sizes of a listing; pairs that no offer has are out of stock."""
    return grid(union, "listing_id", "color", "size").join(union.select("listing_id", "color", "size", F.lit(1).alias("__has")), ["listing_id", "color", "size"], "left").withColumn("in_stock", F.coalesce("__has", F.lit(0))).drop("__has")


def final_prices(listings: DataFrame, members: DataFrame, competitors: DataFrame, seed: int = 1) -> DataFrame:
    """listing_id, outcome (priced, no_price, no_margin), price: undercut a competitor, else the target of the cheapest offer.

    How far a competitor is undercut is drawn from 1 to 9 by listing and ``seed``, so that a run can be repeated.
    """
    cheapest = members.filter("purchase_price > 0").groupBy("listing_id").agg(F.min_by(F.struct("purchase_price", "shipping"), F.struct("purchase_price", "offering_id")).alias("m"), F.max("eligible").alias("any_margin"))
    l = listings.join(cheapest, "listing_id", "left").join(competitors, "listing_id", "left")
    target = money.target_price(F.col("m.purchase_price"), F.col("m.shipping"))
    price = F.when(F.col("lowest").isNotNull(), money.undercut(F.col("price"), F.col("lowest"), money.seeded_draw(F.col("listing_id"), seed))).otherwise(target)
    outcome = F.when(F.col("m").isNull(), "no_price").when(F.col("lowest").isNotNull() & ~F.col("any_margin"), "no_margin").otherwise("priced")
    return l.select("listing_id", outcome.alias("outcome"), F.when(outcome == "priced", price).cast("long").alias("price"))


def modes(listings: DataFrame, offers: DataFrame, winner: DataFrame) -> DataFrame:
    """listing_id, n_published, mode: create without a published member, edit with one, collapse with more; an edit whose
    published member is not the winner fixes the sourcing."""
    members = offers.join(winner.select("listing_id", F.col("offering_id").alias("__w")), "listing_id", "left")
    counts = members.groupBy("listing_id").agg(F.countDistinct(F.when(F.col("is_published") == 1, F.col("offering_id"))).alias("n_published"), F.coalesce(F.max((F.col("is_published") == 1) & (F.col("offering_id") == F.col("__w"))), F.lit(False)).alias("winner_published"))
    mode = F.when(F.col("n_published") == 0, "create").when(F.col("n_published") >= 2, "collapse").when(F.col("winner_published"), "edit").otherwise("edit_sourcing")
    return counts.select("listing_id", "n_published", mode.alias("mode"))


def keepers(members: DataFrame, group: str, metrics: list[str], id_col: str) -> DataFrame:
    """Of each group, the member that is best by the metrics in turn (null counts as 0), the smallest id of ties."""
    order = [-F.coalesce(F.col(m).cast("double"), F.lit(0.0)) for m in metrics]
    return first_by(members.select(group, id_col, *metrics), [group], [*order, F.col(id_col)])


def ordered_union(rows: DataFrame, key: str, value: str, order: list, cap: int) -> DataFrame:
    """Distinct values of a key, in order of their first place, at most ``cap`` of them: key, values (the list is the feature)."""
    firsts = rows.groupBy(key, value).agg(F.min(F.struct(*order)).alias("__o"))
    nth = firsts.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy("__o", value))).filter(F.col("nth") <= cap)
    return nth.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("nth", value))).alias("__v")).select(key, F.transform("__v", lambda x: x[value]).alias("values"))
