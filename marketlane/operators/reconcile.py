"""Two states of one thing held against each other: brands of a shop, and orders against stored counts, by variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.functions import text

#: Below this share of active rows that a scan covers, what it lacks isn't judged.
LEAST_COVERAGE = 0.6


def squeezed(name: Column) -> Column:
    """A name without white space, in capitals."""
    return F.upper(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)\s+", ""))


def _bare_path(url: Column) -> Column:
    return F.regexp_replace(F.substring_index(F.coalesce(url, F.lit("")), "?", 1), "/+$", "")


def _one_each(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row for each key, the last by name and URL, so that the choice doesn't depend on the order of rows."""
    rest = [c for c in rows.columns if c not in by]
    last = rows.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*(F.coalesce(c, F.lit("")) for c in ("name", "url") if c in rest))).alias("r"))
    return last.select(*by, "r.*")


def reconciled_brands(stored: DataFrame, scanned: DataFrame) -> DataFrame:
    """store, name, change, url, key: what a scan of shops' brand lists changes in the stored ones.

    ``stored``: store, name, url, key, active (1, 0 or null); ``scanned``: store, name, url, key. A scanned brand is looked
    for by its key, then by its name without blanks and case: ``same``, ``moved`` (another path or key), ``kept off`` (it was
    switched off by hand and stays so), or ``new``; of stored brands that share a key, the last by name stands for it. A new
    name in Hangul is ``held`` in a shop whose stored names have none.

    An active stored brand is missing if neither its name is scanned nor its key, where a key counts only if no scanned
    brand of a known name has consumed it: of two brands that share one by mistake, the key saves none. The missing are
    ``gone`` if the scan covers at least 60 % of the shop's active brands, else ``withheld``; a shop without any scanned
    brand isn't judged at all. All joins are equalities on the shop and the key or name.
    """
    old = _one_each(stored.withColumn("norm", squeezed(F.col("name"))).filter("norm <> ''"), ["store", "norm"])
    new = _one_each(scanned.withColumn("norm", squeezed(F.col("name"))).filter("norm <> ''"), ["store", "norm"])
    row = F.struct(F.col("name").alias("name"), F.col("url").alias("url"), F.col("key").alias("key"), F.col("active").alias("active"))
    by_key = old.filter("key <> ''").groupBy("store", "key").agg(F.max_by(row, F.struct("name", "url")).alias("by_key"))
    by_name = old.select("store", "norm", row.alias("by_name"))
    korean = old.groupBy("store").agg(F.bool_or(text.has_hangul(F.col("name"))).alias("korean"))
    seen = new.join(by_key, ["store", "key"], "left").join(by_name, ["store", "norm"], "left").join(korean, "store", "left")
    found = F.coalesce("by_key", "by_name")
    moved = (_bare_path(found["url"]) != _bare_path(F.col("url"))) | (F.coalesce(found["key"], F.lit("")) != F.coalesce("key", F.lit("")))
    held = text.has_hangul(F.col("name")) & ~F.coalesce("korean", F.lit(False))
    change = F.when(found.isNull(), F.when(held, "held").otherwise("new")).when(found["active"] == 0, "kept off").when(moved, "moved").otherwise("same")
    scan_side = seen.select("store", F.coalesce(found["name"], F.trim("name")).alias("name"), change.alias("change"), "url", "key")

    consumed = new.filter("key <> ''").join(by_name, ["store", "norm"], "left_semi").select("store", "key").distinct()
    saving = new.filter("key <> ''").select("store", "key").distinct().join(consumed, ["store", "key"], "left_anti")
    judged = old.filter("active = 1").join(new.select("store").distinct(), "store", "left_semi")
    judged = judged.join(new.select("store", "norm", F.lit(True).alias("named")), ["store", "norm"], "left")
    judged = judged.join(saving.withColumn("keyed", F.lit(True)), ["store", "key"], "left").withColumn("there", F.coalesce("named", "keyed", F.lit(False)))
    cover = judged.groupBy("store").agg((F.count_if("there") / F.count("*")).alias("coverage"))
    missing = judged.filter(~F.col("there")).join(cover, "store")
    verdict = F.when(F.col("coverage") < LEAST_COVERAGE, "withheld").otherwise("gone")
    return scan_side.unionByName(missing.select("store", "name", verdict.alias("change"), "url", "key"))


def counted_by_variants(orders: DataFrame, variants: dict[str, Column]) -> DataFrame:
    """variant, product, n, amount: orders that a variant's predicate keeps, each id once, by product.

    ``orders``: id, product, amount, place and what the predicates read. One pass for all variants: each id states, for
    each variant, its first kept row by place. Ids without a product count nowhere.
    """
    first = lambda keep: F.min_by(F.struct("product", "amount"), F.when(keep, F.col("place")))
    once = orders.groupBy("id").agg(*(first(keep).alias(f"v{i}") for i, keep in enumerate(variants.values())))
    each = F.array(*(F.struct(F.lit(label).alias("variant"), F.col(f"v{i}.product").alias("product"), F.col(f"v{i}.amount").alias("amount")) for i, label in enumerate(variants)))
    rows = once.select(F.explode(each).alias("v")).select("v.*").filter("product IS NOT NULL")
    return rows.groupBy("variant", "product").agg(F.count("*").alias("n"), F.sum(F.coalesce("amount", F.lit(0))).alias("amount"))


def held_against(counted: DataFrame, stored: DataFrame, variants: list[str]) -> DataFrame:
    """A row for each variant and product of either side: n and amount, was_n and was_amount (null where a side lacks it).

    ``stored``: product, n, amount. The few variants multiply it, so that products of neither side are lost.
    """
    labels = F.explode(F.array(*map(F.lit, variants)))
    was = stored.select(labels.alias("variant"), "product", F.col("n").alias("was_n"), F.col("amount").alias("was_amount"))
    return counted.join(was, ["variant", "product"], "full_outer")


def variant_summary(pairs: DataFrame) -> DataFrame:
    """For each variant: totals, common products, exact matches, differing counts and amounts, one-sided products; is_best.

    The best has the most exact matches, then the smallest difference of total counts, then the first label.
    """
    here, was = F.col("n").isNotNull(), F.col("was_n").isNotNull()
    both, alike = here & was, (F.col("n") == F.col("was_n")) & (F.col("amount") == F.col("was_amount"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = pairs.groupBy("variant").agg(
        zero("n").alias("n"),
        zero("was_n").alias("was_n"),
        zero("amount").alias("amount"),
        zero("was_amount").alias("was_amount"),
        F.count_if(both).alias("common"),
        F.count_if(both & alike).alias("exact"),
        F.count_if(both & (F.col("n") != F.col("was_n"))).alias("n_differs"),
        F.count_if(both & (F.col("amount") != F.col("was_amount"))).alias("amount_differs"),
        F.count_if(here & ~was).alias("only_here"),
        F.count_if(was & ~here).alias("only_there"),
    )
    best = sums.agg(F.min_by("variant", F.struct(-F.col("exact"), F.abs(F.col("n") - F.col("was_n")), F.col("variant"))).alias("best"))
    return sums.crossJoin(F.broadcast(best)).withColumn("is_best", F.col("variant") == F.col("best")).drop("best")


def largest_mismatches(pairs: DataFrame, summary: DataFrame, top: int = 15) -> DataFrame:
    """The best variant's common products whose counts or amounts differ, the ``top`` by difference of amounts."""
    best = summary.filter("is_best").select("variant")
    differ = pairs.filter("n IS NOT NULL AND was_n IS NOT NULL AND (n <> was_n OR amount <> was_amount)")
    gap = F.abs(F.col("amount") - F.col("was_amount"))
    rows = differ.join(F.broadcast(best), "variant").withColumn("gap", gap)
    return rows.orderBy(F.desc("gap"), F.desc("product")).limit(top).drop("variant")
