"""Cohort priors for waiting products and anchored scores for published ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.config import ScoreParams
from marketlane.functions import dates, money
from marketlane.operators import relational

P = ScoreParams()


def bayes(n: Column, average: Column, parent: Column, k: float) -> Column:
    return (n * average + k * parent) / (n + k)


def cohort_priors(listed: DataFrame, as_of: str, p: ScoreParams = P) -> DataFrame:
    """level, brand, category, n, avg, prior: brand and category, brand, category, and global, from one cube.

    The signal is sales per day listed. Levels shrink to the brand's, else the global average.
    """
    s = listed.withColumn("signal", F.col("sold") / dates.whole_days(F.col("listed_on").cast("timestamp"), F.lit(as_of).cast("timestamp"), 1))
    cube = s.cube("brand", "category").agg(F.grouping_id().alias("gid"), F.count("*").alias("n"), F.avg("signal").alias("avg"))
    overall = cube.filter("gid = 3").select(F.col("avg").alias("g"))
    b = cube.filter("gid = 1 AND brand IS NOT NULL").select(F.col("brand").alias("__b"), F.col("avg").alias("b_avg"))
    rows = cube.filter("gid = 3 OR (gid = 0 AND brand IS NOT NULL AND category IS NOT NULL) OR (gid = 1 AND brand IS NOT NULL) OR (gid = 2 AND category IS NOT NULL)").crossJoin(F.broadcast(overall)).join(b, F.col("brand") == F.col("__b"), "left")
    level = F.element_at(F.array(F.lit("bc"), F.lit("b"), F.lit("c"), F.lit("global")), F.col("gid").cast("int") + 1)
    parent = F.when(F.col("gid") == 0, F.coalesce("b_avg", "g")).otherwise(F.col("g"))
    prior = F.when(F.col("gid") == 3, F.when(F.col("avg") > 0, F.col("avg")).otherwise(p.fallback_prior)).otherwise(bayes(F.col("n"), F.col("avg"), parent, p.cohort_k))
    return rows.select(level.alias("level"), "brand", "category", "n", "avg", prior.alias("prior"))


def waiting_scores(waiting: DataFrame, priors: DataFrame, p: ScoreParams = P) -> DataFrame:
    """listing_id, level, prior, score: the finest level with enough members; positive margins only."""

    def at(level: str, keys: list[str], least: int) -> DataFrame:
        return priors.filter((F.col("level") == level) & (F.col("n") >= least)).select(*keys, F.col("prior").alias(f"p_{level}"))

    w = waiting.filter("margin_krw > 0").join(at("bc", ["brand", "category"], p.min_bc), ["brand", "category"], "left").join(at("b", ["brand"], p.min_b), "brand", "left").join(at("c", ["category"], p.min_c), "category", "left")
    w = w.crossJoin(F.broadcast(priors.filter("level = 'global'").select(F.col("prior").alias("p_global"))))
    prior = F.coalesce("p_bc", "p_b", "p_c", "p_global")
    level = F.when(F.col("p_bc").isNotNull(), "bc").when(F.col("p_b").isNotNull(), "b").when(F.col("p_c").isNotNull(), "c").otherwise("global")
    return w.select("listing_id", level.alias("level"), prior.alias("prior"), F.round(prior * F.col("margin_krw"), 4).alias("score"))


def cohort_multipliers(listed: DataFrame, key: str, p: ScoreParams = P) -> DataFrame:
    """key, n, sold_n, mult: the share of members with sales, shrunk to the global share and divided by it."""
    total = listed.agg(F.avg((F.col("sold") > 0).cast("double")).alias("g"))
    by = listed.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col("sold") > 0).alias("sold_n"))
    return by.crossJoin(F.broadcast(total)).filter("g > 0").select(key, "n", "sold_n", ((F.col("sold_n") + p.cohort_k * F.col("g")) / (F.col("n") + p.cohort_k) / F.col("g")).alias("mult"))


def listed_scores(listed: DataFrame, key: str, actual_daily: DataFrame, p: ScoreParams = P) -> DataFrame:
    """listing_id, raw, score: margin by bands and cohort, scaled so that all scores add up to ``actual_daily`` (one row: actual)."""
    mult = cohort_multipliers(listed, key, p)
    raw = listed.filter("margin_krw > 0 AND price > 0").join(mult.select(key, "mult"), key).withColumn("raw", F.col("margin_krw") * money.band_factor(F.col("fav"), p.signal_bands) * money.band_factor(F.col("price"), p.price_bands) * F.col("mult"))
    anchor = raw.agg(F.sum("raw").alias("total")).crossJoin(F.broadcast(actual_daily)).select(F.try_divide("actual", "total").alias("anchor"))
    return raw.crossJoin(F.broadcast(anchor)).select("listing_id", "raw", (F.col("raw") * F.col("anchor")).alias("score"))


def nearest_rank(df: DataFrame, value: str, shares: dict[str, float]) -> DataFrame:
    """Exact percentiles by index floor(share * n), at most the last: counts per value, not one array of all values.

    Their running sum is computed by no single task.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    upto = relational.running_sum(counts, value, "n", "upto")
    upto = upto.crossJoin(F.broadcast(upto.agg(F.sum("n").alias("all"))))
    return upto.agg(*(F.min(F.when(F.col("upto") > F.least(F.floor(F.lit(s) * F.col("all")), F.col("all") - 1), F.col(value))).alias(k) for k, s in shares.items()))
