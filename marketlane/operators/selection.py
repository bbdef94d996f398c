"""Rules that select, order and rewrite rows before they are converted, listed or retired."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gated(rows: DataFrame, reviewed: DataFrame, key: str, flag: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key was approved (flag 1), and the keys that nobody has reviewed yet; rejected keys are in neither."""
    flow = rows.join(reviewed.filter(F.col(flag) == 1).select(key), key, "left_semi")
    return flow, rows.select(key).distinct().join(reviewed.select(key), key, "left_anti")


def keyword_excluded(rules: dict[str, list[str]], store: Column, *texts: Column) -> Column:
    """Does any of the texts contain one of the store's words? A store without rules excludes nothing."""
    table = F.create_map(*(x for k, v in rules.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    words = F.coalesce(table[store], F.array().cast("array<string>"))

    def held(text: Column) -> Column:
        return F.exists(words, lambda w: F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lower(w)))

    return reduce(lambda a, b: a | b, map(held, texts))


def first_valid(*candidates: tuple[Column, Column]) -> Column:
    """The first candidate whose test holds."""
    return F.coalesce(*(F.when(ok, value) for value, ok in candidates))


def item_status(code: Column) -> Column:
    """An answer's code as a status; an unknown one is an error."""
    return F.when(code == 200, "ACTIVE").when(code == 404, "DELETED").when(code == 410, "SOLD_OUT").otherwise(F.raise_error(F.concat(F.lit("unknown code "), code.cast("string"))))


def replaced(text: Column, words: dict[str, str]) -> Column:
    """All keys replaced by their values, longest key first, so that no key hides a longer one."""
    return reduce(lambda t, k: F.replace(t, F.lit(k), F.lit(words[k])), sorted(words, key=lambda k: (-len(k), k)), text)


def appended(known: DataFrame, new: DataFrame, key: str, url: str, place: str, cap: int) -> DataFrame:
    """New urls of a key with places that go on after the known ones, up to ``cap``; known urls are left out."""
    last = known.groupBy(key).agg(F.max(place).alias("__last"))
    fresh = new.join(known.select(key, url), [key, url], "left_anti").join(last, key, "left")
    nth = F.row_number().over(Window.partitionBy(key).orderBy(url)) + F.coalesce("__last", F.lit(0))
    return fresh.select(key, url, nth.alias(place)).filter(F.col(place) <= cap)


def donors(members: DataFrame, key: str, more_than: int) -> DataFrame:
    """Per key the winner if it has more than so many images, else the member with the most; ties go to the winner, then by priority and the larger id."""
    best = F.struct((F.col("is_winner") & (F.col("images") > more_than)).alias("a"), F.col("images").alias("b"), F.col("is_winner").alias("c"), (-F.col("priority")).alias("d"), F.col("member_id").alias("e"))
    return members.groupBy(key).agg(F.max_by("member_id", best).alias("donor_id"))


def calibrated(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: kappa, actual orders by predicted ones, and c, actual margin by predicted margin; null where nothing was predicted."""
    p = predicted.agg(F.sum("orders").alias("p_orders"), F.sum("margin").alias("p_margin"))
    a = actual.agg(F.sum("orders").alias("orders"), F.sum("margin").alias("margin"))
    return a.crossJoin(p).select((F.col("orders") / F.nullif("p_orders", F.lit(0))).alias("kappa"), (F.col("margin") / F.nullif("p_margin", F.lit(0))).alias("c"))


def calls_left(calls: DataFrame, at: str, today: str, share: float = 1.5, days: int = 7) -> DataFrame:
    """One row, calls: what is left today of ``share`` times the daily average of the week before; never below 0."""
    day = F.col(at).cast("date")
    now = F.lit(today).cast("date")
    week = F.count_if((day >= F.date_sub(now, days)) & (day < now))
    return calls.agg(F.greatest(F.lit(0), F.ceil(week * F.lit(share) / days) - F.count_if(day == now)).alias("calls"))


def filled(waiting: DataFrame, score: str, key: str, open_slots: DataFrame, calls: DataFrame, per_row: int, most: int) -> DataFrame:
    """key and slot (from 1) of the best waiting rows: as many as slots are open, calls last, and ``most`` allows."""
    best = waiting.orderBy(F.desc(score), F.asc(key)).limit(most).withColumn("slot", F.row_number().over(Window.orderBy(F.desc(score), F.asc(key))))
    bounds = open_slots.crossJoin(F.broadcast(calls)).select(F.least("slots", F.expr(f"calls div {per_row}")).alias("__n"))
    return best.crossJoin(F.broadcast(bounds)).filter("slot <= __n").select(key, "slot")


def rested(rows: DataFrame, swaps: DataFrame, key: str, at: str, as_of: str, days: int) -> DataFrame:
    """Rows whose key has no recorded swap in the last ``days``."""
    recent = swaps.filter((F.col(at) <= F.lit(as_of).cast("timestamp_ntz")) & (F.col(at) > F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))))
    return rows.join(recent.select(key), key, "left_anti")


def swapped(listed: DataFrame, waiting: DataFrame, score: str, key: str, margin: int, pairs: int) -> DataFrame:
    """out_id, in_id, gain: the weakest listed against the best waiting by rank, where the gain is above the margin; ``pairs`` at most.

    Twice as many are ranked as are asked for, so that pairs without enough gain make room for others.
    """

    def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
        few = rows.orderBy(*order).limit(2 * pairs).withColumn("i", F.row_number().over(Window.orderBy(*order)))
        return few.select("i", F.col(key).alias(name), F.col(score).alias(f"__{name}"))

    weak = ranked(listed, [F.asc(score), F.asc(key)], "out_id")
    good = ranked(waiting, [F.desc(score), F.asc(key)], "in_id")
    gain = F.col("__in_id") - F.col("__out_id")
    return weak.join(F.broadcast(good), "i").withColumn("gain", gain).filter(F.col("gain") >= margin).orderBy("i").limit(pairs).select("out_id", "in_id", "gain")
