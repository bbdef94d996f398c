"""Market observations: change-only histories, velocity, tiers, due queues, boundaries and up/down days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane.functions import dates, text
from marketlane.operators import relational
from marketlane.operators.relational import ranked

#: Days until the next visit, by tier of items and of sellers.
ITEM_DAYS, SELLER_DAYS = {"HOT": 1, "WARM": 4, "COLD": 30}, {"HIGH": 1, "MID": 4, "LOW": 21}


def item_tier(fav: Column, view: Column, inquiry: Column, sales30: Column, sales90: Column, strong: Column) -> Column:
    hot = (fav >= 50) | (view >= 2000) | (inquiry >= 5) | (sales30 >= 3)
    warm = (fav >= 10) | (view >= 500) | (inquiry >= 1) | (sales30 >= 1) | (strong & (sales90 >= 1))
    return F.when(hot, "HOT").when(warm, "WARM").otherwise("COLD")


def promoted(tier: Column, fav_velocity: Column, view_velocity: Column) -> Column:
    """One step up on a surge; null velocities don't surge."""
    surge = F.coalesce(fav_velocity >= 5, F.lit(False)) | F.coalesce(view_velocity >= 100, F.lit(False))
    return F.when(surge & (tier == "COLD"), "WARM").when(surge & (tier == "WARM"), "HOT").otherwise(tier)


def days_of(tier: Column, days: dict[str, int]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in days.items() for x in kv)), tier)


def rank_tier(fraction: Column) -> Column:
    return F.when(fraction < 0.15, "HIGH").when(fraction < 0.50, "MID").otherwise("LOW")


def last_two(observations: DataFrame, key: str, time: str) -> DataFrame:
    return ranked(observations, [key], [F.col(time).desc()]).filter("nth <= 2")


def velocities(observations: DataFrame, key: str, time: str, metrics: list[str]) -> DataFrame:
    """key, n, last_at, last value and change per day of each metric over the last two rows; null for fewer than two."""
    two = last_two(observations, key, time)
    pick = lambda c, n: F.max(F.when(F.col("nth") == n, F.col(c)))
    d = dates.seconds_between(pick(time, 2), pick(time, 1)) / 86400
    return two.groupBy(key).agg(F.count("*").alias("n"), pick(time, 1).alias("last_at"), *(pick(m, 1).alias(m) for m in metrics), *(F.when(d > 0, (pick(m, 1) - pick(m, 2)) / d).alias(f"{m}_per_day") for m in metrics))


RECORD = "base_tier string, tier string, fav_velocity double, last_observed_at timestamp_ntz, next_revisit_at timestamp_ntz, obs_count long"


def records(observations: DataFrame, key: str, time: str, fav: str, view: str) -> DataFrame:
    """key and its record (``RECORD``): tiers by the newest observation and the change since the one before, and when to come again.

    Two rows of a key are combined before the shuffle: a record needs its two newest, and how many there are.
    """
    row = F.struct(F.col(time).alias("at"), F.col(fav).alias("fav"), F.col(view).alias("view"))
    two = ranked(observations.select(key, row.alias("o")), [key], [F.col("o.at").desc()]).filter("nth <= 2")
    lists = two.groupBy(key).agg(F.max(F.when(F.col("nth") == 1, F.col("o"))).alias("new"), F.max(F.when(F.col("nth") == 2, F.col("o"))).alias("old"))
    counts = observations.groupBy(key).agg(F.count("*").alias("obs_count"))
    return recorded(lists.join(counts, key), key)


#: The table of ``record_step`` for a key named item_id.
RECORDS = "item_id long, new struct<at:timestamp_ntz,fav:long,view:long>, old struct<at:timestamp_ntz,fav:long,view:long>, obs_count long"


def record_step(batch: DataFrame, known: DataFrame | None, key: str, time: str, fav: str, view: str) -> DataFrame:
    """key, new, old, obs_count after a batch of observations, for ``recorded``: the newest two that were ever seen, and how many.

    A late observation takes its place among the two if it is newer than the older one.
    """
    o = F.struct(F.col(time).cast("timestamp_ntz").alias("at"), F.col(fav).cast("long").alias("fav"), F.col(view).cast("long").alias("view"))
    rows = batch.select(key, o.alias("o"), F.lit(1).cast("long").alias("n"))
    if known is not None:
        held = known.select(key, F.explode(F.array(F.struct(F.col("new").alias("o"), F.col("obs_count").alias("n")), F.struct(F.col("old").alias("o"), F.lit(0).cast("long").alias("n")))).alias("h"))
        rows = rows.unionByName(held.select(key, "h.o", "h.n").filter("o IS NOT NULL"))
    two = ranked(rows.select(key, "o"), [key], [F.col("o").desc()]).filter("nth <= 2")
    pick = lambda n: F.max(F.when(F.col("nth") == n, F.col("o")))
    counts = rows.groupBy(key).agg(F.sum("n").alias("obs_count"))
    return two.groupBy(key).agg(pick(1).alias("new"), pick(2).alias("old")).join(counts, key)


def recorded(rows: DataFrame, key: str) -> DataFrame:
    """The records of rows (key, new, old, obs_count), whose newest two observations are structs (at, fav, view)."""
    zero = F.lit(0)
    days = dates.seconds_between(F.col("old.at"), F.col("new.at")) / 86400
    speed = lambda m: F.when(days > 0, (F.col(f"new.{m}") - F.col(f"old.{m}")) / days)
    base = item_tier(F.col("new.fav"), F.col("new.view"), zero, zero, zero, F.lit(False))
    tier = promoted(base, speed("fav"), speed("view"))
    next_at = F.col("new.at") + F.make_dt_interval(days_of(tier, ITEM_DAYS))
    return rows.select(key, base.alias("base_tier"), tier.alias("tier"), speed("fav").alias("fav_velocity"), F.col("new.at").alias("last_observed_at"), next_at.alias("next_revisit_at"), "obs_count")


def variant_history(scans: DataFrame) -> DataFrame:
    """item, sku, scan, availability: what to append to the variants' history after each scan: 1 in, 0 out, 2 gone.

    ``scans``: scan, item, sku, availability. A scan judges the items it has rows of. The first sight of a variant is its
    baseline; later only changes are appended, and gone is a variant that a scan of its item lacks.
    """
    covered = scans.groupBy("item").agg(F.array_sort(F.collect_set("scan")).alias("covered"))
    seen = scans.groupBy("item", "sku").agg(F.map_from_entries(F.collect_list(F.struct("scan", "availability"))).alias("seen"))
    each = seen.join(covered, "item").select("item", "sku", "seen", F.explode("covered").alias("scan"))
    rows = each.filter(F.col("scan") >= F.array_min(F.map_keys("seen"))).withColumn("availability", F.coalesce(F.try_element_at("seen", F.col("scan")), F.lit(2)))
    was = F.lag("availability").over(Window.partitionBy("item", "sku").orderBy("scan"))
    return rows.withColumn("was", was).filter("was IS NULL OR was <> availability").select("item", "sku", "scan", "availability")


def history_checks(history: DataFrame, current: DataFrame) -> DataFrame:
    """check, value, n: rows by availability, rows by scan, and variants whose latest row isn't what ``current`` says.

    ``current``: item, sku, availability. A variant that one side lacks counts as inconsistent, too.
    """
    by = lambda c, name: history.groupBy(F.lit(name).alias("check"), F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n"))
    latest = history.groupBy("item", "sku").agg(F.max_by("availability", "scan").alias("was"))
    both = latest.join(current, ["item", "sku"], "full_outer")
    odd = both.agg(F.count_if(~F.col("was").eqNullSafe(F.col("availability"))).alias("n"))
    return by("availability", "state").unionByName(by("scan", "volume")).unionByName(odd.select(F.lit("inconsistent").alias("check"), F.lit("").alias("value"), "n"))


def variant_step(scan: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """What one scan appends to the variants' history, and the variants' last availabilities after it (item, sku, availability).

    One full join on item and sku; variants of items that the scan has no rows of stay as they are known.
    """
    now = scan.select("item", "sku", "scan", F.col("availability").alias("now"))
    if known is None:
        return now.withColumnRenamed("now", "availability"), now.select("item", "sku", F.col("now").alias("availability"))
    covered = scan.groupBy("item").agg(F.max("scan").alias("at"))
    both = known.withColumnRenamed("availability", "was").join(now, ["item", "sku"], "full_outer").join(covered, "item", "left")
    new = F.coalesce("now", F.when(F.col("at").isNotNull(), 2), "was").cast("long")
    judged = both.select("item", "sku", F.col("at").alias("scan"), "was", new.alias("availability"))
    changed = judged.filter("was IS NULL OR was <> availability")
    return changed.select("item", "sku", "scan", "availability"), judged.select("item", "sku", "availability")


def changes_only(observations: DataFrame, key: str, time: str, values: list[str]) -> DataFrame:
    """The first row of a key, and those that differ from the row before in any value."""
    w = Window.partitionBy(key).orderBy(time)
    now = F.struct(*values)
    return observations.withColumn("__was", F.lag(now).over(w)).filter(F.col("__was").isNull() | (F.col("__was") != now)).drop("__was")


def availability_delta(history: DataFrame, scan: DataFrame, scanned: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to append to a variant history: 1 in, 0 out, 2 gone; only changes, and only for items that were scanned.

    ``history``: keys, observed_at, availability; ``scan``: keys, availability; ``scanned``: the first key.
    """
    latest = history.groupBy(*keys).agg(F.max_by("availability", "observed_at").alias("was"))
    known = latest.join(scanned.select(keys[0]).distinct(), keys[0], "left_semi")
    both = known.join(scan.select(*keys, F.col("availability").alias("now")), keys, "full_outer")
    new = F.coalesce("now", F.lit(2))
    return both.select(*keys, new.alias("availability"), "was").filter(F.col("was").isNull() | (F.col("was") != F.col("availability"))).drop("was")


def boundary_at(rows: Column, known: Column) -> Column:
    """How many elements stand before the first place where ``known`` stands whole in ``rows``; null if it doesn't, or is empty."""
    places = F.when((F.size(known) > 0) & (F.size(rows) >= F.size(known)), F.sequence(F.lit(0), F.size(rows) - F.size(known)))
    # The first element decides for nearly all places, so only few are compared whole.
    alike = lambda i: (F.get(rows, i) == F.get(known, F.lit(0))) & (F.slice(rows, i + 1, F.size(known)) == known)
    return F.get(F.filter(F.coalesce(places, F.array().cast("array<int>")), alike), F.lit(0))


#: The table of ``sequence_step``: the newest rows of a seller's last list.
KNOWN = "seller_id long, known array<struct<sale_date:string,item_id:string,qty:long>>"
_ROWS, _NEW = "array<struct<sale_date:string,item_id:string,qty:bigint>>", "array<struct<crawl:bigint,over:boolean,rows:array<struct<sale_date:string,item_id:string,qty:bigint>>>>"


def sequence_lists(crawls: DataFrame) -> DataFrame:
    """seller_id and its crawls in order: their numbers, and their rows (sale_date, item_id, qty), newest first."""
    # Dealt by seller once, before rows become arrays: both groupings keep to that.
    lists = crawls.repartition("seller_id").groupBy("seller_id", "crawl").agg(F.sort_array(F.collect_list(F.struct("place", "sale_date", "item_id", "qty"))).alias("rows"))
    rows = F.transform("rows", lambda r: F.struct(r["sale_date"].alias("sale_date"), r["item_id"].alias("item_id"), r["qty"].alias("qty")))
    return lists.groupBy("seller_id").agg(F.sort_array(F.collect_list(F.struct("crawl", rows.alias("rows")))).alias("crawls"))


def sequence_step(lists: DataFrame, known: DataFrame | None, size: int) -> tuple[DataFrame, DataFrame]:
    """New rows of sellers' lists, crawl by crawl, and the table ``KNOWN`` after them, which has ``size`` rows of each.

    New are the rows before the place where the known ones stand whole. If they stand nowhere, rows of their newest date or
    later are, and ``over`` says that too much may have been taken. A seller's list has to come in one batch.
    """
    if known is None:
        both = lists.withColumn("known", F.lit(None).cast(_ROWS))
    else:
        both = lists.join(known, "seller_id", "full_outer")

    def step(s: Column, c: Column) -> Column:
        held, rows = s["known"], c["rows"]
        newest = F.array_max(F.transform(held, lambda k: k["sale_date"]))
        found = lambda at: F.when(at.isNotNull(), F.slice(rows, F.lit(1), at)).when(F.size(held) == 0, rows).otherwise(text.once(newest, lambda d: F.filter(rows, lambda r: r["sale_date"] >= d)))
        told = lambda at: F.array(F.struct(c["crawl"].alias("crawl"), (at.isNull() & (F.size(held) > 0)).alias("over"), found(at).alias("rows")))
        return F.struct(F.slice(rows, 1, size).alias("known"), F.concat(s["new"], text.once(boundary_at(rows, held), told)).cast(_NEW).alias("new"))

    start = F.struct(F.coalesce("known", F.array().cast(_ROWS)).alias("known"), F.array().cast(_NEW).alias("new"))
    fresh = both.filter("crawls IS NOT NULL").select("seller_id", F.explode(F.aggregate("crawls", start, step)["new"]).alias("n"))
    rows = fresh.select("seller_id", "n.crawl", F.explode("n.rows").alias("r"), "n.over").select("seller_id", "crawl", "r.*", "over")
    last = F.slice(F.element_at("crawls", -1)["rows"], 1, size)
    return rows, both.select("seller_id", F.coalesce(last, "known").alias("known"))


def boundary_surplus(new: DataFrame, old: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Of new rows, as many per signature as there are beyond those already stored."""
    n_old = old.groupBy(*keys).agg(F.count("*").alias("n_old"))
    n_new = new.groupBy(*keys).agg(F.count("*").alias("n_new"))
    more = n_new.join(n_old, keys, "left").select(*keys, F.greatest(F.lit(0), F.col("n_new") - F.coalesce("n_old", F.lit(0))).alias("extra")).filter("extra > 0")
    return ranked(new.join(more, keys), keys, order).filter("nth <= extra").drop("nth", "extra")


def up_days(events: DataFrame, key: str, time: str, kind: str, as_of: str) -> DataFrame:
    """key, n_ups, seconds, is_up: time spent up. Repeated ups keep the first start; downs without a start count nothing.

    Only rows whose state differs from the one before are transitions; each up lasts until the next down, or ``as_of``.
    """
    w = Window.partitionBy(key).orderBy(time)
    flips = events.withColumn("__was", F.coalesce(F.lag(kind).over(w), F.lit("down"))).filter(F.col("__was") != F.col(kind))
    spans = flips.withColumn("__end", F.coalesce(F.lead(time).over(w), F.lit(as_of).cast("timestamp_ntz"))).filter(F.col(kind) == "up")
    last = events.groupBy(key).agg(F.max_by(kind, time).alias("__last"))
    total = spans.groupBy(key).agg(F.count("*").alias("n_ups"), F.sum(dates.micros(F.col("__end")) - dates.micros(F.col(time))).alias("__us"))
    return last.join(total, key, "left").select(key, F.coalesce("n_ups", F.lit(0)).alias("n_ups"), (F.coalesce("__us", F.lit(0)) / 1_000_000).alias("seconds"), (F.col("__last") == "up").alias("is_up"))


def seller_values(sellers: DataFrame, items: DataFrame) -> DataFrame:
    """Every seller with score = 10 * hot and warm items + recent orders, its place among all, tier and days to the next scan.

    ``items``: seller_id, tier, and the recent orders of each as ``sold``, so that orders are read and counted once.
    Places come from the order by score and id, dealt by ranges of both, so that many sellers of one score are no one task's.
    """
    own = items.groupBy("seller_id").agg(F.count_if(F.col("tier").isin("HOT", "WARM")).alias("n_hot"), F.sum("sold").alias("n_orders"))
    s = sellers.join(own, "seller_id", "left")
    score = 10 * F.coalesce("n_hot", F.lit(0)) + F.coalesce("n_orders", F.lit(0))
    scored = s.select("seller_id", score.alias("score"), F.lit(1).cast("long").alias("one"))
    placed = relational.running_sum(scored, [F.desc("score"), F.desc("seller_id")], "one", "place")
    all_of = placed.agg(F.max("place").alias("n"))
    fraction = (F.col("place") - 1) / F.col("n")
    ranked = placed.crossJoin(F.broadcast(all_of)).select("seller_id", "score", F.round(fraction, 6).alias("fraction"), rank_tier(fraction).alias("tier"))
    return ranked.withColumn("scan_days", days_of(F.col("tier"), SELLER_DAYS))


def breaker(events: DataFrame, key: str, time: str, seconds: int, limit: int) -> DataFrame:
    """key, opened_at: the first moment with at least ``limit`` events in the last ``seconds``."""
    w = Window.partitionBy(key).orderBy(dates.micros(F.col(time))).rangeBetween(-seconds * 1_000_000, 0)
    return events.withColumn("__n", F.count("*").over(w)).filter(F.col("__n") >= limit).groupBy(key).agg(F.min(time).alias("opened_at"))
