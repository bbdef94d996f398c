"""Queries of market monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane.functions import dates
from marketlane.operators import monitor, relational
from marketlane.plans import query
from marketlane.sources import domain
from marketlane.sources.domain import AS_OF, EVENTS_AS_OF, sql_over

_TWO = """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY observed_at DESC) AS nth FROM observations),
two AS (
  SELECT item_id, count(*) AS n, max(observed_at) FILTER (WHERE nth = 1) AS last_at, max(fav_count) FILTER (WHERE nth = 1) AS fav_count, max(view_count) FILTER (WHERE nth = 1) AS view_count,
         (epoch_us(max(observed_at) FILTER (WHERE nth = 1)) - epoch_us(max(observed_at) FILTER (WHERE nth = 2))) / 86400000000.0::DOUBLE AS d,
         max(fav_count) FILTER (WHERE nth = 2) AS f2, max(view_count) FILTER (WHERE nth = 2) AS v2 FROM ranked WHERE nth <= 2 GROUP BY item_id),
speeds AS (SELECT item_id, n, fav_count, view_count, CASE WHEN d > 0 THEN (fav_count - f2) / d END AS fav_per_day, CASE WHEN d > 0 THEN (view_count - v2) / d END AS view_per_day FROM two)"""


def _speeds(spark, sf_dir):
    return monitor.velocities(domain.observations(spark, sf_dir), "item_id", "observed_at", ["fav_count", "view_count"])


@query(sql_over("observations", _TWO + " SELECT item_id, n, fav_count, view_count, round(fav_per_day, 4) AS fav_per_day, round(view_per_day, 4) AS view_per_day FROM speeds"))
def latest_two_velocity(spark, sf_dir):
    """WIN-03, WIN-05, DAT-03."""
    return _speeds(spark, sf_dir).select("item_id", "n", "fav_count", "view_count", F.round("fav_count_per_day", 4).alias("fav_per_day"), F.round("view_count_per_day", 4).alias("view_per_day"))


@query(sql_over("observations", "SELECT event_id, item_id, fav_count, view_count FROM (SELECT *, lag(fav_count) OVER w AS f, lag(view_count) OVER w AS v, row_number() OVER w AS i FROM observations WINDOW w AS (PARTITION BY item_id ORDER BY observed_at)) AS x WHERE i = 1 OR f <> fav_count OR v <> view_count"))
def change_only_history(spark, sf_dir):
    """WIN-06, STR-13."""
    return monitor.changes_only(domain.observations(spark, sf_dir), "item_id", "observed_at", ["fav_count", "view_count"]).select("event_id", "item_id", "fav_count", "view_count")


@query(sql_over("observations", "SELECT event_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY observed_at DESC) AS i FROM observations) AS x WHERE i = 1"))
def latest_row(spark, sf_dir):
    """WIN-01, WIN-18, JOI-12."""
    return domain.observations(spark, sf_dir).groupBy("item_id").agg(F.max_by("event_id", "observed_at").alias("event_id"))


_SALES = f""",
sales AS (
  SELECT item_id, count(*) FILTER (WHERE sale_date >= strftime(DATE '{AS_OF}' - 30, '%Y/%m/%d')) AS s30, count(*) FILTER (WHERE sale_date >= strftime(DATE '{AS_OF}' - 90, '%Y/%m/%d')) AS s90 FROM market_orders GROUP BY item_id),
tiered AS (
  SELECT i.item_id, i.seller_id, CASE WHEN fav_count >= 50 OR view_count >= 2000 OR inquiry_count >= 5 OR coalesce(s30, 0) >= 3 THEN 'HOT'
         WHEN fav_count >= 10 OR view_count >= 500 OR inquiry_count >= 1 OR coalesce(s30, 0) >= 1 OR (seller_id % 2 = 0 AND coalesce(s90, 0) >= 1) THEN 'WARM' ELSE 'COLD' END AS tier
  FROM market_items AS i LEFT JOIN sales AS s ON i.item_id = s.item_id)"""


def _tiers(spark, sf_dir):
    orders = domain.market_orders(spark, sf_dir)
    at = lambda days: F.count_if(F.col("sale_date") >= dates.cutoff(AS_OF, days))
    sales = orders.groupBy("item_id").agg(at(30).alias("s30"), at(90).alias("s90"))
    i = domain.market_items(spark, sf_dir).join(sales, "item_id", "left")
    tier = monitor.item_tier(F.col("fav_count"), F.col("view_count"), F.col("inquiry_count"), F.coalesce("s30", F.lit(0)), F.coalesce("s90", F.lit(0)), F.col("seller_id") % 2 == 0)
    return i.select("item_id", "seller_id", tier.alias("tier"), F.coalesce("s90", F.lit(0)).alias("sold"))


@query(sql_over("market_items market_orders", _SALES + " SELECT item_id, seller_id, tier, CAST(CASE tier WHEN 'HOT' THEN 1 WHEN 'WARM' THEN 4 ELSE 30 END AS INTEGER) AS days FROM tiered"))
def revisit_tiers(spark, sf_dir):
    """STR-04, STR-08, PRJ-03."""
    return _tiers(spark, sf_dir).drop("sold").withColumn("days", monitor.days_of(F.col("tier"), monitor.ITEM_DAYS))


@query(sql_over("market_items market_orders", _SALES + f""",
hot AS (SELECT seller_id, count(*) AS n FROM tiered WHERE tier IN ('HOT', 'WARM') GROUP BY seller_id), sold AS (SELECT seller_id, count(*) AS n FROM market_orders WHERE sale_date >= strftime(DATE '{AS_OF}' - 90, '%Y/%m/%d') GROUP BY seller_id),
scores AS (SELECT s_suppkey AS seller_id, 10 * coalesce(h.n, 0) + coalesce(o.n, 0) AS score FROM supplier AS s LEFT JOIN hot AS h ON s_suppkey = h.seller_id LEFT JOIN sold AS o ON s_suppkey = o.seller_id),
placed AS (SELECT *, (row_number() OVER (ORDER BY score DESC, seller_id DESC) - 1) / CAST(count(*) OVER () AS DOUBLE) AS f FROM scores)
SELECT seller_id, score, round(f, 6) AS fraction, CASE WHEN f < 0.15 THEN 'HIGH' WHEN f < 0.50 THEN 'MID' ELSE 'LOW' END AS tier, CAST(CASE WHEN f < 0.15 THEN 1 WHEN f < 0.50 THEN 4 ELSE 21 END AS INTEGER) AS scan_days FROM placed"""))
def seller_value_tiers(spark, sf_dir):
    """AGG-34, WIN-07, SRT-09."""
    sellers = domain.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("seller_id"))
    return monitor.seller_values(sellers, _tiers(spark, sf_dir))


@query(sql_over("observations", _TWO + """
SELECT item_id, CASE WHEN surge AND base = 'COLD' THEN 'WARM' WHEN surge AND base = 'WARM' THEN 'HOT' ELSE base END AS tier FROM (
  SELECT item_id, coalesce(fav_per_day >= 5, false) OR coalesce(view_per_day >= 100, false) AS surge, CASE WHEN fav_count >= 50 OR view_count >= 2000 THEN 'HOT' WHEN fav_count >= 10 OR view_count >= 500 THEN 'WARM' ELSE 'COLD' END AS base FROM speeds) AS x"""))
def surge_promotion(spark, sf_dir):
    """STR-06, STR-07."""
    s, zero = _speeds(spark, sf_dir), F.lit(0)
    base = monitor.item_tier(F.col("fav_count"), F.col("view_count"), zero, zero, zero, F.lit(False))
    return s.select("item_id", monitor.promoted(base, F.col("fav_count_per_day"), F.col("view_count_per_day")).alias("tier"))


@query(sql_over("observations", _TWO + " SELECT item_id, round(view_per_day, 4) AS view_per_day FROM speeds WHERE view_per_day IS NOT NULL ORDER BY speeds.view_per_day DESC, item_id LIMIT 20"))
def top_surging(spark, sf_dir):
    """SRT-04, SRT-01: a top-20 report."""
    s = _speeds(spark, sf_dir).filter("view_count_per_day IS NOT NULL").orderBy(F.desc("view_count_per_day"), "item_id").limit(20)
    return s.select("item_id", F.round("view_count_per_day", 4).alias("view_per_day"))


@query(sql_over("observations", f"""
SELECT item_id, last_at FROM (SELECT item_id, max(observed_at) AS last_at, max(view_count) AS v FROM observations GROUP BY item_id) AS x
WHERE last_at + INTERVAL 1 DAY * (CASE WHEN v >= 20 THEN 1 ELSE 4 END) <= TIMESTAMP '{EVENTS_AS_OF}' ORDER BY CASE WHEN v >= 20 THEN 0 ELSE 1 END, last_at, item_id LIMIT 50"""))
def due_queue(spark, sf_dir):
    """SRT-02, SRT-03, SRT-12, FLT-20: the 50 that are due first."""
    last = domain.observations(spark, sf_dir).groupBy("item_id").agg(F.max("observed_at").alias("last_at"), F.max("view_count").alias("v"))
    due = F.col("last_at") + F.make_dt_interval(F.when(F.col("v") >= 20, 1).otherwise(4))
    return last.filter(due <= F.lit(EVENTS_AS_OF).cast("timestamp_ntz")).orderBy(F.when(F.col("v") >= 20, 0).otherwise(1), "last_at", "item_id").limit(50).select("item_id", "last_at")


_UPDOWN = "ud AS (SELECT user_id, ts, CASE WHEN event_type = 'signup' THEN 'up' ELSE 'down' END AS kind FROM events WHERE event_type IN ('signup', 'error'))"


def up_down(spark, sf_dir):
    e = domain.read(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error"))
    return e.select("user_id", "ts", F.when(F.col("event_type") == "signup", "up").otherwise("down").alias("kind"))


@query(f"""
WITH {_UPDOWN}, f AS (SELECT * FROM (SELECT *, coalesce(lag(kind) OVER (PARTITION BY user_id ORDER BY ts), 'down') AS was FROM ud) AS x WHERE was <> kind),
s AS (SELECT *, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), TIMESTAMP '{EVENTS_AS_OF}') AS e FROM f),
t AS (SELECT user_id, count(*) AS n_ups, sum(epoch_us(e) - epoch_us(ts)) / 1000000.0::DOUBLE AS seconds FROM s WHERE kind = 'up' GROUP BY user_id),
l AS (SELECT user_id, arg_max(kind, ts) AS k FROM ud GROUP BY user_id)
SELECT l.user_id, coalesce(n_ups, 0) AS n_ups, round(coalesce(seconds, 0), 3) AS seconds, k = 'up' AS is_up FROM l LEFT JOIN t ON l.user_id = t.user_id""")
def listing_days(spark, sf_dir):
    """WIN-26, STR-05 in batch."""
    return monitor.up_days(up_down(spark, sf_dir), "user_id", "ts", "kind", EVENTS_AS_OF).withColumn("seconds", F.round("seconds", 3))


@query(f"""
WITH o AS (SELECT l_suppkey AS seller_id, strftime(l_shipdate, '%Y/%m/%d') AS sale_date, CAST(l_quantity AS BIGINT) AS qty, l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-09-01'),
old AS (SELECT seller_id, sale_date, qty, count(*) AS n FROM o WHERE l_orderkey % 3 = 0 GROUP BY ALL),
new AS (SELECT seller_id, sale_date, qty, count(*) AS n FROM o GROUP BY ALL)
SELECT new.seller_id, new.sale_date, new.qty, new.n - coalesce(old.n, 0) AS n FROM new LEFT JOIN old ON new.seller_id = old.seller_id AND new.sale_date = old.sale_date AND new.qty = old.qty WHERE new.n > coalesce(old.n, 0)""")
def orders_boundary_surplus(spark, sf_dir):
    """WIN-21, STR-03."""
    new = domain.market_orders(spark, sf_dir).filter("sale_date >= '2001/09/01'")
    keys = ["seller_id", "sale_date", "qty"]
    kept = monitor.boundary_surplus(new, new.filter("order_id % 3 = 0"), keys, [F.col("order_id"), F.col("line"), F.col("item_id")])
    return kept.groupBy(*keys).agg(F.count("*").alias("n"))


@query(sql_over("offering_options", """,
h AS (SELECT offering_id, color || size AS sku, in_stock AS was FROM offering_options WHERE offering_id % 3 <> 0),
s AS (SELECT offering_id, color || size AS sku, CASE WHEN offering_id % 2 = 0 THEN in_stock ELSE 1 END AS now FROM offering_options WHERE (offering_id % 5 <> 0 AND size <> '3') OR offering_id % 3 = 0)
SELECT coalesce(h.offering_id, s.offering_id) AS offering_id, coalesce(h.sku, s.sku) AS sku, CAST(coalesce(now, 2) AS BIGINT) AS availability
FROM (SELECT * FROM h WHERE offering_id IN (SELECT offering_id FROM s)) AS h FULL JOIN s ON h.offering_id = s.offering_id AND h.sku = s.sku WHERE was IS NULL OR was <> coalesce(now, 2)"""))
def variant_cdc(spark, sf_dir):
    """STR-13, JOI-28, DOC-09."""
    o = domain.offering_options(spark, sf_dir).withColumn("sku", F.concat("color", "size"))
    history = o.filter("offering_id % 3 <> 0").select("offering_id", "sku", F.lit(0).alias("observed_at"), F.col("in_stock").alias("availability"))
    scan = o.filter("(offering_id % 5 <> 0 AND size <> '3') OR offering_id % 3 = 0").select("offering_id", "sku", F.when(F.col("offering_id") % 2 == 0, F.col("in_stock")).otherwise(1).cast("long").alias("availability"))
    return monitor.availability_delta(history, scan, scan, ["offering_id", "sku"]).withColumn("availability", F.col("availability").cast("long"))


@query("""
WITH old AS (SELECT l_partkey AS k, max(l_extendedprice) AS p FROM lineitem WHERE l_suppkey % 3 <> 1 GROUP BY 1), new AS (SELECT l_partkey AS k, max(l_extendedprice) AS p FROM lineitem WHERE l_suppkey % 3 <> 2 GROUP BY 1)
SELECT coalesce(old.k, new.k) AS item_id, CASE WHEN old.k IS NULL THEN 'new' WHEN new.k IS NULL THEN 'gone' WHEN old.p <> new.p THEN 'changed' ELSE 'same' END AS change, new.p AS price FROM old FULL JOIN new ON old.k = new.k""")
def seller_scan_diff(spark, sf_dir):
    """JOI-28, SET-03: two scans that miss some sellers each, and together none."""
    l = domain.read(spark, sf_dir, "lineitem")
    top = lambda p: l.filter(p).groupBy(F.col("l_partkey").alias("item_id")).agg(F.max("l_extendedprice").alias("price"))
    return relational.full_diff(top("l_suppkey % 3 <> 1"), top("l_suppkey % 3 <> 2"), ["item_id"], ["price"])


@query("""
SELECT user_id, min(ts) AS opened_at FROM (SELECT user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n FROM events WHERE event_type = 'error') AS x WHERE n >= 3 GROUP BY user_id""")
def circuit_breaker(spark, sf_dir):
    """STR-14."""
    return monitor.breaker(domain.read(spark, sf_dir, "events").filter("event_type = 'error'"), "user_id", "ts", 86400, 3)


@query("""
SELECT c.event_id, p.event_id AS view_id, p.value AS view_value FROM events AS c ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') AS p ON c.user_id = p.user_id AND c.ts >= p.ts WHERE c.event_type = 'click'""")
def as_of_view(spark, sf_dir):
    """DOC-06, DOC-10: the latest view of a user at or before each click."""
    e = domain.read(spark, sf_dir, "events")
    clicks = e.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    views = e.filter("event_type = 'view'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return relational.as_of_join(clicks, views, "user_id", "ts", "at", ["view_id", "view_value"]).select("event_id", "view_id", "view_value")


@query("""
WITH k AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type, value FROM events)
SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS k_sum, round(sum(CASE WHEN event_type = 'error' THEN 0 ELSE value END), 4) AS value_sum FROM k GROUP BY event_type""")
def json_props_rollup(spark, sf_dir):
    """JSN-04, AGG-07, SRC-13."""
    e = domain.read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("long"))
    return e.groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("k_sum"), F.round(F.sum(F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value"))), 4).alias("value_sum"))


@query("""
WITH st AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 40), o AS (SELECT user_id, max(ts) AS last_at, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY user_id)
SELECT user_id, last_at, n, CASE WHEN n >= 20 THEN 'WARM' ELSE 'COLD' END AS tier FROM o WHERE user_id NOT IN (SELECT user_id FROM st)""")
def seed_backfill(spark, sf_dir):
    """STR-09, JOI-10: state rows for keys that have observations but no state yet."""
    e = domain.read(spark, sf_dir, "events")
    seen = e.filter("event_type IN ('view', 'click')").groupBy("user_id").agg(F.max("ts").alias("last_at"), F.count("*").alias("n"))
    missing = seen.join(e.filter("event_type = 'purchase' AND value > 40").select("user_id").distinct(), "user_id", "left_anti")
    return missing.withColumn("tier", F.when(F.col("n") >= 20, "WARM").otherwise("COLD"))
