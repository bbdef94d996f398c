"""Streams over the event table, drained once; each has a batch twin that gives the same rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlane.operators import monitor as rules
from marketlane.plans import SQL, monitor, query
from marketlane.sources import domain
from marketlane.sources.domain import EVENTS_AS_OF, read, sql_over
from marketlane.sources.sinks import stored
from marketlane.streaming import runs, state


@query(SQL["listing_days"])
def stream_listing_days(spark, sf_dir):
    """STR-05 as a stream: the rows of ``listing_days``."""
    e = runs.file_stream(spark, f"{sf_dir}/events.parquet").filter(F.col("event_type").isin("signup", "error"))
    kinds = e.select("user_id", "ts", F.when(F.col("event_type") == "signup", "up").otherwise("down").alias("kind"))
    emitted = runs.drained(state.up_days_stream(kinds, "user_id", "ts", "kind"), "update", "up-days")
    return state.up_days_at(runs.latest_per_key(emitted, "key"), "user_id", EVENTS_AS_OF).withColumn("seconds", F.round("seconds", 3))


@query("SELECT date_trunc('day', ts) AS start, event_type AS kind, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, sf_dir):
    """Event-time windows with a watermark that covers the replay; the last update of each window counts."""
    e = runs.file_stream(spark, f"{sf_dir}/events.parquet")
    late = runs.span(spark, f"{sf_dir}/events.parquet", "ts")
    emitted = runs.drained(state.window_counts(e, "ts", "event_type", late=late), "update", "windows")
    return emitted.groupBy("start", "kind").agg(F.max_by("n", "batch").alias("n")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT user_id, arg_max(event_type, ts) AS status, max(ts) AS at, CAST(arg_max(value, ts) AS DOUBLE) AS value FROM events GROUP BY user_id")
def stream_status_merge(spark, sf_dir):
    """STR-11, SRC-25, SNK-01: every batch is merged into the table of states."""
    e = runs.file_stream(spark, f"{sf_dir}/events.parquet").select("user_id", F.col("event_type").alias("status"), F.col("ts").alias("at"), "value")
    return runs.merged(e, ["user_id"], "at", "status")


_RECORDS = sql_over("observations", monitor._TWO + """,
tiers AS (
  SELECT *, CASE WHEN fav_count >= 50 OR view_count >= 2000 THEN 'HOT' WHEN fav_count >= 10 OR view_count >= 500 THEN 'WARM' ELSE 'COLD' END AS base_tier,
         coalesce(fav_per_day >= 5, false) OR coalesce(view_per_day >= 100, false) AS surge FROM speeds),
final AS (SELECT *, CASE WHEN surge AND base_tier = 'COLD' THEN 'WARM' WHEN surge AND base_tier = 'WARM' THEN 'HOT' ELSE base_tier END AS tier FROM tiers),
counts AS (SELECT item_id, count(*) AS obs_count, max(observed_at) AS last_observed_at FROM observations GROUP BY item_id)
SELECT f.item_id, base_tier, tier, round(fav_per_day, 6) AS fav_velocity, last_observed_at, last_observed_at + INTERVAL 1 DAY * CASE tier WHEN 'HOT' THEN 1 WHEN 'WARM' THEN 4 ELSE 30 END AS next_revisit_at, obs_count
FROM final AS f JOIN counts USING (item_id)""")


@query(_RECORDS)
def observation_records(spark, sf_dir):
    """STR-07: the state record of each item: tiers, velocity, last and next visit, number of observations."""
    found = rules.records(domain.observations(spark, sf_dir), "item_id", "observed_at", "fav_count", "view_count")
    return found.withColumn("fav_velocity", F.round("fav_velocity", 6))


@query(_RECORDS)
def stream_observation_records(spark, sf_dir):
    """STR-07 as a stream: observations in three batches, not in order of time; the rows of ``observation_records``."""
    path, files = runs.scattered(domain.observations(spark, sf_dir), "event_id", f"{runs.new_path(spark, 'observations')}/in")
    step = lambda batch, known: rules.record_step(batch, known, "item_id", "observed_at", "fav_count", "view_count")
    return rules.recorded(runs.table_after(runs.file_stream(spark, path, files), step, "records", rules.RECORDS), "item_id").withColumn("fav_velocity", F.round("fav_velocity", 6))


_SCANS = """
scans AS (
  SELECT unnest([0, 1, 2])::BIGINT AS scan, offering_id, color, size, in_stock FROM offering_options),
rows AS (
  SELECT scan, offering_id AS item, color || size AS sku, CASE WHEN (offering_id + scan) % 3 = 0 THEN in_stock ELSE 1 END AS availability FROM scans
  WHERE (offering_id + scan) % 4 <> 0 AND NOT (scan = 1 AND size = '3') AND NOT (scan = 0 AND size = '5')),
first AS (SELECT item, sku, min(scan) AS since FROM rows GROUP BY 1, 2), covered AS (SELECT DISTINCT item, scan FROM rows),
steps AS (
  SELECT f.item, f.sku, c.scan, coalesce(r.availability, 2) AS availability FROM first AS f JOIN covered AS c ON c.item = f.item AND c.scan >= f.since
  LEFT JOIN rows AS r ON r.item = f.item AND r.sku = f.sku AND r.scan = c.scan)
SELECT item, sku, scan, CAST(availability AS BIGINT) AS availability FROM (SELECT *, lag(availability) OVER (PARTITION BY item, sku ORDER BY scan) AS was FROM steps) AS x WHERE was IS NULL OR was <> availability"""


def _scan(spark, sf_dir, scan):
    """A scan that misses a quarter of the items, some sizes, and finds more in stock in some."""
    o = domain.offering_options(spark, sf_dir)
    turn = F.col("offering_id") + scan
    rows = o.filter((turn % 4 != 0) & ((F.lit(scan) != 1) | (F.col("size") != "3")) & ((F.lit(scan) != 0) | (F.col("size") != "5")))
    stock = F.when(turn % 3 == 0, F.col("in_stock")).otherwise(1).cast("long")
    return rows.select(F.lit(scan).cast("long").alias("scan"), F.col("offering_id").alias("item"), F.concat("color", "size").alias("sku"), stock.alias("availability"))


@query(sql_over("offering_options", "," + _SCANS))
def variant_scans(spark, sf_dir):
    """STR-13 over three scans: the baseline, then changes, and what is gone from items that a scan covers."""
    return rules.variant_history(reduce(DataFrame.unionByName, (_scan(spark, sf_dir, k) for k in range(3))))


@query(sql_over("offering_options", "," + _SCANS.replace("\nSELECT item, sku, scan,", ",\nhistory AS (SELECT item, sku, scan,") + """),
latest AS (SELECT item, sku, arg_max(availability, scan) AS was FROM history GROUP BY 1, 2)
SELECT 'state' AS check, CAST(availability AS VARCHAR) AS value, count(*) AS n FROM history GROUP BY 2
UNION ALL SELECT 'volume', CAST(scan AS VARCHAR), count(*) FROM history GROUP BY 2
UNION ALL SELECT 'inconsistent', '', count(*) FILTER (WHERE item % 50 = 0 AND was <> 0) FROM latest"""))
def variant_checks(spark, sf_dir):
    """DOC-09: states, volume by scan, and consistency of a variants' history; the current table is off for some items."""
    history = stored(rules.variant_history(reduce(DataFrame.unionByName, (_scan(spark, sf_dir, k) for k in range(3)))), "history")
    latest = history.groupBy("item", "sku").agg(F.max_by("availability", "scan").alias("availability"))
    current = latest.withColumn("availability", F.when(F.col("item") % 50 == 0, 0).otherwise(F.col("availability")))
    return rules.history_checks(history, current)


@query(sql_over("offering_options", "," + _SCANS))
def stream_variant_scans(spark, sf_dir):
    """STR-13 as a stream that goes on from one scan to the next: the rows of ``variant_scans``."""
    base = runs.new_path(spark, "scans")
    for k in range(3):
        # A scan's files are the new ones, and so one batch.
        _scan(spark, sf_dir, k).write.mode("append").parquet(f"{base}/in")
        stream = runs.file_stream(spark, f"{base}/in", 1_000_000)
        emitted = runs.versioned(stream, rules.variant_step, base, "item long, sku string, availability long")
    return emitted.drop("batch")


@query("""
WITH crawls(crawl, since, until) AS (VALUES (0, TIMESTAMP '1900-01-01', TIMESTAMP '2001-09-05'), (1, TIMESTAMP '2001-09-05', TIMESTAMP '2001-10-05'), (2, TIMESTAMP '2001-10-05', TIMESTAMP '2001-11-05'))
SELECT l_suppkey AS seller_id, CAST(crawl AS BIGINT) AS crawl, strftime(l_shipdate, '%Y/%m/%d') AS sale_date, CAST(l_partkey AS VARCHAR) AS item_id, CAST(l_quantity AS BIGINT) AS qty, false AS over
FROM lineitem JOIN crawls ON l_shipdate >= since AND l_shipdate < until""")
def stream_watermark(spark, sf_dir):
    """STR-01, STR-02: three crawls of each seller's whole history, newest first; only rows before the known sequence are new."""
    l = read(spark, sf_dir, "lineitem")
    newest = Window.partitionBy("l_suppkey").orderBy(F.desc("l_shipdate"), "l_partkey", "l_orderkey", "l_linenumber")
    base = runs.new_path(spark, "crawls")
    for crawl in range(3):
        seen = l.filter(f"l_shipdate < TIMESTAMP_NTZ '2001-{crawl + 9:02}-05 00:00:00'")
        rows = seen.select(F.col("l_suppkey").alias("seller_id"), F.lit(crawl).cast("long").alias("crawl"), (F.row_number().over(newest) - 1).alias("place"), F.date_format("l_shipdate", "yyyy/MM/dd").alias("sale_date"), F.col("l_partkey").cast("string").alias("item_id"), F.col("l_quantity").cast("long").alias("qty"))
        # A seller's list is in one file, and so in one batch; the stream goes on from one crawl to the next.
        rows.write.mode("append").option("maxRecordsPerFile", 0).parquet(f"{base}/lists")
        emitted = runs.versioned(runs.file_stream(spark, f"{base}/lists"), lambda lists, known: rules.sequence_step(lists, known, state.WATERMARK_SIZE), base, rules.KNOWN, rules.sequence_lists)
    return emitted.drop("batch")


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_partkey, l_orderkey, l_linenumber) AS place FROM lineitem),
lists AS (
  SELECT l_suppkey AS seller_id, list(strftime(l_shipdate, '%Y/%m/%d') || ' ' || l_partkey ORDER BY place) AS rows,
         list(strftime(l_shipdate, '%Y/%m/%d') || ' ' || l_partkey ORDER BY place) FILTER (WHERE l_shipdate < TIMESTAMP '2001-06-01') AS known, count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '2001-06-01') AS newer FROM l GROUP BY 1)
SELECT seller_id, CAST(CASE WHEN seller_id % 6 <> 0 AND known IS NOT NULL THEN newer END AS INTEGER) AS boundary FROM lists""")
def sequence_boundaries(spark, sf_dir):
    """WIN-22: how many sales stand before the 30 that were known in June, as a run of signatures; null if they aren't found whole."""
    l = read(spark, sf_dir, "lineitem")
    sign = F.concat_ws(" ", F.date_format("l_shipdate", "yyyy/MM/dd"), "l_partkey")
    row = F.struct((-F.unix_micros(F.col("l_shipdate").cast("timestamp"))).alias("t"), "l_partkey", "l_orderkey", "l_linenumber", sign.alias("sign"))
    listed = lambda rows: F.transform(F.sort_array(F.collect_list(rows)), lambda x: x["sign"])
    old = F.col("l_shipdate") < F.lit("2001-06-01").cast("timestamp_ntz")
    lists = l.groupBy(F.col("l_suppkey").alias("seller_id")).agg(listed(row).alias("rows"), F.slice(listed(F.when(old, row)), 1, state.WATERMARK_SIZE).alias("known"))
    # A sixth of the sellers have lost a row of their known ones.
    lost = F.concat(F.slice("known", 1, F.greatest(F.size("known") - 1, F.lit(0))), F.array(F.lit("lost")))
    known = F.when(F.col("seller_id") % 6 == 0, lost).otherwise(F.col("known"))
    return lists.select("seller_id", "rows", known.alias("known")).select("seller_id", rules.boundary_at(F.col("rows"), F.col("known")).alias("boundary"))
