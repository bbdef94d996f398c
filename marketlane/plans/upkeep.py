"""Queries of tables that are kept up: shop lists, back-fills, rescans, gaps, scoped recomputing, sweeps and text rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane.functions import money, text
from marketlane.operators import relational, selection, upkeep
from marketlane.plans import query
from marketlane.sources import domain, sinks
from marketlane.sources.domain import AS_OF, read, sql_over

#: Order in which sources are asked.
PRIORITY = ("s3", "s1", "s6")
_RANK = "CASE source_site WHEN 's3' THEN 1 WHEN 's1' THEN 2 WHEN 's6' THEN 3 ELSE 9 END"


def _rank(site):
    out = F.when(site == PRIORITY[0], 1)
    for i, name in enumerate(PRIORITY[1:], 2):
        out = out.when(site == name, i)
    return out.otherwise(9)


@query(sql_over("offerings", f"""
SELECT listing_id, offering_id, source_site FROM offerings
QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY is_active DESC, {_RANK}, offering_id) = 1"""))
def seed_members(spark, sf_dir):
    """WIN-11: of each listing the member that is active first, then of the source that comes first, then by id."""
    rows = domain.offerings(spark, sf_dir).select("listing_id", "offering_id", "source_site", "is_active")
    first = relational.first_by(rows, ["listing_id"], [-F.col("is_active"), _rank(F.col("source_site")), F.col("offering_id")])
    return first.select("listing_id", "offering_id", "source_site")


@query(sql_over("offerings", f"""
SELECT listing_id, string_agg(offering_id, ' ' ORDER BY nth) AS images FROM (
  SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY is_published DESC, {_RANK}, offering_id) AS nth FROM offerings) AS t WHERE nth <= 20 GROUP BY listing_id"""))
def image_order(spark, sf_dir):
    """WIN-12: the winner's image first, then by source, 20 at most."""
    rows = domain.offerings(spark, sf_dir).withColumn("prio", _rank(F.col("source_site"))).select("listing_id", "offering_id", "prio", "is_published")
    kept = upkeep.winner_first(rows, "listing_id", F.col("is_published") == 1, [F.col("prio"), F.col("offering_id")], 20)
    return kept.select("listing_id", F.array_join(F.transform("rows", lambda x: x["offering_id"].cast("string")), " ").alias("images"))


@query(sql_over("offerings", """,
r AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY CASE WHEN offering_id % 10 = 4 THEN 0 ELSE 1 END, purchase_price, offering_id) AS nth, count(*) OVER (PARTITION BY listing_id) AS n
      FROM offerings WHERE is_active = 1)
SELECT listing_id, string_agg(source_site || ':' || purchase_price, ' / ' ORDER BY nth) || CASE WHEN max(n) > 15 THEN ' +' || CAST(max(n) - 15 AS VARCHAR) ELSE '' END AS shops FROM r WHERE nth <= 15 GROUP BY listing_id"""))
def shops_winner_first(spark, sf_dir):
    """WIN-16, STRF-21: active shops as one text, the winner first, then the cheapest, 15 at most and how many more there are."""
    rows = domain.offerings(spark, sf_dir).filter("is_active = 1").select("listing_id", "offering_id", "source_site", "purchase_price")
    kept = upkeep.winner_first(rows, "listing_id", F.col("offering_id") % 10 == 4, [F.col("purchase_price"), F.col("offering_id")], 15)
    shops = F.array_join(F.transform("rows", lambda x: F.concat_ws(":", x["source_site"], x["purchase_price"])), " / ")
    more = F.when(F.col("n") > 15, F.concat(F.lit(" +"), F.col("n") - 15)).otherwise("")
    return kept.select("listing_id", F.concat(shops, more).alias("shops"))


@query(sql_over("offerings", """,
states AS (SELECT l_partkey AS listing_id, l_returnflag AS color, l_linenumber AS size, CASE WHEN l_quantity <= 2 THEN 'out' WHEN l_quantity <= 45 THEN 'few' WHEN l_linestatus = 'O' THEN 'in' ELSE 'unknown' END AS state FROM lineitem)
SELECT listing_id, color, size, arg_max(state, CASE state WHEN 'in' THEN 3 WHEN 'few' THEN 2 WHEN 'out' THEN 1 ELSE 0 END) AS state FROM states GROUP BY listing_id, color, size"""))
def best_stock_states(spark, sf_dir):
    """WIN-19: of each colour and size the best state by rank."""
    q = F.col("l_quantity")
    state = F.when(q <= 2, "out").when(q <= 45, "few").when(F.col("l_linestatus") == "O", "in").otherwise("unknown")
    rank = F.when(F.col("state") == "in", 3).when(F.col("state") == "few", 2).when(F.col("state") == "out", 1).otherwise(0)
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("listing_id"), F.col("l_returnflag").alias("color"), F.col("l_linenumber").alias("size"), state.alias("state"))
    return rows.groupBy("listing_id", "color", "size").agg(F.max_by("state", rank).alias("state"))


@query("""
WITH c AS (SELECT p_type || ' > ' || p_brand AS path, 2 AS depth, p_type, p_brand, min(p_partkey) AS least FROM part GROUP BY p_type, p_brand HAVING count(*) >= 3
  UNION ALL SELECT p_type, 1, p_type, NULL, min(p_partkey) FROM part GROUP BY p_type)
SELECT p.p_partkey, arg_max(path, depth) AS category FROM part AS p JOIN c ON p.p_type = c.p_type AND (c.p_brand IS NULL OR c.p_brand = p.p_brand) GROUP BY p.p_partkey""")
def deepest_category(spark, sf_dir):
    """WIN-28: of all categories that hold a product the most specific one; those of two levels need three products."""
    part = read(spark, sf_dir, "part")
    two = part.groupBy("p_type", "p_brand").count().filter("count >= 3").select("p_type", "p_brand", F.concat_ws(" > ", "p_type", "p_brand").alias("two"))
    return part.join(two, ["p_type", "p_brand"], "left").select("p_partkey", F.coalesce("two", "p_type").alias("category"))


@query(sql_over("listings", """,
last AS (SELECT l_partkey AS listing_id, arg_max(CAST(l_suppkey AS BIGINT), row(l_shipdate, l_orderkey, l_linenumber, l_suppkey)) AS ref FROM lineitem GROUP BY 1)
SELECT l.listing_id, ref, CASE WHEN ref IS NULL THEN 'no event' WHEN ref % 4 = listing_id % 4 AND ref % 2 = sold % 2 THEN 'all agree' WHEN ref % 4 = listing_id % 4 THEN 'lock differs' WHEN ref % 2 = sold % 2 THEN 'table differs' ELSE 'event differs' END AS verdict
FROM listings AS l LEFT JOIN last USING (listing_id)"""))
def reference_check(spark, sf_dir):
    """WIN-29, WIN-04, JOI-02: the last event's reference against the current table's and the locked one."""
    lines = read(spark, sf_dir, "lineitem")
    last = lines.groupBy(F.col("l_partkey").alias("listing_id")).agg(F.max_by(F.col("l_suppkey"), F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")).alias("ref"))
    rows = domain.listings(spark, sf_dir).join(last, "listing_id", "left")
    table, lock = F.col("ref") % 4 == F.col("listing_id") % 4, F.col("ref") % 2 == F.col("sold") % 2
    verdict = F.when(F.col("ref").isNull(), "no event").when(table & lock, "all agree").when(table, "lock differs").when(lock, "table differs").otherwise("event differs")
    return rows.select("listing_id", "ref", verdict.alias("verdict"))


@query(sql_over("observations", """,
c AS (SELECT item_id, count(*) AS n, max(view_count) AS views FROM observations GROUP BY item_id)
SELECT CASE WHEN views >= 20 THEN 'HOT' WHEN views >= 5 THEN 'WARM' ELSE 'COLD' END AS tier, count(*) AS total, count(*) FILTER (WHERE n >= 2) AS multi_observed FROM c GROUP BY 1"""))
def coverage_by_tier(spark, sf_dir):
    """AGG-33: items and items observed more than once, by tier."""
    per = domain.observations(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n"), F.max("view_count").alias("views"))
    tier = F.when(F.col("views") >= 20, "HOT").when(F.col("views") >= 5, "WARM").otherwise("COLD")
    return per.groupBy(tier.alias("tier")).agg(F.count("*").alias("total"), F.count_if(F.col("n") >= 2).alias("multi_observed"))


@query(sql_over("listings", f"""
SELECT listing_id, (10 * greatest(sold, 0) + 1 * fav) / greatest(1, DATE '{AS_OF}' - listed_on) AS signal,
       (10 * greatest(sold, 0) + 1 * fav) / greatest(1, DATE '{AS_OF}' - listed_on) * margin_krw + 0.25 * margin_krw * CASE WHEN DATE '{AS_OF}' - listed_on <= 30 THEN 1 ELSE 0.5 END AS score FROM listings"""))
def additive_scores(spark, sf_dir):
    """AGG-38, DOC-05: a weighted signal by age, and signal and prior with decay, both times the margin, added up."""
    age = F.datediff(F.lit(AS_OF).cast("date"), F.col("listed_on"))
    signal = (10 * F.greatest(F.col("sold"), F.lit(0)) + F.col("fav")) / F.greatest(F.lit(1), age)
    score = signal * F.col("margin_krw") + 0.25 * F.col("margin_krw") * F.when(age <= 30, 1.0).otherwise(0.5)
    return domain.listings(spark, sf_dir).select("listing_id", signal.alias("signal"), score.alias("score"))


@query(sql_over("listings offerings", """
SELECT model_no, max(purchase_price) AS list_price, CAST(floor((trunc(max(purchase_price) * 0.11::DOUBLE) + 50) / 100) * 100 AS BIGINT) AS reference FROM listings JOIN offerings USING (listing_id) GROUP BY model_no"""))
def group_list_price(spark, sf_dir):
    """AGG-39, NUM-05: the highest list price of a group, and the rounded reference price made from it."""
    rows = domain.offerings(spark, sf_dir).join(domain.listings(spark, sf_dir).select("listing_id", "model_no"), "listing_id")
    highest = rows.groupBy("model_no").agg(F.max("purchase_price").alias("list_price"))
    return highest.withColumn("reference", money.reference_price(F.col("list_price")))


@query(sql_over("listings", """,
stored AS (SELECT listing_id, CASE WHEN listing_id % 3 = 0 THEN NULL ELSE category_name END AS category, sold FROM listings),
found AS (SELECT listing_id, upper(category_name) AS category, 999 AS sold FROM listings WHERE listing_id % 2 = 0)
SELECT s.listing_id, coalesce(s.category, f.category) AS category, coalesce(f.sold, s.sold) AS sold FROM stored AS s LEFT JOIN found AS f USING (listing_id)"""))
def category_backfill(spark, sf_dir):
    """SNK-09: a table updated from a join, in one column where it is empty, in the other wherever there is a new value."""
    rows = domain.listings(spark, sf_dir)
    stored = rows.select("listing_id", F.when(F.col("listing_id") % 3 != 0, F.col("category_name")).alias("category"), "sold")
    found = rows.filter("listing_id % 2 = 0").select("listing_id", F.upper("category_name").alias("category"), F.lit(999).cast("long").alias("sold"))
    return upkeep.updated_from(upkeep.updated_from(stored, found, "listing_id", ["category"], only_empty=True), found, "listing_id", ["sold"])


@query("""
SELECT s_suppkey AS item_id, s_name AS name, CASE WHEN s_suppkey % 3 <> 0 OR s_suppkey % 4 = 0 THEN 'first' ELSE 'second' END AS first_seen,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'DELETED' ELSE 'ACTIVE' END AS status, CASE WHEN s_suppkey % 3 <> 0 THEN 'then' END AS gone_at,
       CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN 7 WHEN s_suppkey % 3 <> 0 OR s_suppkey % 4 = 0 THEN 1 END AS views FROM supplier""")
def rescanned_items(spark, sf_dir):
    """SNK-01, SNK-02, SNK-06, SNK-07: rows seen again revive, keep when they were first seen, and change a count only to a known one.

    A supplier is in the table, in the scan, or in both.
    """
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    old = s.filter((k % 3 != 0) | (k % 4 == 0)).select(k.alias("item_id"), F.lower("s_name").alias("name"), F.lit("first").alias("first_seen"), F.lit("DELETED").alias("status"), F.lit("then").alias("gone_at"), F.lit(1).alias("views"))
    old = old.withColumn("name", F.initcap("name"))
    new = s.filter(k % 3 == 0).select(k.alias("item_id"), F.col("s_name").alias("name"), F.lit("second").alias("first_seen"), F.when(k % 2 == 0, 7).alias("views"))
    seen = upkeep.rescanned(old.drop("views"), new.drop("views"), "item_id")
    counts = relational.upsert(old.select("item_id", "views"), new.select("item_id", "views"), ["item_id"], fill=["views"])
    return seen.join(counts, "item_id")


@query(sql_over("listings", """,
stored AS (SELECT listing_id FROM listings WHERE listing_id % 3 <> 1),
t AS (SELECT listing_id, unnest(string_split(model_no, ' ')) AS raw FROM listings WHERE listing_id NOT IN (SELECT listing_id FROM stored))
SELECT DISTINCT listing_id, upper(raw) AS token FROM t WHERE length(raw) >= 4"""))
def token_gap(spark, sf_dir):
    """STR-10: tokens of the listings that have none stored yet."""
    rows = domain.listings(spark, sf_dir).select("listing_id", "model_no")
    missing = upkeep.gaps(rows, rows.filter("listing_id % 3 <> 1"), "listing_id")
    return missing.select("listing_id", F.explode(text.model_tokens(F.col("model_no"))).alias("token"))


@query(sql_over("offerings", """
SELECT listing_id, min(purchase_price) AS cheapest, count(*) AS n FROM offerings WHERE source_site <> 's2' OR listing_id % 5 <> 0 GROUP BY listing_id"""))
def scoped_recompute(spark, sf_dir):
    """JOI-35: a source goes from some listings; only these are computed anew, and the whole table is as if all were."""
    before = domain.offerings(spark, sf_dir)
    lost = (F.col("source_site") == "s2") & (F.col("listing_id") % 5 == 0)
    best = lambda d: d.groupBy("listing_id").agg(F.min("purchase_price").alias("cheapest"), F.count("*").alias("n"))
    return upkeep.recomputed(best(before), before.filter(~lost), before.filter(lost), "listing_id", best)


@query(sql_over("listings", """
SELECT model_no, '2026-08-01' AS day, CASE WHEN model_no LIKE '%7%' THEN 'failed' ELSE 'done' END AS status FROM listings GROUP BY model_no
UNION ALL SELECT model_no, '2026-08-02', 'done' FROM listings GROUP BY model_no"""))
def daily_sweep(spark, sf_dir):
    """STR-12: sweeps of two days over a state table; on the second, what failed at first is taken up by a second run."""
    rows = domain.listings(spark, sf_dir).select("model_no")
    state = rows.limit(0).select("model_no", F.lit("").alias("day"), F.lit("").alias("status"))
    half = lambda d: d.withColumn("status", F.when(F.col("model_no").like("%7%"), "failed").otherwise("done"))
    whole = lambda d: d.withColumn("status", F.lit("done"))
    for day, collect in (("2026-08-01", half), ("2026-08-02", half), ("2026-08-02", whole)):
        state = upkeep.swept(state, rows, "model_no", day, collect)
    return state


@query(sql_over("listings", """,
calls AS (
  SELECT greatest(0, CAST(ceil(count(*) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-23' AND CAST(ts AS DATE) < DATE '2024-01-30') * 1.5::DOUBLE / 7) AS BIGINT)
                     - count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '2024-01-30')) AS calls FROM events),
slots AS (SELECT greatest(0, count(*) * 9 // 20 - count(*) FILTER (WHERE is_published = 1 AND is_active = 1)) AS slots FROM listings),
best AS (SELECT listing_id, CAST(row_number() OVER (ORDER BY margin_krw DESC, listing_id) AS INTEGER) AS slot FROM listings WHERE is_published = 0 AND is_active = 1)
SELECT listing_id, slot FROM best, calls, slots WHERE slot <= least(40, slots, calls // 4)"""))
def filled_slots(spark, sf_dir):
    """DOC-01: the best waiting listings into the open slots, as far as today's calls last (4 for a listing, 40 at most)."""
    rows = domain.listings(spark, sf_dir)
    listed = F.count_if((F.col("is_published") == 1) & (F.col("is_active") == 1))
    slots = rows.agg(F.greatest(F.lit(0), F.expr("count(*) * 9 div 20") - listed).alias("slots"))
    calls = selection.calls_left(read(spark, sf_dir, "events"), "ts", "2024-01-30")
    return selection.filled(rows.filter("is_published = 0 AND is_active = 1"), "margin_krw", "listing_id", slots, calls, 4, 40)


@query(sql_over("listings", """,
tired AS (SELECT DISTINCT user_id AS listing_id FROM events WHERE event_type IN ('signup', 'purchase') AND ts <= TIMESTAMP '2024-01-31' AND ts > TIMESTAMP '2024-01-31' - INTERVAL 1 DAY),
rows AS (SELECT * FROM listings WHERE is_active = 1 AND listing_id NOT IN (SELECT listing_id FROM tired)),
w AS (SELECT listing_id, margin_krw, row_number() OVER (ORDER BY margin_krw, listing_id) AS i FROM rows WHERE is_published = 1),
n AS (SELECT listing_id, margin_krw, row_number() OVER (ORDER BY margin_krw DESC, listing_id) AS i FROM rows WHERE is_published = 0)
SELECT w.listing_id AS out_id, n.listing_id AS in_id, n.margin_krw - w.margin_krw AS gain FROM w JOIN n ON w.i = n.i WHERE w.i <= 60 AND n.margin_krw - w.margin_krw >= 4700 ORDER BY w.i LIMIT 30"""))
def rested_swaps(spark, sf_dir):
    """DOC-02: swaps of the weakest listed for the best waiting, none of which was swapped within the last day."""
    rows = domain.listings(spark, sf_dir).filter("is_active = 1")
    swaps = read(spark, sf_dir, "events").filter("event_type IN ('signup', 'purchase')").select(F.col("user_id").alias("listing_id"), "ts")
    free = selection.rested(rows, swaps, "listing_id", "ts", "2024-01-31 00:00:00", 1)
    return selection.swapped(free.filter("is_published = 1"), free.filter("is_published = 0"), "margin_krw", "listing_id", 4700, 30)


@query(sql_over("offering_options", """,
sold AS (SELECT offering_id, list_sort(list(DISTINCT size)) AS sizes FROM offering_options WHERE in_stock = 1 GROUP BY offering_id),
measured AS (SELECT offering_id, list_sort(list(DISTINCT CASE WHEN in_stock = 0 THEN size || 'L' ELSE size END)) AS sizes FROM offering_options GROUP BY offering_id),
m AS (SELECT offering_id, coalesce(s.sizes, []) AS sizes, list_filter(m.sizes, lambda x: NOT list_contains(coalesce(s.sizes, []), x)) AS extra FROM measured AS m LEFT JOIN sold AS s USING (offering_id))
SELECT offering_id, array_to_string(list_concat(sizes, extra), ' ') AS sizes, CAST(len(extra) AS INTEGER) AS added FROM m"""))
def measured_options(spark, sf_dir):
    """MAP-03: sizes that only a product's own measurements name are added to its options, out of stock."""
    size = F.col("size")
    rows = domain.offering_options(spark, sf_dir).groupBy("offering_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("in_stock") == 1, size))).alias("sold"),
        F.map_from_entries(F.array_sort(F.collect_set(F.struct(F.when(F.col("in_stock") == 0, F.concat(size, F.lit("L"))).otherwise(size).alias("size"), F.lit(40).alias("cm"))))).alias("measures"),
    )
    extra = F.array_except(F.array_sort(F.map_keys("measures")), "sold")
    return rows.select("offering_id", F.array_join(F.concat("sold", extra), " ").alias("sizes"), F.size(extra).alias("added"))


@query("""
WITH t AS (SELECT p_partkey AS i, p_name, p_brand, 'AB-' || p_partkey AS m FROM part)
SELECT i, CASE WHEN i % 2 = 0 THEN m ELSE m || ' / X' || i END AS notation, i >= 10 AS valid, i % 3 = 0 AS seasonal, p_name AS english,
       m || ' 1,' || m || '1,AB' || i || '1' AS variants, '3' || i % 10 AS option, p_name || ' ' || m AS search, i % 5 = 0 AS hangul,
       CASE WHEN i < 10 THEN 'QWERTY77' ELSE 'AB' || i || '99' END AS token FROM t""")
def text_rules(spark, sf_dir):
    """STRF-05, STRF-06, STRF-07, STRF-12, STRF-15, STRF-16, STRF-17, STRF-19, FLT-10, WIN-24."""
    i, name = F.col("p_partkey"), F.col("p_name")
    m = F.concat(F.lit("AB-"), i)
    twice = F.when(i % 2 == 0, F.concat(F.concat(F.lit("ab"), i), F.lit(" / "), m)).otherwise(F.concat(m, F.lit(" / X"), i))
    season = F.concat(m, F.when(i % 3 == 0, " FW24").otherwise(" 20F"))
    said = F.when(i % 5 == 0, F.concat(name, F.lit(" 가"))).otherwise(name)
    return read(spark, sf_dir, "part").select(
        i.alias("i"),
        text.single_notation(twice).alias("notation"),
        text.valid_model(F.concat(F.lit("BLACK "), F.when(i >= 10, F.lit("AB")).otherwise("A"), i)).alias("valid"),
        text.has_season_token(season).alias("seasonal"),
        text.english_name(F.when(i % 2 == 0, F.concat(name, F.lit(" (한글)"))).otherwise(F.concat(name, F.lit("（국문）")))).alias("english"),
        F.array_join(text.model_variants(F.concat(m, F.lit(" 1"))), ",").alias("variants"),
        text.option_value(F.concat(F.lit(" 3-"), i % 10, F.lit("インチ"))).alias("option"),
        text.search_query(F.concat(name, F.lit(" / "), m)).alias("search"),
        text.has_hangul(said).alias("hangul"),
        text.representative_token(text.model_tokens(F.concat(F.lit("free AB"), i, F.lit("99 QWERTY77 SS25")))).alias("token"),
    )


@query(sql_over("listings", """
SELECT listing_id, price, upper(category_name) AS name, CASE WHEN listing_id % 2 = 0 THEN 'append' ELSE 'snapshot' END AS step FROM listings"""))
def written_and_read(spark, sf_dir):
    """SNK-04, SNK-12, SNK-16, SRC-08: a full refresh, a part appended to it, and a report with a header read back."""
    rows = domain.listings(spark, sf_dir).select("listing_id", "price", F.upper("category_name").alias("name"))
    base = sinks.new_path(spark, "written")
    sinks.overwrite(rows, f"{base}/table")
    sinks.overwrite(rows.filter("listing_id % 2 = 1").withColumn("step", F.lit("snapshot")), f"{base}/table")
    sinks.append(rows.filter("listing_id % 2 = 0").withColumn("step", F.lit("append")), f"{base}/table")
    sinks.csv_report(spark.read.parquet(f"{base}/table"), f"{base}/report")
    return spark.read.csv(f"{base}/report", header=True, schema="listing_id long, price long, name string, step string")
