"""Queries of joins, filters, aggregates, sets and reports over the domain views and star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane.operators import filters, lookups, relational, resolve
from marketlane.plans import query
from marketlane.sources import domain
from marketlane.sources.domain import AS_OF, read, sql_over


@query(sql_over("listings offerings", "SELECT listing_id, price FROM listings AS l WHERE EXISTS (SELECT 1 FROM offerings AS o WHERE o.listing_id = l.listing_id AND o.is_published = 1 AND o.is_active = 1)"))
def registered_semi(spark, sf_dir):
    """FLT-16 as EXISTS, JOI-07, JOI-08, SRC-07, SET-04."""
    return domain.listings(spark, sf_dir).join(domain.offerings(spark, sf_dir).filter("is_published = 1 AND is_active = 1"), "listing_id", "left_semi").select("listing_id", "price")


@query(sql_over("listings offerings", "SELECT DISTINCT l.listing_id, price FROM offerings AS o JOIN listings AS l ON o.listing_id = l.listing_id WHERE o.is_published = 1 AND o.is_active = 1"))
def registered_join(spark, sf_dir):
    """FLT-16 as a join from the offers: the same rows as ``registered_semi``."""
    ids = domain.offerings(spark, sf_dir).filter("is_published = 1 AND is_active = 1").select("listing_id").distinct()
    return ids.join(domain.listings(spark, sf_dir), "listing_id").select("listing_id", "price")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def orphans(spark, sf_dir):
    """JOI-09, JOI-10, JOI-29: customers without a large order."""
    big = read(spark, sf_dir, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(big, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT DISTINCT l_partkey AS part FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)")
def ghosts(spark, sf_dir):
    """JOI-29, SET-02: external keys without an internal row."""
    seen = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part")).distinct()
    return seen.join(read(spark, sf_dir, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("part")), "part", "left_anti")


@query("""
SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount >= 0.1) OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50 AND l_returnflag = 'A') OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_tax = 0 AND l_linenumber = 7)""")
def any_of_three(spark, sf_dir):
    """JOI-11: a disjunction of EXISTS as one aggregate over the other table and one semi join."""
    l = read(spark, sf_dir, "lineitem")
    hit = l.filter("l_discount >= 0.1 OR (l_quantity >= 50 AND l_returnflag = 'A') OR (l_tax = 0 AND l_linenumber = 7)")
    return read(spark, sf_dir, "part").select("p_partkey").join(hit.select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi")


@query("SELECT p_partkey, arg_min(l_shipdate, struct_pack(a := l_linenumber, b := l_shipdate, c := l_orderkey)) AS first_ship FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey")
def first_image_groupwise_min(spark, sf_dir):
    """JOI-14, JOI-13: the row of the smallest place per key, without a self join."""
    l = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min_by("l_shipdate", F.struct("l_linenumber", "l_shipdate", "l_orderkey")).alias("first_ship"))
    return read(spark, sf_dir, "part").select("p_partkey").join(l, "p_partkey")


@query("SELECT n_name, r_name, count(c_custkey) AS n, count(DISTINCT c_mktsegment) AS segments, round(coalesce(sum(o_total), 0), 2) AS total FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 0 LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS o_total FROM orders GROUP BY o_custkey) AS o ON o_custkey = c_custkey GROUP BY n_name, r_name")
def multi_hop(spark, sf_dir):
    """JOI-03, JOI-06, JOI-15, AGG-01."""
    totals = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("o_total"))
    c = read(spark, sf_dir, "customer").filter("c_acctbal > 0").join(totals, "c_custkey", "left")
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.join(c, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name", "r_name").agg(F.count("c_custkey").alias("n"), F.countDistinct("c_mktsegment").alias("segments"), F.round(F.coalesce(F.sum("o_total"), F.lit(0.0)), 2).alias("total"))


@query("SELECT l.l_partkey AS part, count(*) AS n FROM lineitem AS l JOIN part AS p ON trim(CAST(l.l_partkey AS VARCHAR)) = trim(' ' || CAST(p.p_partkey AS VARCHAR) || ' ') WHERE p.p_size > 40 GROUP BY 1")
def expression_keys(spark, sf_dir):
    """JOI-04, JOI-16: keys that are text on one side."""
    p = read(spark, sf_dir, "part").filter("p_size > 40").select(F.trim(F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" "))).try_cast("bigint").alias("part"))
    return p.join(read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part")), "part").groupBy("part").agg(F.count("*").alias("n"))


@query(sql_over("market_items", "SELECT model_no, count(DISTINCT seller_id) AS sellers FROM market_items WHERE status = 'ACTIVE' GROUP BY model_no HAVING count(DISTINCT seller_id) >= 2"))
def contested_models(spark, sf_dir):
    """AGG-03, AGG-05."""
    return domain.market_items(spark, sf_dir).filter("status = 'ACTIVE'").groupBy("model_no").agg(F.countDistinct("seller_id").alias("sellers")).filter("sellers >= 2")


@query(sql_over("offerings", """
SELECT listing_id, string_agg(DISTINCT source_site, ',' ORDER BY source_site) AS sites, count(*) FILTER (WHERE is_active = 0) AS n_out, bool_or(is_active = 1) AS any_in, bool_and(is_active = 1) AS all_in, min(purchase_price) FILTER (WHERE is_active = 1) AS cheapest,
       CASE WHEN bool_or(is_published = 1 AND is_active = 1) THEN 'on_sale' WHEN bool_and(is_active = 0) THEN 'sold_out' ELSE 'waiting' END AS status, max(source_site) AS any_site FROM offerings GROUP BY listing_id"""))
def group_status(spark, sf_dir):
    """AGG-06, AGG-09, AGG-10, AGG-26, AGG-27, AGG-42."""
    on = F.col("is_active") == 1
    g = domain.offerings(spark, sf_dir).groupBy("listing_id")
    return g.agg(
        F.array_join(F.array_sort(F.collect_set("source_site")), ",").alias("sites"),
        F.count_if(~on).alias("n_out"),
        F.bool_or(on).alias("any_in"),
        F.bool_and(on).alias("all_in"),
        F.min(F.when(on, F.col("purchase_price"))).alias("cheapest"),
        F.when(F.bool_or(on & (F.col("is_published") == 1)), "on_sale").when(F.bool_and(~on), "sold_out").otherwise("waiting").alias("status"),
        F.max("source_site").alias("any_site"),
    )


@query("""
WITH c AS (SELECT l_suppkey, l_shipdate, count(*) AS n FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_shipdate) AS i FROM c)
SELECT l_suppkey, l_shipdate, n FROM r WHERE i = 1""")
def mode_with_ties(spark, sf_dir):
    """AGG-28."""
    c = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_shipdate").agg(F.count("*").alias("n"))
    return relational.first_by(c, ["l_suppkey"], [-F.col("n"), F.col("l_shipdate")])


@query(sql_over("market_items", """
SELECT model_no, count(*) AS n, min(current_price) AS floor_price, min(r) FILTER (WHERE seller_id % 10 = 0) AS our_rank, arg_min(item_id, r) AS top_item, arg_min(seller_id, r) AS top_seller, min(current_price) AS top_price,
       coalesce(string_agg(CAST(r AS VARCHAR), ' ' ORDER BY r) FILTER (WHERE seller_id % 10 = 0), '') AS our_ranks, coalesce(bool_or(r = 1 AND seller_id % 10 = 0), false) AS is_ours
FROM (SELECT *, row_number() OVER (PARTITION BY model_no ORDER BY current_price, item_id) AS r FROM market_items) AS x GROUP BY model_no"""))
def market_rank_aggregate(spark, sf_dir):
    """AGG-30, AGG-31: each model's offers by price: how many, the first one, and all places that are ours."""
    return lookups.search_results(domain.market_items(spark, sf_dir), "model_no", F.col("seller_id") % 10 == 0)


@query("""
WITH a AS (SELECT l_partkey AS k, count(*) AS n, sum(l_extendedprice) AS s FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem) AS d GROUP BY 1),
b AS (SELECT l_partkey AS k, count(*) AS n, sum(l_extendedprice) AS s FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_returnflag <> 'R' OR l_orderkey % 5 <> 0) AS d GROUP BY 1)
SELECT count(*) AS n_keys, count(*) FILTER (WHERE a.n = b.n AND abs(a.s - b.s) < 0.005) AS exact, count(*) FILTER (WHERE a.n <> b.n) AS counts_differ, count(*) FILTER (WHERE a.k IS NULL) AS only_b, count(*) FILTER (WHERE b.k IS NULL) AS only_a, round(sum(coalesce(b.s, 0)) - sum(coalesce(a.s, 0)), 2) AS gap
FROM a FULL JOIN b ON a.k = b.k""")
def orders_reconciliation(spark, sf_dir):
    """The totals of AGG-41: all lines against those that aren't returned, or are of most orders; each line is in one side at least."""
    l = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag")
    lines = l.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    roll = lambda d, s: d.distinct().groupBy(F.col("l_partkey").alias("k")).agg(F.count("*").alias(f"n{s}"), F.sum("l_extendedprice").alias(f"s{s}"))
    a, b = roll(lines, "a"), roll(l.filter("l_returnflag <> 'R' OR l_orderkey % 5 <> 0").drop("l_returnflag"), "b")
    j = a.join(b, "k", "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return j.agg(F.count("*").alias("n_keys"), F.count_if((F.col("na") == F.col("nb")) & (F.abs(F.col("sa") - F.col("sb")) < 0.005)).alias("exact"), F.count_if(F.col("na") != F.col("nb")).alias("counts_differ"), F.count_if(F.col("na").isNull()).alias("only_b"), F.count_if(F.col("nb").isNull()).alias("only_a"), F.round(F.sum(zero("sb")) - F.sum(zero("sa")), 2).alias("gap"))


@query("SELECT part, p_size, level FROM (SELECT l_partkey AS part, p_size, CASE WHEN p_size >= 40 THEN 'a' WHEN p_size >= 20 THEN 'b' ELSE 'c' END AS level, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS i FROM part JOIN (SELECT DISTINCT l_partkey FROM lineitem) AS l ON l_partkey = p_partkey) AS x WHERE i = 1")
def most_specific_assignment(spark, sf_dir):
    """WIN-17."""
    p = read(spark, sf_dir, "part").join(read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct(), "p_partkey", "left_semi")
    best = relational.first_by(p.select("p_brand", F.col("p_partkey").alias("part"), "p_size"), ["p_brand"], [-F.col("p_size"), F.col("part")])
    return best.select("part", "p_size", F.when(F.col("p_size") >= 40, "a").when(F.col("p_size") >= 20, "b").otherwise("c").alias("level"))


@query("WITH c AS (SELECT DISTINCT lpad(CAST(l_suppkey * 100 + l_linenumber * (l_suppkey % 2) AS VARCHAR), 6, '0') AS code FROM lineitem) SELECT code FROM c WHERE code NOT IN (SELECT substr(code, 1, 4) || '00' FROM c WHERE substr(code, 5) <> '00')")
def leaf_only_codes(spark, sf_dir):
    """JOI-30: codes that are nobody's parent."""
    c = read(spark, sf_dir, "lineitem").select(F.lpad((F.col("l_suppkey") * 100 + F.col("l_linenumber") * (F.col("l_suppkey") % 2)).cast("string"), 6, "0").alias("code")).distinct()
    parents = c.filter(F.substring("code", 5, 2) != "00").select(F.concat(F.substring("code", 1, 4), F.lit("00")).alias("code"))
    return c.join(parents, "code", "left_anti")


@query("SELECT l_partkey AS k, 'a' AS tag FROM lineitem WHERE l_quantity = 50 UNION ALL SELECT l_suppkey, 'b' FROM lineitem WHERE l_quantity = 49")
def tagged_union(spark, sf_dir):
    """SET-06."""
    l = read(spark, sf_dir, "lineitem")
    return l.filter("l_quantity = 50").select(F.col("l_partkey").alias("k"), F.lit("a").alias("tag")).unionByName(l.filter("l_quantity = 49").select(F.col("l_suppkey").alias("k"), F.lit("b").alias("tag")))


@query("SELECT user_id FROM events WHERE event_type = 'view' UNION SELECT user_id FROM events WHERE event_type = 'click' EXCEPT SELECT user_id FROM events WHERE event_type = 'error' AND value > 50")
def distinct_union_less_done(spark, sf_dir):
    """SET-01, SET-02, AGG-13, AGG-14."""
    e = read(spark, sf_dir, "events")
    return e.filter("event_type IN ('view', 'click')").select("user_id").distinct().join(e.filter("event_type = 'error' AND value > 50").select("user_id"), "user_id", "left_anti")


@query("SELECT count(*) AS n, count(*) FILTER (WHERE p_size > 25) AS n_flag, round(count(*) FILTER (WHERE p_size > 25) / CAST(count(*) AS DOUBLE), 6) AS share FROM part")
def coverage_share(spark, sf_dir):
    """SET-08 (the share), NUM-13."""
    return relational.share_split(read(spark, sf_dir, "part"), F.col("p_size") > 25)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE (c_mktsegment IS NULL OR c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY')) AND upper(c_name) LIKE '%CUSTOMER#0000%' AND c_acctbal IS NOT NULL")
def null_tolerant_not_in(spark, sf_dir):
    """FLT-09, FLT-12, FLT-13, and FLT-11 for what a name contains."""
    c, s = read(spark, sf_dir, "customer"), F.col("c_mktsegment")
    return c.filter((s.isNull() | ~s.isin("HOUSEHOLD", "MACHINERY")) & F.upper("c_name").contains("CUSTOMER#0000") & F.col("c_acctbal").isNotNull()).select("c_custkey", "c_name", "c_acctbal")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND lower(o_orderpriority) LIKE '%urgent%'")
def optional_clauses(spark, sf_dir):
    """FLT-01, FLT-02."""
    return filters.search(read(spark, sf_dir, "orders"), text="URGENT", columns=("o_orderpriority",), o_orderstatus="F", o_custkey=None).select("o_orderkey", "o_totalprice")


_FILTER = '{"groups": [{"conditions": [{"field": "price", "op": "between", "value": "20000", "value2": "60000"}, {"field": "brand", "op": "contains", "value": "BRAND#1"}, {"field": "days", "op": "gt", "value": ""}]}, {"conditions": [{"field": "listed", "op": "within", "value": "30"}, {"field": "category", "op": "neq", "value": "none/none"}, {"field": "published", "op": "true"}]}, {"conditions": [{"field": "fav_day", "op": "gte", "value": 5}]}]}'


@query(sql_over("listings", f"""
SELECT listing_id FROM (SELECT *, date_diff('day', listed_on, DATE '{AS_OF}') AS d FROM listings) AS l WHERE (price BETWEEN 20000 AND 60000 AND lower(brand_name) LIKE '%brand#1%')
OR (listed_on >= DATE '{AS_OF}' - 30 AND paths <> 'none/none' AND is_published = 1) OR (CASE WHEN d = 0 THEN CAST(fav AS DOUBLE) ELSE fav / CAST(d AS DOUBLE) END >= 5)"""))
def filter_dsl_demo(spark, sf_dir):
    """FLT-03 to FLT-08, DAT-05, UDF-02."""
    l = domain.listings(spark, sf_dir).withColumn("listed_at", F.col("listed_on").cast("timestamp_ntz")).withColumn("published", F.col("is_published") == 1)
    fields = {"price": filters.column("number", "price"), "brand": filters.column("text", "brand_name"), "days": filters.column("number", "fav"), "listed": filters.column("date", "listed_at"), "category": filters.column("enum", "paths"), "published": filters.column("bool", "published"), "fav_day": filters.per_day("fav", "listed_at", f"{AS_OF} 00:00:00")}
    return l.filter(filters.compiled(filters.validated(_FILTER, fields), fields, f"{AS_OF} 00:00:00")).select("listing_id")


_MART = """,
o AS (SELECT listing_id, count(*) AS n_sources, count(*) FILTER (WHERE is_active = 1) AS n_active, min(purchase_price) FILTER (WHERE is_active = 1) AS cheapest, string_agg(DISTINCT source_site, ',' ORDER BY source_site) AS sites FROM offerings GROUP BY listing_id),
m AS (SELECT CAST(split_part(item_id, '-', 1) AS BIGINT) AS listing_id, count(*) AS n_market, min(current_price) AS market_lowest, max(fav_count) AS top_fav, CAST(sum(view_count) AS BIGINT) AS views FROM market_items GROUP BY 1),
s AS (SELECT CAST(split_part(item_id, '-', 1) AS BIGINT) AS listing_id, count(*) AS n_orders, CAST(sum(qty) AS BIGINT) AS qty, max(sale_date) AS last_sale FROM market_orders GROUP BY 1),
j AS (
  SELECT l.*, n_sources, n_active, cheapest, sites, n_market, market_lowest, top_fav, views, n_orders, qty, last_sale,
         CASE WHEN is_published = 1 THEN 'on_sale' WHEN coalesce(n_active, 0) = 0 THEN 'sold_out' WHEN market_lowest IS NULL THEN 'no_lowest' ELSE 'waiting' END AS status,
         CAST(ceil((CAST(cheapest AS DOUBLE) + 15000 - CAST(cheapest AS DOUBLE) / 11) / (9.2::DOUBLE * (1 - 0.055::DOUBLE))) AS BIGINT) AS available_lowest
  FROM listings AS l LEFT JOIN o ON l.listing_id = o.listing_id LEFT JOIN m ON l.listing_id = m.listing_id LEFT JOIN s ON l.listing_id = s.listing_id)
SELECT listing_id, brand_name, paths, category_name, price, model_no, is_published, is_active, margin_krw, sold, fav, listed_on, n_sources, n_active, cheapest, sites, n_market, market_lowest, top_fav, views, n_orders, qty, last_sale, status, available_lowest,
       round_even((CASE WHEN status = 'on_sale' THEN price ELSE market_lowest END - available_lowest) * 9.2::DOUBLE * (1 - 0.055::DOUBLE), 0) AS expected_margin FROM j"""


@query(sql_over("listings offerings market_items market_orders", _MART))
def mart_wide(spark, sf_dir):
    """PRJ-01, PRJ-02, PRJ-03, NUM-03, NUM-04, JOI-15: every side is aggregated by listing before it joins."""
    from marketlane.operators import mart

    return mart.build(domain.listings(spark, sf_dir), domain.offerings(spark, sf_dir), domain.market_items(spark, sf_dir), domain.market_orders(spark, sf_dir))


@query(sql_over("listings offerings", """,
w AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY purchase_price, offering_id) AS i FROM offerings)
(SELECT 'top' AS side, listing_id, purchase_price FROM w WHERE i = 1 ORDER BY purchase_price DESC, listing_id LIMIT 10) UNION ALL (SELECT 'bottom', listing_id, purchase_price FROM w WHERE i = 1 ORDER BY purchase_price, listing_id LIMIT 10)"""))
def top_and_bottom(spark, sf_dir):
    """SRT-05, SRT-06, SRT-07: a report of ten and ten."""
    w = resolve.winners(domain.offerings(spark, sf_dir).withColumns({"eligible": F.lit(True), "margin_amount": F.lit(0.0)})).select("listing_id", "purchase_price")
    top = w.orderBy(F.desc("purchase_price"), "listing_id").limit(10).withColumn("side", F.lit("top"))
    return top.unionByName(w.orderBy("purchase_price", "listing_id").limit(10).withColumn("side", F.lit("bottom"))).select("side", "listing_id", "purchase_price")


@query(sql_over("listings", """,
w AS (SELECT listing_id, margin_krw, row_number() OVER (ORDER BY margin_krw, listing_id) AS i FROM listings WHERE is_published = 1 AND is_active = 1),
n AS (SELECT listing_id, margin_krw, row_number() OVER (ORDER BY margin_krw DESC, listing_id) AS i FROM listings WHERE is_published = 0 AND is_active = 1)
SELECT w.listing_id AS out_id, n.listing_id AS in_id, n.margin_krw - w.margin_krw AS gain FROM w JOIN n ON w.i = n.i WHERE w.i <= 50 AND n.margin_krw - w.margin_krw > 100"""))
def swap_pairs(spark, sf_dir):
    """DOC-02 without its cooldown: the 50 weakest published against the 50 best waiting, paired by rank."""
    from pyspark.sql import Window

    l = domain.listings(spark, sf_dir).filter("is_active = 1")

    def ranked(df, order, name):
        few = df.orderBy(*order).limit(50).withColumn("i", F.row_number().over(Window.orderBy(*order)))
        return few.select("i", F.col("listing_id").alias(name), F.col("margin_krw").alias(f"m_{name}"))

    weak = ranked(l.filter("is_published = 1"), [F.asc("margin_krw"), F.asc("listing_id")], "out_id")
    good = ranked(l.filter("is_published = 0"), [F.desc("margin_krw"), F.asc("listing_id")], "in_id")
    return weak.join(good, "i").select("out_id", "in_id", (F.col("m_in_id") - F.col("m_out_id")).alias("gain")).filter("gain > 100")
