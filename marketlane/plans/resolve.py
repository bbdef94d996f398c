"""Queries of resolving and reconciling offers, and of scores by cohort."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane.functions import money
from marketlane.operators import cohorts, relational, resolve
from marketlane.plans import query
from marketlane.sources import domain
from marketlane.sources.domain import AS_OF, sql_over

_SHIP = "CAST(coalesce(nullif(shipping, 0), 15000) AS DOUBLE)"
_RAW = f"(price * 9.2::DOUBLE - price * 9.2::DOUBLE * 0.055::DOUBLE - (CAST(purchase_price AS DOUBLE) + {_SHIP}) + CAST(purchase_price AS DOUBLE) / 11)"
_MEMBERS = f""",
members AS (
  SELECT o.*, l.price, CASE WHEN price > 0 AND purchase_price > 0 THEN round_even({_RAW}, 0) END AS margin_amount,
         CASE WHEN price > 0 AND purchase_price > 0 THEN round_even({_RAW} * 100 / (price * 9.2::DOUBLE), 2) END AS margin_percent
  FROM offerings AS o JOIN listings AS l ON o.listing_id = l.listing_id WHERE o.is_active = 1),
eligible AS (SELECT * FROM members WHERE margin_amount > 0),
winner AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY purchase_price, offering_id) AS nth FROM eligible) AS x WHERE nth = 1)"""
_UNION = _MEMBERS + """,
in_stock AS (
  SELECT e.listing_id, color, size, e.offering_id, purchase_price, row_number() OVER (PARTITION BY e.listing_id, color, size ORDER BY purchase_price, e.offering_id) AS nth
  FROM eligible AS e JOIN offering_options AS o ON e.offering_id = o.offering_id WHERE o.in_stock = 1),
option_rows AS (SELECT listing_id, color, size, offering_id, purchase_price FROM in_stock WHERE nth = 1)"""


def _members(spark, sf_dir):
    return resolve.member_margins(domain.listings(spark, sf_dir), domain.offerings(spark, sf_dir))


@query(sql_over("listings offerings", _MEMBERS + " SELECT listing_id, offering_id, margin_amount, margin_percent, coalesce(margin_amount > 0, false) AS eligible FROM members"))
def margin_by_member(spark, sf_dir):
    """NUM-01, NUM-12, JOI-01, JOI-32."""
    return _members(spark, sf_dir).select("listing_id", "offering_id", "margin_amount", "margin_percent", "eligible")


@query(sql_over("listings offerings", _MEMBERS + " SELECT listing_id, offering_id, source_site, purchase_price, margin_amount FROM winner"))
def winner_by_listing(spark, sf_dir):
    """WIN-08."""
    return resolve.winners(_members(spark, sf_dir))


@query(sql_over("listings offerings offering_options", _UNION + " SELECT * FROM option_rows"))
def option_union(spark, sf_dir):
    """WIN-09, AGG-27."""
    return resolve.option_union(_members(spark, sf_dir), domain.offering_options(spark, sf_dir))


@query(sql_over("listings offerings offering_options", _UNION + """,
pairs AS (SELECT a.listing_id, a.color, b.size FROM (SELECT DISTINCT listing_id, color FROM option_rows) AS a JOIN (SELECT DISTINCT listing_id, size FROM option_rows) AS b ON a.listing_id = b.listing_id)
SELECT p.*, CASE WHEN o.listing_id IS NULL THEN 0 ELSE 1 END AS in_stock FROM pairs AS p LEFT JOIN option_rows AS o ON p.listing_id = o.listing_id AND p.color = o.color AND p.size = o.size"""))
def grid_completion(spark, sf_dir):
    """JOI-27."""
    return resolve.completed_grid(option_union(spark, sf_dir))


def _competitors(spark, sf_dir):
    items = domain.market_items(spark, sf_dir)
    return items.filter("status = 'ACTIVE'").groupBy(F.split("item_id", "-")[0].cast("long").alias("listing_id")).agg(F.min("current_price").alias("lowest"))


_LOWEST = "lowest AS (SELECT CAST(split_part(item_id, '-', 1) AS BIGINT) AS listing_id, min(current_price) AS lowest FROM market_items WHERE status = 'ACTIVE' GROUP BY 1)"


@query(sql_over("listings offerings market_items", _MEMBERS + f""", {_LOWEST},
cheap AS (
  SELECT listing_id, purchase_price, shipping, row_number() OVER (PARTITION BY listing_id ORDER BY purchase_price, offering_id) AS nth, max(coalesce(margin_amount > 0, false)) OVER (PARTITION BY listing_id) AS any_margin
  FROM members WHERE purchase_price > 0),
j AS (
  SELECT l.listing_id, l.price, w.lowest, c.purchase_price, c.any_margin,
         CASE WHEN c.listing_id IS NULL THEN 'no_price' WHEN w.lowest IS NOT NULL AND NOT c.any_margin THEN 'no_margin' ELSE 'priced' END AS outcome,
         CASE WHEN w.lowest IS NOT NULL THEN CASE WHEN l.price BETWEEN w.lowest - 9 AND w.lowest - 1 THEN l.price ELSE w.lowest - (CAST('0x' || substr(md5('1|' || l.listing_id), 1, 8) AS BIGINT) % 9 + 1) END
              ELSE CAST(trunc((CAST(c.purchase_price AS DOUBLE) + {_SHIP} - CAST(c.purchase_price AS DOUBLE) / 11) / (1 - 0.055::DOUBLE - 0.30::DOUBLE) / 9.2::DOUBLE) AS BIGINT) END AS p
  FROM listings AS l LEFT JOIN cheap AS c ON l.listing_id = c.listing_id AND c.nth = 1 LEFT JOIN lowest AS w ON l.listing_id = w.listing_id)
SELECT listing_id, outcome, CASE WHEN outcome = 'priced' THEN p END AS price FROM j"""))
def final_prices(spark, sf_dir):
    """NUM-02, NUM-09, JOI-15."""
    return resolve.final_prices(domain.listings(spark, sf_dir), _members(spark, sf_dir), _competitors(spark, sf_dir))


_PUBLISHED = _MEMBERS + """,
published AS (
  SELECT o.listing_id, count(DISTINCT CASE WHEN o.is_published = 1 THEN o.offering_id END) AS n_published, coalesce(max(o.is_published = 1 AND o.offering_id = w.offering_id), false) AS has
  FROM offerings AS o LEFT JOIN winner AS w ON o.listing_id = w.listing_id GROUP BY o.listing_id),
mode_rows AS (SELECT listing_id, n_published, CASE WHEN n_published = 0 THEN 'create' WHEN n_published >= 2 THEN 'collapse' WHEN has THEN 'edit' ELSE 'edit_sourcing' END AS mode FROM published)"""


@query(sql_over("listings offerings", _PUBLISHED + " SELECT * FROM mode_rows"))
def reconcile_modes(spark, sf_dir):
    """AGG-04, JOI-05, AGG-36."""
    members = _members(spark, sf_dir)
    return resolve.modes(domain.listings(spark, sf_dir), domain.offerings(spark, sf_dir), resolve.winners(members))


@query(sql_over("listings offerings", _PUBLISHED + " SELECT mode, count(*) AS n FROM mode_rows GROUP BY mode"))
def reconcile_mode_counts(spark, sf_dir):
    """AGG-36, AGG-32."""
    return reconcile_modes(spark, sf_dir).groupBy("mode").agg(F.count("*").alias("n"))


@query(sql_over("listings offerings", """
SELECT listing_id, offering_id FROM (
  SELECT listing_id, offering_id, row_number() OVER (PARTITION BY listing_id ORDER BY is_published DESC, is_active DESC, coalesce(shipping, 0) DESC, purchase_price DESC, offering_id) AS nth FROM offerings) AS x WHERE nth = 1"""))
def collapse_keeper(spark, sf_dir):
    """WIN-10, WIN-20, WIN-02."""
    return resolve.keepers(domain.offerings(spark, sf_dir), "listing_id", ["is_published", "is_active", "shipping", "purchase_price"], "offering_id").select("listing_id", "offering_id")


@query(sql_over("offerings", """,
firsts AS (SELECT listing_id, source_site, min(purchase_price) AS p FROM offerings GROUP BY listing_id, source_site),
numbered AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY p, source_site) AS nth FROM firsts)
SELECT listing_id, string_agg(source_site, ',' ORDER BY nth) AS shops FROM numbered WHERE nth <= 15 GROUP BY listing_id"""))
def shop_list_top15(spark, sf_dir):
    """AGG-29, WIN-14."""
    return resolve.ordered_union(domain.offerings(spark, sf_dir), "listing_id", "source_site", [F.col("purchase_price")], 15).select("listing_id", F.array_join("values", ",").alias("shops"))


@query(sql_over("offerings", """,
numbered AS (SELECT listing_id, sum(length(source_site || CAST(offering_id AS VARCHAR))) OVER (PARTITION BY listing_id ORDER BY purchase_price, offering_id ROWS UNBOUNDED PRECEDING) AS used FROM offerings)
SELECT listing_id, count(*) FILTER (WHERE used <= 40) AS n_kept, count(*) FILTER (WHERE used > 40) AS n_over, CAST(coalesce(max(used) FILTER (WHERE used <= 40), 0) AS BIGINT) AS used FROM numbered GROUP BY listing_id"""))
def prefix_within_budget(spark, sf_dir):
    """WIN-27."""
    size = F.length(F.concat("source_site", F.col("offering_id").cast("string"))).cast("long")
    return relational.prefix_within(domain.offerings(spark, sf_dir), ["listing_id"], [F.col("purchase_price"), F.col("offering_id")], size, 40)


@query(sql_over("listings offerings", f"""
SELECT offering_id, CAST(trunc((CAST(purchase_price AS DOUBLE) + {_SHIP} - CAST(purchase_price AS DOUBLE) / 11) / (1 - 0.055::DOUBLE - 0.30::DOUBLE) / 9.2::DOUBLE) AS BIGINT) AS target,
       CAST(ceil((CAST(purchase_price AS DOUBLE) + {_SHIP} - CAST(purchase_price AS DOUBLE) / 11) / (9.2::DOUBLE * (1 - 0.055::DOUBLE))) AS BIGINT) AS break_even,
       CAST(floor((trunc(purchase_price * 0.11::DOUBLE) + 50) / 100) * 100 AS BIGINT) AS reference FROM offerings"""))
def price_rules(spark, sf_dir):
    """NUM-02, NUM-03, NUM-05."""
    o = domain.offerings(spark, sf_dir)
    p, s = F.col("purchase_price"), F.col("shipping")
    return o.select("offering_id", money.target_price(p, s).alias("target"), money.break_even(p, s).alias("break_even"), money.reference_price(p).alias("reference"))


_COHORT = f""",
listed AS (
  SELECT *, upper(trim(split_part(brand_name, '(', 1))) AS brand, paths AS category, sold / CAST(greatest(1, date_diff('day', listed_on, DATE '{AS_OF}')) AS DOUBLE) AS signal FROM listings),
cube_rows AS (SELECT brand, category, grouping(brand, category) AS gid, count(*) AS n, avg(signal) AS a FROM listed GROUP BY CUBE (brand, category)),
g AS (SELECT a AS g FROM cube_rows WHERE gid = 3),
priors AS (
  SELECT CASE c.gid WHEN 0 THEN 'bc' WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE 'global' END AS level, c.brand, c.category, c.n, c.a AS avg,
         CASE WHEN c.gid = 3 THEN CASE WHEN c.a > 0 THEN c.a ELSE 0.001 END ELSE (c.n * c.a + 20 * CASE WHEN c.gid = 0 THEN coalesce(b.a, g.g) ELSE g.g END) / (c.n + 20) END AS prior
  FROM cube_rows AS c CROSS JOIN g LEFT JOIN cube_rows AS b ON b.gid = 1 AND b.brand = c.brand)"""


def _listed(spark, sf_dir):
    l = domain.listings(spark, sf_dir)
    return l.withColumn("brand", F.upper(F.trim(F.substring_index("brand_name", "(", 1)))).withColumn("category", F.col("paths"))


@query(sql_over("listings", _COHORT + " SELECT level, brand, category, n, round(avg, 9) AS avg, round(prior, 9) AS prior FROM priors"))
def cohort_priors(spark, sf_dir):
    """AGG-17, AGG-18, DAT-04."""
    return cohorts.cohort_priors(_listed(spark, sf_dir), AS_OF).select("level", "brand", "category", "n", F.round("avg", 9).alias("avg"), F.round("prior", 9).alias("prior"))


@query(sql_over("listings", _COHORT + """
SELECT l.listing_id, CASE WHEN bc.prior IS NOT NULL THEN 'bc' WHEN b.prior IS NOT NULL THEN 'b' WHEN c.prior IS NOT NULL THEN 'c' ELSE 'global' END AS level,
       round(coalesce(bc.prior, b.prior, c.prior, gl.prior), 9) AS prior, round(coalesce(bc.prior, b.prior, c.prior, gl.prior) * l.margin_krw, 4) AS score
FROM listed AS l LEFT JOIN priors AS bc ON bc.level = 'bc' AND bc.brand = l.brand AND bc.category = l.category AND bc.n >= 5
LEFT JOIN priors AS b ON b.level = 'b' AND b.brand = l.brand AND b.n >= 10 LEFT JOIN priors AS c ON c.level = 'c' AND c.category = l.category AND c.n >= 10
JOIN priors AS gl ON gl.level = 'global' WHERE l.margin_krw > 0"""))
def waiting_score(spark, sf_dir):
    """AGG-19, JOI-17."""
    l = _listed(spark, sf_dir)
    out = cohorts.waiting_scores(l, cohorts.cohort_priors(l, AS_OF))
    return out.select("listing_id", "level", F.round("prior", 9).alias("prior"), "score")


_MULT = _COHORT + """,
total AS (SELECT avg(CAST(sold > 0 AS DOUBLE)) AS g FROM listed),
mult AS (SELECT brand, count(*) AS n, count(*) FILTER (WHERE sold > 0) AS sold_n, (count(*) FILTER (WHERE sold > 0) + 20 * max(t.g)) / (count(*) + 20) / max(t.g) AS mult FROM listed CROSS JOIN total AS t GROUP BY brand)"""


@query(sql_over("listings", _MULT + " SELECT brand, n, sold_n, round(mult, 9) AS mult FROM mult"))
def cohort_multiplier(spark, sf_dir):
    """AGG-20."""
    return cohorts.cohort_multipliers(_listed(spark, sf_dir), "brand").withColumn("mult", F.round("mult", 9))


@query(sql_over("listings market_orders", _MULT + f""",
raw AS (
  SELECT listing_id, margin_krw * CASE WHEN fav <= 0 THEN 0.5::DOUBLE WHEN fav <= 5 THEN 1.0 WHEN fav <= 10 THEN 1.5 WHEN fav <= 15 THEN 2.0 ELSE 3.0 END
         * CASE WHEN price <= 10000 THEN 1.3::DOUBLE WHEN price <= 30000 THEN 1.1 WHEN price <= 80000 THEN 1.0 ELSE 0.8 END * m.mult AS raw
  FROM listed AS l JOIN mult AS m ON l.brand = m.brand WHERE margin_krw > 0 AND price > 0),
actual AS (SELECT coalesce(sum(qty), 0) * 100.0 / 30 AS a FROM market_orders WHERE sale_date >= strftime(DATE '{AS_OF}' - 30, '%Y/%m/%d'))
SELECT listing_id, round(raw, 4) AS raw, round(raw * (SELECT a FROM actual) / (SELECT sum(raw) FROM raw), 4) AS score FROM raw"""))
def listed_score_anchored(spark, sf_dir):
    """AGG-08, AGG-21, NUM-07: all scores add up to the actual daily total."""
    from marketlane.functions import dates

    orders = domain.market_orders(spark, sf_dir).filter(F.col("sale_date") >= dates.cutoff(AS_OF, 30))
    actual = orders.agg((F.coalesce(F.sum("qty"), F.lit(0)) * 100.0 / 30).alias("actual"))
    return cohorts.listed_scores(_listed(spark, sf_dir), "brand", actual).select("listing_id", F.round("raw", 4).alias("raw"), F.round("score", 4).alias("score"))


@query(sql_over("market_items", """,
v AS (SELECT view_count AS x FROM market_items), n AS (SELECT count(*) AS n FROM v), o AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS i FROM v)
SELECT max(x) FILTER (WHERE i = least(floor(0.5::DOUBLE * n), n - 1)) AS p50, max(x) FILTER (WHERE i = least(floor(0.9::DOUBLE * n), n - 1)) AS p90, max(x) FILTER (WHERE i = least(floor(0.99::DOUBLE * n), n - 1)) AS p99 FROM o, n"""))
def nearest_rank_percentiles(spark, sf_dir):
    """AGG-22."""
    return cohorts.nearest_rank(domain.market_items(spark, sf_dir), "view_count", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


@query(sql_over("market_items", """
SELECT status, count(*) AS n, round(avg(view_count), 6) AS mean, max(view_count) AS top, round(quantile_cont(view_count, 0.5), 6) AS p50, round(quantile_cont(view_count, 0.75), 6) AS p75,
       round(quantile_cont(view_count, 0.9), 6) AS p90, round(quantile_cont(view_count, 0.99), 6) AS p99, round(quantile_cont(view_count, 0.999), 6) AS p999 FROM market_items GROUP BY status"""))
def popularity_percentiles(spark, sf_dir):
    """AGG-11, AGG-23, AGG-25."""
    v = F.col("view_count")
    p = lambda q: F.round(F.percentile(v, F.lit(q)), 6)
    return domain.market_items(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"), F.round(F.avg(v), 6).alias("mean"), F.max(v).alias("top"), p(0.5).alias("p50"), p(0.75).alias("p75"), p(0.9).alias("p90"), p(0.99).alias("p99"), p(0.999).alias("p999"))


@query(sql_over("market_items", """,
t(threshold) AS (VALUES (0), (5), (10), (15)), base AS (SELECT avg(CAST(status = 'SOLD_OUT' AS DOUBLE)) AS b FROM market_items)
SELECT threshold, count(*) AS n, count(*) FILTER (WHERE status = 'SOLD_OUT') AS sold, round(avg(CAST(status = 'SOLD_OUT' AS DOUBLE)), 6) AS rate, round(avg(CAST(status = 'SOLD_OUT' AS DOUBLE)) / max(b), 6) AS lift
FROM market_items JOIN t ON fav_count >= threshold CROSS JOIN base GROUP BY threshold"""))
def lift_table(spark, sf_dir):
    """AGG-24: one pass over the items; each is counted for the highest threshold it reaches, then added up downwards."""
    from pyspark.sql import Window

    steps = [0, 5, 10, 15]
    fav, sold = F.col("fav_count"), (F.col("status") == "SOLD_OUT").cast("long")
    reached = F.array_max(F.filter(F.array(*map(F.lit, steps)), lambda t: t <= fav))
    by = domain.market_items(spark, sf_dir).groupBy(reached.alias("threshold")).agg(F.count("*").alias("n"), F.sum(sold).alias("sold"))
    down = Window.orderBy(F.col("threshold").desc())
    upto = by.filter("threshold IS NOT NULL").select("threshold", F.sum("n").over(down).alias("n"), F.sum("sold").over(down).alias("sold"))
    base = by.agg((F.sum("sold") / F.sum("n")).alias("b"))
    return upto.crossJoin(F.broadcast(base)).select("threshold", "n", "sold", F.round(F.col("sold") / F.col("n"), 6).alias("rate"), F.round(F.col("sold") / F.col("n") / F.col("b"), 6).alias("lift"))
