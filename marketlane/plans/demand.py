"""Queries of the demand model."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane.operators import demand
from marketlane.plans import query
from marketlane.sources import domain
from marketlane.sources.domain import AS_OF, sql_over

_BAND = "CASE WHEN {0} < 10000 THEN '<10k' WHEN {0} < 20000 THEN '10-20k' WHEN {0} < 30000 THEN '20-30k' WHEN {0} < 50000 THEN '30-50k' WHEN {0} < 80000 THEN '50-80k' WHEN {0} < 120000 THEN '80-120k' ELSE '120k+' END"
_KEYED = f""",
ord90 AS (SELECT item_id, count(*) AS ord FROM market_orders WHERE sale_date >= strftime(DATE '{AS_OF}' - 90, '%Y/%m/%d') GROUP BY item_id),
keyed AS (
  SELECT i.*, coalesce(ord, 0) AS ord, CASE WHEN status = 'ACTIVE' THEN 1 ELSE 0 END AS act, CASE WHEN status = 'ACTIVE' THEN fav_count ELSE 0 END AS fav,
         split_part(category_path, ' > ', 2) || '/' || split_part(category_path, ' > ', 3) AS cat, {_BAND.format("current_price")} AS band
  FROM market_items AS i LEFT JOIN ord90 AS o ON i.item_id = o.item_id)"""
_CELLS = _KEYED + """,
sets AS (
  SELECT brand, cat, band, grouping(brand, cat, band) AS gid, CAST(sum(act) AS BIGINT) AS n_active, CAST(sum(ord) AS BIGINT) AS ord90, CAST(sum(fav) AS BIGINT) AS fav_sum
  FROM keyed GROUP BY GROUPING SETS ((brand, cat, band), (cat, band), ())),
l4 AS (SELECT *, (ord90 + 50 * 0.0565::DOUBLE) / (n_active + 50) AS density FROM sets WHERE gid = 4),
l3 AS (SELECT s.*, (s.ord90 + 50 * p.density) / (s.n_active + 50) AS density FROM sets AS s JOIN l4 AS p ON s.cat = p.cat AND s.band = p.band WHERE s.gid = 0),
cells AS (
  SELECT 'L6' AS level, 'GLOBAL' AS cell_key, n_active, ord90, 0.0565::DOUBLE AS density, fav_sum / nullif(n_active, 0)::DOUBLE AS avg_fav FROM sets WHERE gid = 7
  UNION ALL SELECT 'L4', cat || '|' || band, n_active, ord90, density, fav_sum / nullif(n_active, 0)::DOUBLE FROM l4
  UNION ALL SELECT 'L3', brand || '|' || cat || '|' || band, n_active, ord90, density, fav_sum / nullif(n_active, 0)::DOUBLE FROM l3)"""
_CODES = """,
coded AS (
  SELECT DISTINCT k.item_id, k.brand, k.act, k.ord, k.fav, regexp_replace(upper(t.x), '[^A-Z0-9]+', '', 'g') AS code
  FROM keyed AS k, (SELECT item_id, unnest(string_split(model_no, ' ')) AS x FROM market_items) AS t WHERE t.item_id = k.item_id),
codes AS (
  SELECT code, brand AS brand_key, CAST(sum(act) AS BIGINT) AS n_active, CAST(sum(ord) AS BIGINT) AS ord90, coalesce(max(CASE WHEN act = 1 THEN fav END), 0) AS max_fav
  FROM coded WHERE length(code) >= 4 GROUP BY code, brand HAVING sum(act) > 0 OR sum(ord) > 0)"""
_SCORES = _CELLS + _CODES + f""",
l AS (
  SELECT listing_id, upper(trim(split_part(brand_name, '(', 1))) AS bk, paths || '/' || category_name AS ck, {_BAND.format("price")} AS band, model_no FROM listings),
tokens AS (SELECT DISTINCT listing_id, bk, regexp_replace(upper(x), '[^A-Z0-9]+', '', 'g') AS code FROM (SELECT listing_id, bk, unnest(string_split(model_no, ' ')) AS x FROM l) AS t),
hits AS (
  SELECT t.listing_id, c.*, row_number() OVER (PARTITION BY t.listing_id ORDER BY n_active DESC, ord90 DESC, c.code) AS nth
  FROM tokens AS t JOIN codes AS c ON t.code = c.code AND t.bk = c.brand_key WHERE length(t.code) >= 6),
joined AS (
  SELECT l.*, c3.density AS d3, c4.density AS d4, c3.cell_key AS k3, c4.cell_key AS k4, h.code, h.n_active, h.ord90, h.max_fav,
         coalesce(c3.avg_fav, c4.avg_fav) AS fav, coalesce(c3.density, c4.density, 0.0565::DOUBLE) AS parent
  FROM l LEFT JOIN cells AS c3 ON c3.level = 'L3' AND c3.cell_key = bk || '|' || ck || '|' || l.band
  LEFT JOIN cells AS c4 ON c4.level = 'L4' AND c4.cell_key = ck || '|' || l.band LEFT JOIN hits AS h ON h.listing_id = l.listing_id AND h.nth = 1),
scored AS (
  SELECT listing_id, CASE WHEN code IS NOT NULL THEN 'L1' WHEN d3 IS NOT NULL THEN 'L3' WHEN d4 IS NOT NULL THEN 'L4' ELSE 'L6' END AS d_level,
         CASE WHEN code IS NOT NULL THEN code || '|' || bk WHEN d3 IS NOT NULL THEN k3 WHEN d4 IS NOT NULL THEN k4 ELSE 'GLOBAL' END AS d_cell_key,
         CASE WHEN code IS NOT NULL THEN (ord90 + 50 * parent) / (n_active + 50) ELSE parent END AS density,
         CASE WHEN code IS NOT NULL AND fav > 0 THEN greatest(0.5, least(3.0, max_fav / fav)) ELSE 1.0 END AS d_adj FROM joined)"""
_ROUNDED = "SELECT listing_id, d_level, d_cell_key, round(density, 9) AS density, round(CAST(d_adj AS DOUBLE), 6) AS d_adj, round(0.3663 * density * d_adj / 90, 10) AS expected_daily FROM scored"


def _inputs(spark, sf_dir):
    return domain.market_items(spark, sf_dir), domain.market_orders(spark, sf_dir)


@query(sql_over("market_items market_orders listings", _SCORES + " " + _ROUNDED))
def flagship_draft_score(spark, sf_dir):
    """AGG-15, AGG-16, AGG-18, JOI-17, WIN-23, NUM-06, NUM-08: the expected daily sales of every draft."""
    items, orders = _inputs(spark, sf_dir)
    scored = demand.draft_scores(domain.listings(spark, sf_dir), *demand.cells_and_codes(items, orders, AS_OF))
    return scored.select("listing_id", "d_level", "d_cell_key", F.round("density", 9).alias("density"), F.round("d_adj", 6).alias("d_adj"), F.round("expected_daily", 10).alias("expected_daily"))


@query(sql_over("market_items market_orders", _CELLS + " SELECT level, cell_key, n_active, ord90, round(density, 9) AS density, round(avg_fav, 6) AS avg_fav FROM cells"))
def demand_cells_l3_l4_l6(spark, sf_dir):
    """AGG-15, AGG-18, NUM-13."""
    return demand.demand_cells(*_inputs(spark, sf_dir), AS_OF).select("level", "cell_key", "n_active", "ord90", F.round("density", 9).alias("density"), F.round("avg_fav", 6).alias("avg_fav"))


@query(sql_over("market_items market_orders", _KEYED + _CODES + " SELECT * FROM codes"))
def demand_mn_cells(spark, sf_dir):
    """AGG-16, STRF-08, STRF-09."""
    return demand.code_cells(*_inputs(spark, sf_dir), AS_OF)


@query(sql_over("market_orders", f"SELECT item_id, count(*) AS ord FROM market_orders WHERE sale_date >= strftime(DATE '{AS_OF}' - 90, '%Y/%m/%d') GROUP BY item_id"))
def orders_90d_by_item(spark, sf_dir):
    """AGG-02, DAT-01."""
    return demand.recent_orders(domain.market_orders(spark, sf_dir), AS_OF)


@query(sql_over("market_items market_orders listings", _SCORES + """,
joined_sales AS (SELECT round(0.3663 * s.density * s.d_adj / 90, 10) AS expected_daily, CASE WHEN l.sold > 0 THEN 1 ELSE 0 END AS hit FROM scored AS s JOIN listings AS l ON s.listing_id = l.listing_id),
by_score AS (SELECT expected_daily, count(*) AS n, sum(hit) AS s FROM joined_sales GROUP BY expected_daily),
ranked AS (SELECT *, sum(n) OVER (ORDER BY expected_daily DESC) AS upto, (SELECT count(*) FROM joined_sales) AS all_n, (SELECT sum(hit) FROM joined_sales) AS all_s FROM by_score),
tenths AS (SELECT CAST(least(10, floor((upto - 1) * 10 / all_n::DOUBLE) + 1) AS INTEGER) AS tenth, CAST(sum(n) AS BIGINT) AS n, CAST(sum(s) AS BIGINT) AS sold, max(all_s) AS all_s FROM ranked GROUP BY 1)
SELECT tenth, n, sold, round(sold / n::DOUBLE, 6) AS rate, round(sum(sold) OVER (ORDER BY tenth) / all_s::DOUBLE, 6) AS captured FROM tenths"""))
def backtest_capture(spark, sf_dir):
    """DOC-08: rate and captured share by tenth of the draft score."""
    sold = domain.listings(spark, sf_dir).select("listing_id", (F.col("sold") > 0).cast("long").alias("hit"))
    return demand.capture(flagship_draft_score(spark, sf_dir).join(sold, "listing_id"), "hit", "expected_daily")


@query(sql_over("market_items market_orders listings", _SCORES + """,
joined_sales AS (SELECT round(0.3663 * s.density * s.d_adj / 90, 10) AS x, l.sold > 0 AS hit FROM scored AS s JOIN listings AS l ON s.listing_id = l.listing_id),
ranks AS (SELECT hit, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0::DOUBLE AS r FROM joined_sales),
sums AS (SELECT sum(r) FILTER (WHERE hit) AS r, count(*) FILTER (WHERE hit) AS p, count(*) FILTER (WHERE NOT hit) AS n FROM ranks)
SELECT round((r - p * (p + 1) / 2.0::DOUBLE) / (p * n), 6) AS auc FROM sums"""))
def backtest_auc(spark, sf_dir):
    """DOC-08: how well the draft score tells what sells, with tied scores at half."""
    sold = domain.listings(spark, sf_dir).select("listing_id", (F.col("sold") > 0).cast("long").alias("hit"))
    found = demand.auc(flagship_draft_score(spark, sf_dir).join(sold, "listing_id"), "hit", "expected_daily")
    return found.select(F.round("auc", 6).alias("auc"))
