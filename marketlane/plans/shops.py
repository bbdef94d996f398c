"""Queries of shops: nested options, stock, brand lists, reports of the marketplace, and orders against stored counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane.operators import options, reconcile, shop_events
from marketlane.plans import query
from marketlane.sources import domain
from marketlane.sources.domain import read, sql_over
from marketlane.streaming import runs

_SIZE = "(upper(trim(value)) IN ('S', 'M', 'L', 'FREE') OR regexp_matches(trim(replace(upper(trim(value)), 'SIZE', '')), '^[0-9]{1,3}([.][0-9])?$'))"


def _nested(spark, sf_dir):
    """Items as a shop nests them. By offering the axes come in either order, under names that say much or little.

    k = 0: codes S and C; 1: names that say nothing; 2: both names say size; 3: one axis; 4: both axes look like sizes.
    """
    k, color, size = F.col("offering_id") % 5, F.col("color"), F.col("size")
    pair = lambda a, x, b, y: F.array(F.struct(F.lit(a).alias("axis"), x.alias("value")), F.struct(F.lit(b).alias("axis"), y.alias("value")))
    axes = (
        F.when(k == 0, pair("S", size, "C", color))
        .when(k == 1, pair("옵션", color, "NONE", size))
        .when(k == 2, pair("사이즈", color, "SIZE", size))
        .when(k == 3, F.array(F.struct(F.lit("NONE").alias("axis"), F.concat_ws("-", color, size).alias("value"))))
        .otherwise(pair("x", size, "y", F.concat(F.lit("9"), size)))
    )
    known = F.col("offering_id") % 3 == 0
    item = F.struct(
        F.when(F.col("offering_id") % 2 == 0, F.concat("color", "size")).alias("code"),
        F.lit(7).cast("long").alias("number"),
        F.when(known, F.col("in_stock") == 0).alias("sold_out"),
        (F.col("in_stock") == 1).alias("activated"),
        (size == "7").alias("deleted"),
        axes.alias("axes"),
    )
    return domain.offering_options(spark, sf_dir).groupBy("offering_id").agg(F.array_sort(F.collect_list(item)).alias("items"))


_AXES = f"""
o AS (SELECT *, offering_id % 5 AS k, CASE WHEN offering_id % 2 = 0 THEN color || size ELSE '7' END AS option_code,
        CASE WHEN offering_id % 3 = 0 THEN in_stock = 1 ELSE in_stock = 1 AND size <> '7' END AS there, color || '/' || size AS item FROM offering_options),
axes AS (
  SELECT offering_id, item, 1 AS nth, CASE k WHEN 0 THEN 'S' WHEN 1 THEN '옵션' WHEN 2 THEN '사이즈' WHEN 3 THEN 'NONE' ELSE 'x' END AS axis,
         CASE k WHEN 0 THEN size WHEN 3 THEN color || '-' || size WHEN 4 THEN size ELSE color END AS value FROM o
  UNION ALL SELECT offering_id, item, 2, CASE k WHEN 0 THEN 'C' WHEN 1 THEN 'NONE' WHEN 2 THEN 'SIZE' ELSE 'y' END,
         CASE k WHEN 0 THEN color WHEN 4 THEN '9' || size ELSE size END FROM o WHERE k <> 3),
judged AS (SELECT offering_id, nth, axis, 2 * count(*) FILTER (WHERE {_SIZE}) >= count(*) AS sizes FROM axes GROUP BY ALL),
roles AS (
  SELECT *, CASE WHEN axis LIKE '%사이즈%' OR axis LIKE '%SIZE%' OR axis = 'S' THEN 'size' WHEN axis LIKE '%COLOR%' OR axis = 'C' THEN 'color'
            WHEN sizes THEN 'size' ELSE 'color' END AS said FROM judged),
clashes AS (SELECT offering_id, bool_or(nth = 1 AND sizes) AND NOT bool_or(nth = 2 AND sizes) AS size_first FROM roles GROUP BY 1 HAVING count(*) = 2 AND count(DISTINCT said) = 1),
final AS (
  SELECT r.offering_id, r.axis, CASE WHEN c.offering_id IS NULL THEN said WHEN (nth = 1) = size_first THEN 'size' ELSE 'color' END AS role
  FROM roles AS r LEFT JOIN clashes AS c USING (offering_id))"""


@query(sql_over("offering_options", "," + _AXES + """
SELECT o.offering_id, coalesce(max(value) FILTER (WHERE role = 'color'), 'FREE') AS color, coalesce(max(value) FILTER (WHERE role = 'size'), 'FREE') AS tag_size,
       CASE WHEN any_value(there) THEN 'in_stock' ELSE 'out_of_stock' END AS status, any_value(option_code) AS option_code
FROM o JOIN axes USING (offering_id, item) JOIN final USING (offering_id, axis) GROUP BY o.offering_id, o.item"""))
def nested_options(spark, sf_dir):
    """ARR-06: roles of option axes from names and values of a whole product, with clashes, then flat options."""
    return options.by_axes(_nested(spark, sf_dir), "offering_id")


@query(sql_over("offering_options", """
SELECT offering_id, CASE WHEN color = 'N' THEN 'FREE' ELSE color END AS color, size AS tag_size, CASE WHEN in_stock = 1 AND size <> '4' THEN 'in_stock' ELSE 'out_of_stock' END AS status,
       CASE WHEN size <> '1' THEN size END AS option_code FROM offering_options"""))
def named_options(spark, sf_dir):
    """ARR-06, second shop: options that name their axes, with blanks, missing numbers and stock that is no number."""
    stock = F.when(F.col("size") == "4", "many").otherwise(F.concat(F.lit(" "), F.col("in_stock").cast("string")))
    color = F.when(F.col("color") == "N", "  ").otherwise(F.concat(F.lit(" "), "color"))
    item = F.struct(F.when(F.col("size") == "1", "").otherwise(F.col("size")).alias("number"), color.alias("color"), "size", stock.alias("stock"))
    rows = domain.offering_options(spark, sf_dir).groupBy("offering_id").agg(F.collect_list(item).alias("items"))
    return options.by_fields(rows, "offering_id")


@query(sql_over("offerings offering_options", """,
s AS (SELECT offering_id, max(in_stock) AS any_in, CAST(sum(in_stock) AS BIGINT) - 1 AS single FROM offering_options GROUP BY 1)
SELECT offering_id, CASE WHEN CASE offering_id % 3 WHEN 0 THEN any_in = 1 WHEN 1 THEN single > 0 ELSE shipping IS NOT NULL END THEN 'in_stock' ELSE 'out_of_stock' END AS stock
FROM offerings JOIN s USING (offering_id)"""))
def stock_fallbacks(spark, sf_dir):
    """AGG-42: in stock by the options, without options by a single number, without that by the mark of being sold out."""
    k = F.col("offering_id") % 3
    state = F.when(F.col("in_stock") == 1, "in_stock").otherwise("out_of_stock")
    sums = domain.offering_options(spark, sf_dir).groupBy("offering_id").agg(F.collect_list(state).alias("s"), (F.sum("in_stock") - 1).alias("n"))
    rows = domain.offerings(spark, sf_dir).join(sums, "offering_id")
    return rows.select("offering_id", options.stock_status(F.when(k == 0, F.col("s")).otherwise(F.array()), F.when(k == 1, F.col("n")), F.col("shipping").isNull()).alias("stock"))


@query("""
WITH stored AS (
  SELECT c_nationkey AS store, CASE WHEN c_nationkey % 4 = 3 AND c_custkey % 7 = 0 THEN '브랜드' || c_custkey ELSE 'Brand ' || c_custkey END AS name, 'https://s/' || c_custkey AS url,
         CASE WHEN c_custkey % 10 = 0 THEN 'K' || c_nationkey ELSE 'K' || c_custkey END AS key, CASE WHEN c_custkey % 11 = 0 THEN 0 WHEN c_custkey % 13 <> 0 THEN 1 END AS active,
         c_custkey AS id FROM customer),
scanned AS (
  SELECT store, CASE id % 5 WHEN 0 THEN upper(name) WHEN 1 THEN replace(name, ' ', '') WHEN 2 THEN 'Other ' || id ELSE name END AS name,
         CASE WHEN id % 4 = 0 THEN url || '/?cp=2' WHEN id % 9 = 0 THEN url || '/new' ELSE url END AS url, key
  FROM stored WHERE store % 5 <> 4 AND CASE WHEN store % 3 = 0 THEN id % 3 = 0 ELSE id % 8 <> 0 END
  UNION ALL SELECT c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN '새것' || c_custkey ELSE 'New ' || c_custkey END, 'https://s/n' || c_custkey, 'N' || c_custkey
  FROM customer WHERE c_nationkey % 5 <> 4 AND c_custkey % 17 = 0),
old AS (SELECT *, upper(replace(name, ' ', '')) AS norm FROM stored), new AS (SELECT *, upper(replace(name, ' ', '')) AS norm FROM scanned),
keyed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store, key ORDER BY name DESC) AS nth FROM old) AS x WHERE nth = 1),
korean AS (SELECT store, bool_or(name LIKE '%브랜드%') AS korean FROM stored GROUP BY store),
met AS (
  SELECT n.*, coalesce(a.name, b.name) AS found, coalesce(a.active, CASE WHEN a.name IS NULL THEN b.active END) AS active, coalesce(a.url, b.url) AS was_url, coalesce(a.key, b.key) AS was_key, korean
  FROM new AS n LEFT JOIN keyed AS a ON a.store = n.store AND a.key = n.key LEFT JOIN old AS b ON b.store = n.store AND b.norm = n.norm LEFT JOIN korean AS k ON k.store = n.store),
consumed AS (SELECT DISTINCT n.store, n.key FROM new AS n JOIN old AS o ON o.store = n.store AND o.norm = n.norm),
judged AS (
  SELECT o.*, EXISTS (SELECT 1 FROM new AS n WHERE n.store = o.store AND n.norm = o.norm)
              OR (EXISTS (SELECT 1 FROM new AS n WHERE n.store = o.store AND n.key = o.key) AND NOT EXISTS (SELECT 1 FROM consumed AS c WHERE c.store = o.store AND c.key = o.key)) AS there
  FROM old AS o WHERE active = 1 AND store IN (SELECT store FROM new)),
cover AS (SELECT store, avg(CASE WHEN there THEN 1.0 ELSE 0.0 END) AS coverage FROM judged GROUP BY store)
SELECT store, coalesce(found, name) AS name, url, key,
       CASE WHEN found IS NULL THEN CASE WHEN name LIKE '%새것%' AND NOT korean THEN 'held' ELSE 'new' END WHEN active = 0 THEN 'kept off'
            WHEN rtrim(split_part(was_url, '?', 1), '/') <> rtrim(split_part(url, '?', 1), '/') OR was_key <> key THEN 'moved' ELSE 'same' END AS change FROM met
UNION ALL SELECT j.store, name, url, key, CASE WHEN coverage < 0.6 THEN 'withheld' ELSE 'gone' END FROM judged AS j JOIN cover USING (store) WHERE NOT there""")
def brand_reconcile(spark, sf_dir):
    """JOI-20, SET-08, SET-03: brand lists of complete, incomplete and empty scans; by key, then by name, with consumed keys."""
    c = read(spark, sf_dir, "customer")
    i, store = F.col("c_custkey"), F.col("c_nationkey")
    name = F.when((store % 4 == 3) & (i % 7 == 0), F.concat(F.lit("브랜드"), i)).otherwise(F.concat(F.lit("Brand "), i))
    key = F.concat(F.lit("K"), F.when(i % 10 == 0, store).otherwise(i))
    active = F.when(i % 11 == 0, 0).when(i % 13 != 0, 1)
    stored = c.select(store.alias("store"), name.alias("name"), F.concat(F.lit("https://s/"), i).alias("url"), key.alias("key"), active.alias("active"), i.alias("id"))
    n, k = F.col("name"), F.col("id")
    said = F.when(k % 5 == 0, F.upper(n)).when(k % 5 == 1, F.replace(n, F.lit(" "))).when(k % 5 == 2, F.concat(F.lit("Other "), k)).otherwise(n)
    url = F.when(k % 4 == 0, F.concat("url", F.lit("/?cp=2"))).when(k % 9 == 0, F.concat("url", F.lit("/new"))).otherwise(F.col("url"))
    seen = stored.filter(F.col("store") % 5 != 4).filter(F.when(F.col("store") % 3 == 0, k % 3 == 0).otherwise(k % 8 != 0)).select("store", said.alias("name"), url.alias("url"), "key")
    fresh = c.filter((store % 5 != 4) & (i % 17 == 0)).select(store.alias("store"), F.concat(F.when(i % 2 == 0, "새것").otherwise("New "), i).alias("name"), F.concat(F.lit("https://s/n"), i).alias("url"), F.concat(F.lit("N"), i).alias("key"))
    return reconcile.reconciled_brands(stored.drop("id"), seen.unionByName(fresh))


_KEEPS = {
    "A all but returned": "status NOT LIKE 'R%'",
    "B closed": "status NOT LIKE 'R%' AND status NOT LIKE '%O'",
    "C kept and closed": "status = 'NF'",
    "D accepted": "status = 'AF'",
}
_FIRST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY product, amount, status) AS nth FROM o WHERE {}) AS x WHERE nth = 1"
_ORDERS = """
o AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS product, CAST(floor(l_extendedprice) AS BIGINT) AS amount, l_returnflag || l_linestatus AS status FROM lineitem),
stored AS (
  SELECT product, count(*) AS n, CAST(sum(amount) + CASE WHEN product % 10 = 0 THEN product ELSE 0 END AS BIGINT) AS amount
  FROM (""" + _FIRST.format("status NOT LIKE 'R%'") + """) AS k GROUP BY product),
counted AS (""" + " UNION ALL ".join(f"SELECT '{k}' AS variant, product, count(*) AS n, CAST(sum(amount) AS BIGINT) AS amount FROM ({_FIRST.format(v)}) AS k GROUP BY product" for k, v in _KEEPS.items()) + """),
was AS (SELECT variant, s.* FROM stored AS s, (VALUES """ + ", ".join(f"('{k}')" for k in _KEEPS) + """) AS v(variant)),
pairs AS (
  SELECT coalesce(c.variant, s.variant) AS variant, coalesce(c.product, s.product) AS product, c.n, c.amount, s.n AS was_n, s.amount AS was_amount
  FROM was AS s FULL JOIN counted AS c ON c.variant = s.variant AND c.product = s.product),
sums AS (
  SELECT variant, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n, CAST(sum(coalesce(was_n, 0)) AS BIGINT) AS was_n, CAST(sum(coalesce(amount, 0)) AS BIGINT) AS amount, CAST(sum(coalesce(was_amount, 0)) AS BIGINT) AS was_amount,
         count(*) FILTER (WHERE n IS NOT NULL AND was_n IS NOT NULL) AS common, count(*) FILTER (WHERE n = was_n AND amount = was_amount) AS exact,
         count(*) FILTER (WHERE n <> was_n) AS n_differs, count(*) FILTER (WHERE amount <> was_amount) AS amount_differs,
         count(*) FILTER (WHERE was_n IS NULL) AS only_here, count(*) FILTER (WHERE n IS NULL) AS only_there FROM pairs GROUP BY variant),
best AS (SELECT *, row_number() OVER (ORDER BY exact DESC, abs(n - was_n), variant) = 1 AS is_best FROM sums)"""


def _order_pairs(spark, sf_dir):
    """Orders as pages list them, some twice, and the counts stored of them, which are off for some products."""
    l = read(spark, sf_dir, "lineitem").withColumn("status", F.concat("l_returnflag", "l_linestatus")).withColumn("amount", F.floor("l_extendedprice").cast("long"))
    o = l.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").alias("product"), "amount", "status")
    o = o.withColumn("place", F.struct("product", "amount", "status"))
    pages = o.unionByName(o.filter("id % 3 = 0"))
    kept = reconcile.counted_by_variants(o, {"kept": ~F.col("status").like("R%")}).drop("variant")
    stored = kept.withColumn("amount", F.col("amount") + F.when(F.col("product") % 10 == 0, F.col("product")).otherwise(0))
    counted = reconcile.counted_by_variants(pages, {k: F.expr(v) for k, v in _KEEPS.items()})
    return reconcile.held_against(counted, stored, list(_KEEPS))


@query("WITH " + _ORDERS.strip() + " SELECT * FROM best")
def order_variants(spark, sf_dir):
    """AGG-40, AGG-41: ways to count orders against stored counts, and the one that fits best; no product is left out."""
    return reconcile.variant_summary(_order_pairs(spark, sf_dir))


@query("WITH " + _ORDERS.strip() + """
SELECT product, n, amount, was_n, was_amount, abs(amount - was_amount) AS gap FROM pairs JOIN best USING (variant)
WHERE is_best AND pairs.n IS NOT NULL AND pairs.was_n IS NOT NULL AND (pairs.n <> pairs.was_n OR pairs.amount <> pairs.was_amount) ORDER BY gap DESC, product DESC LIMIT 15""".replace("SELECT product, n, amount, was_n, was_amount, abs(amount - was_amount) AS gap", "SELECT product, pairs.n, pairs.amount, pairs.was_n, pairs.was_amount, abs(pairs.amount - pairs.was_amount) AS gap"))
def order_mismatches(spark, sf_dir):
    """AGG-41: the 15 largest mismatches of the variant that fits best, a report."""
    pairs = _order_pairs(spark, sf_dir)
    return reconcile.largest_mismatches(pairs, reconcile.variant_summary(pairs))


_GONE, _STOPPED = shop_events.GONE_MESSAGES[0], shop_events.STOPPED_MESSAGE


def _reports(events):
    """Events of a marketplace as JSON texts: by the user's event, and the number in its props."""
    k, t = F.get_json_object("props", "$.k").cast("long"), F.col("event_type")
    name = F.when(t == "signup", "product/create").when(t == "error", F.when(k % 3 == 0, "product/fail_to_update").otherwise("product/fail_to_create")).otherwise("product/update")
    status = F.when(t == "click", "buyer_suspended").when((t == "view") & (k % 2 == 0), "buyer_deleted").otherwise("on_sale")
    told = F.when((t == "error") & (k % 3 == 1), F.when(k % 2 == 0, _GONE).otherwise(_STOPPED)).otherwise("other")
    reference = F.concat(F.lit("R"), "user_id")
    flat = F.struct(reference.alias("reference_number"), F.col("event_id").alias("id"), status.alias("status"), told.alias("errors"))
    deep = F.struct(F.struct(reference.alias("reference_number"), F.col("event_id").alias("id")).alias("product"), status.alias("status"), told.alias("errors"))
    body = F.when(k % 10 == 9, "{broken").when(k % 4 == 0, F.to_json(deep)).otherwise(F.to_json(flat))
    return events.select(name.alias("event"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), body.alias("body"))


_KIND = f"""
e AS (SELECT 'R' || user_id AS reference, ts, event_id, event_type AS t, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
kinds AS (
  SELECT reference, event_id, row_number() OVER (PARTITION BY reference ORDER BY ts, event_id) AS nth, epoch_us(ts) AS us,
         CASE WHEN t = 'signup' THEN 'registered' WHEN t = 'click' THEN 'stopped' WHEN t = 'view' AND k % 2 = 0 THEN 'deleted'
              WHEN t = 'error' THEN CASE WHEN k % 3 = 0 THEN 'not updated' WHEN k % 3 = 2 THEN 'not created' WHEN k % 2 = 0 THEN 'reset' ELSE 'found stopped' END ELSE 'updated' END AS kind
  FROM e WHERE k % 10 <> 9),
legal(kind, phase) AS (VALUES {", ".join(f"('{k}', '{p}')" for k, ps in shop_events.LEGAL.items() for p in ps)}),
steps AS (
  SELECT reference, 0::BIGINT AS nth, 'none' AS phase, NULL::VARCHAR AS status, 0 AS published, 0 AS locked, NULL::BIGINT AS product_id, NULL::BIGINT AS registered_at, 0::BIGINT AS n_applied, 0::BIGINT AS n_illegal
  FROM kinds GROUP BY reference
  UNION ALL
  SELECT s.reference, k.nth,
         CASE WHEN l.kind IS NULL THEN s.phase WHEN k.kind IN ('registered', 'updated') THEN 'live' WHEN k.kind IN ('stopped', 'found stopped') THEN 'stopped' WHEN k.kind = 'deleted' THEN 'gone' WHEN k.kind = 'reset' THEN 'none' ELSE s.phase END,
         CASE WHEN l.kind IS NULL THEN s.status WHEN k.kind IN ('registered', 'updated') THEN 'success' WHEN k.kind IN ('stopped', 'found stopped') THEN 'soldout' WHEN k.kind = 'deleted' THEN 'deleted' ELSE 'fail' END,
         CASE WHEN l.kind IS NULL THEN s.published WHEN k.kind IN ('registered', 'updated') THEN 1 WHEN k.kind LIKE 'not %' THEN s.published ELSE 0 END,
         CASE WHEN l.kind IS NULL THEN s.locked WHEN k.kind IN ('registered', 'updated') THEN 1 WHEN k.kind = 'reset' THEN 0 ELSE s.locked END,
         CASE WHEN l.kind IS NULL THEN s.product_id WHEN k.kind IN ('registered', 'updated') THEN k.event_id WHEN k.kind = 'reset' THEN NULL ELSE s.product_id END,
         CASE WHEN l.kind IS NOT NULL AND k.kind IN ('registered', 'updated') THEN coalesce(s.registered_at, k.us) ELSE s.registered_at END,
         s.n_applied + CASE WHEN l.kind IS NULL THEN 0 ELSE 1 END, s.n_illegal + CASE WHEN l.kind IS NULL THEN 1 ELSE 0 END
  FROM steps AS s JOIN kinds AS k ON k.reference = s.reference AND k.nth = s.nth + 1 LEFT JOIN legal AS l ON l.kind = k.kind AND l.phase = s.phase)
SELECT reference, phase, status, published, locked, product_id, registered_at, n_applied, n_illegal FROM (SELECT *, row_number() OVER (PARTITION BY reference ORDER BY nth DESC) AS last FROM steps) AS x WHERE last = 1"""


@query("WITH RECURSIVE" + _KIND)
def listing_states(spark, sf_dir):
    """STR-11, SRC-25: a marketplace's reports, folded by a table of what may follow what; the rest is counted apart."""
    return shop_events.folded(shop_events.parsed_events(_reports(read(spark, sf_dir, "events"))))


@query("WITH RECURSIVE" + _KIND)
def stream_listing_states(spark, sf_dir):
    """STR-11, SRC-25 as a stream over JSON texts: the rows of ``listing_states``."""
    path, files = runs.scattered(read(spark, sf_dir, "events"), "event_id", f"{runs.new_path(spark, 'reports')}/in")
    stream = shop_events.parsed_events(_reports(runs.file_stream(spark, path, files)))
    return runs.table_after(stream, shop_events.folded_step, "listing-states", shop_events.FOLDED).select("reference", "s.*")
