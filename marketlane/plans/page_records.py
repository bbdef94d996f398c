"""Queries of names and page records. Pages and names are made from the tables, then read back; the SQL states the rows themselves.

A page holds what one order or one listing has, so none grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane.functions import names
from marketlane.plans import query
from marketlane.sources import domain, pages
from marketlane.sources.domain import read, sql_over


def _say(*parts):
    """Text with columns in it: every second part is one."""
    return F.concat(*(F.lit(p) if i % 2 == 0 else F.col(p) if isinstance(p, str) else p for i, p in enumerate(parts)))


def _page(rows, keys, order, card, before="", after=""):
    """One page for each key: the cards of its rows in order."""
    cards = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, card.alias("card")))), lambda x: x["card"]), "\n")
    return rows.groupBy(*keys).agg(F.concat(F.lit(f"<html>{before}<ul>"), cards, F.lit(f"</ul>{after}</html>")).alias("html"))


@query(sql_over("market_orders", """
SELECT seller_id, order_id, CAST(place AS INTEGER) AS place, sale_date, item_id, qty, 'Item & ' || item_id AS item_name FROM (
  SELECT seller_id, order_id, sale_date, replace(item_id, '-', '000') AS item_id, qty,
         row_number() OVER (PARTITION BY seller_id, order_id ORDER BY line, item_id, sale_date, qty) AS place FROM market_orders) AS t WHERE qty % 10 <> 0"""))
def sales_page_rows(spark, sf_dir):
    """SRC-19: sold cards of a page in their order; cards that don't say how many are left out."""
    rows = domain.market_orders(spark, sf_dir).withColumn("n", F.replace("item_id", F.lit("-"), F.lit("000")))
    many = F.when(F.col("qty") % 10 == 0, F.lit("")).otherwise(_say("<p>注文数：", F.col("qty").cast("string"), "</p>"))
    card = _say('<li class="buyeritemtable_info"><p class="buyeritem_name"><a href="https://x/item/', "n", '/">Item &amp; <b>', "n", "</b></a></p>", many, "<p>成約日：", "sale_date", "</p></li>")
    made = _page(rows, ["seller_id", "order_id"], ["line", "item_id", "sale_date", "qty"], card)
    return pages.sales(made)


@query(sql_over("offerings", """
SELECT listing_id, CAST(row_number() OVER (PARTITION BY listing_id ORDER BY offering_id) AS INTEGER) AS place, CAST(offering_id AS VARCHAR) AS item_id,
       'Offer ' || source_site AS name, purchase_price AS price, CAST(greatest(1, listing_id % 40) AS INTEGER) AS max_page FROM offerings
QUALIFY shipping IS NOT NULL"""))
def seller_item_rows(spark, sf_dir):
    """SRC-16: cards with a price, and the greatest page that the page links."""
    price = F.when(F.col("shipping").isNull(), F.lit("sold out")).otherwise(_say("¥ ", F.format_number("purchase_price", 0), ""))
    card = _say('<li class="x buyeritemtable_info"><p class="buyeritem_name"><a href="/item/', F.col("offering_id").cast("string"), '/">Offer ', "source_site", '</a></p><p class="buyeritem_price">', price, "</p></li>")
    made = _page(domain.offerings(spark, sf_dir), ["listing_id"], ["offering_id"], card)
    made = made.withColumn("html", _say("", "html", '<a href="/buyer/7/item_', (F.col("listing_id") % 40).cast("string"), '.html">last</a><a href="/buyer/7/item_1.html">first</a>'))
    return pages.seller_items(made.withColumn("max_page", pages.last_page(F.col("html"), pages.ITEM_PAGES)))


@query(sql_over("offerings", """,
n AS (SELECT *, count(*) OVER (PARTITION BY listing_id) AS total FROM offerings)
SELECT listing_id, total * 1000 AS total, CAST(row_number() OVER (PARTITION BY listing_id ORDER BY offering_id) AS INTEGER) AS rank, CAST(offering_id AS VARCHAR) AS item_id,
       CASE WHEN shipping IS NOT NULL THEN purchase_price END AS price, CASE WHEN source_site <> 's0' THEN 'Shop ' || source_site END AS seller_name, CASE WHEN source_site <> 's0' THEN substr(source_site, 2) END AS seller_id
FROM n WHERE source_site <> 's6'"""))
def search_page_rows(spark, sf_dir):
    """SRC-17: products of a search page by their place; those that link no item are none, prices and sellers may be missing."""
    o = F.col("offering_id").cast("string")
    link = F.when(F.col("source_site") != "s6", _say('<a href="/item/', o, '/">x</a>')).otherwise(F.lit("<b>advert</b>"))
    price = F.when(F.col("shipping").isNull(), F.lit("sold out")).otherwise(_say("¥", F.format_number("purchase_price", 0), ""))
    seller = F.when(F.col("source_site") == "s0", F.lit("")).otherwise(_say('<a href="/buyer/', F.substring("source_site", 2, 9), '.html">Shop ', "source_site", "</a>"))
    card = F.concat(F.lit('<li class="product">'), link, seller, F.lit('<span class="Price_Txt">'), price, F.lit("</span></li>"))
    rows = domain.offerings(spark, sf_dir)
    made = _page(rows, ["listing_id"], ["offering_id"], card).join(rows.groupBy("listing_id").agg(F.count("*").alias("n")), "listing_id")
    made = made.withColumn("html", _say("<p>", F.format_number(F.col("n") * 1000, 0), " 件</p>", "html")).drop("n")
    return pages.search_listings(made.withColumn("total", pages.total_results(F.col("html"))))


@query(sql_over("offerings", """
SELECT listing_id, CAST(row_number() OVER (PARTITION BY listing_id ORDER BY offering_id) AS INTEGER) AS rank, substr(source_site, 2) AS seller_id, 'Shop ' || source_site AS seller_name,
       CAST(offering_id AS VARCHAR) AS item_id, 'https://x/item/' || offering_id || '/' AS link, purchase_price AS price, 'Offer ' || offering_id AS name FROM offerings WHERE is_active = 1"""))
def competitor_rows(spark, sf_dir):
    """SRC-18: new products of a search page by rank; used ones are dropped before ranks are given."""
    used = F.when(F.col("is_active") == 1, F.lit("")).otherwise(F.lit('<span class="product_used_tag">used</span>'))
    o = F.col("offering_id").cast("string")
    card = _say('<li class="product">', used, '<a href="/item/', o, '/">x</a><p class="product_name">Offer ', o, '</p><p class="product_Buyer"><a href="/buyer/', F.substring("source_site", 2, 9), '.html">Shop ', "source_site", '</a></p><span class="Price_Txt">¥', F.format_number("purchase_price", 0), "</span></li>")
    return pages.competitors(_page(domain.offerings(spark, sf_dir), ["listing_id"], ["offering_id"], card), "https://x")


@query("""
SELECT s_suppkey AS seller_id, s_name AS seller_name, CASE s_suppkey % 3 WHEN 0 THEN 'SHOP' WHEN 1 THEN 'PREMIUM PERSONAL SHOPPER' ELSE 'PERSONAL SHOPPER' END AS seller_type,
       CASE WHEN s_nationkey % 2 = 0 THEN '한국' ELSE n_name END AS country, 1000 + s_suppkey AS follower_count, s_suppkey AS listing_count,
       CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE s_suppkey * 3 END AS order_count
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 0 OR s_nationkey % 2 = 0""")
def seller_profile_rows(spark, sf_dir):
    """SRC-20, FLT-24: profiles of shops anywhere and of personal sellers at home; a page without a count says nought."""
    rows = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    kind = F.element_at(F.array(*map(F.lit, ('<span class="label_shop">a</span>', '<span class="label_premium">b</span>', "Personal Shopper"))), (F.col("s_suppkey") % 3 + 1).cast("int"))
    country = F.when(F.col("s_nationkey") % 2 == 0, "韓国").otherwise(F.col("n_name"))
    n = lambda c: c.cast("string")
    orders = F.when(F.col("s_suppkey") % 4 == 0, F.lit("")).otherwise(_say('<h3>注文実績</h3><p class="buyer_eva_text">', n(F.col("s_suppkey") * 3), "件</p>"))
    html = _say('<p class="label">', kind, '</p><div id="buyer_name"><h1><img alt="', country, '"><a href="#">', "s_name", '</a></h1></div><b id="js_fan_count">', F.format_number(F.col("s_suppkey") + 1000, 0), '</b><span class="syohin_cnt_text">', n(F.col("s_suppkey")), "</span>", orders, "")
    return pages.seller_profiles(rows.select(F.col("s_suppkey").alias("seller_id"), html.alias("html")))


@query(sql_over("offerings", """
SELECT listing_id, array_to_string(list_sort(list(DISTINCT CAST(offering_id % 100000 AS VARCHAR))), ' ') AS sellers, CAST(3 AS INTEGER) AS max_page FROM offerings GROUP BY listing_id"""))
def listed_sellers(spark, sf_dir):
    """SRC-21: the sellers that a list page links, each once, and the last page."""
    card = _say('<li><a href="/buyer/', (F.col("offering_id") % 100000).cast("string"), '.html">a</a><a class="b" href="/buyer/', (F.col("offering_id") % 100000).cast("string"), '.html">again</a></li>')
    made = _page(domain.offerings(spark, sf_dir), ["listing_id"], ["offering_id"], card, after='<a href="/r/-A2002003000_3/">3</a><a href="/r/-A2002003000_2/">2</a>')
    return made.select("listing_id", F.array_join(F.array_sort(pages.seller_ids(F.col("html"))), " ").alias("sellers"), pages.last_page(F.col("html"), pages.LIST_PAGES).alias("max_page"))


@query(sql_over("offering_options", """
SELECT p_partkey AS page_id, p_name || ' <1>' AS name, p_brand AS brand, 'TOP > ' || p_type || ' > ' || p_name AS category_path, 'City ' || p_size AS origin_country,
       CAST(10000 + p_size AS BIGINT) AS view_count, CAST(NULL AS BIGINT) AS inquiry_count, 'MD-' || p_partkey AS model_number, 'Logo' AS tags,
       n AS variants, skus, prices, stock, '61' AS length_s
FROM part JOIN (
  SELECT offering_id // 100000 AS listing_id, count(*) AS n, string_agg(sku, ' ' ORDER BY sku) AS skus, CAST(sum(CAST(size AS INTEGER) * 100) AS BIGINT) AS prices, CAST(sum(in_stock * 5) AS BIGINT) AS stock
  FROM (SELECT *, offering_id || '/' || color || '/' || size AS sku FROM offering_options) AS v GROUP BY 1) AS o ON p_partkey = listing_id"""))
def product_details(spark, sf_dir):
    """SRC-14, SRC-15, JSN-01, MAP-02: the record of a product's page with its variants, stock range and measurements."""
    o = domain.offering_options(spark, sf_dir)
    offer = F.struct(
        F.when(F.col("in_stock") == 1, (F.col("size").cast("int") * 100).cast("string")).alias("price"),
        (F.col("size").cast("int") * 100 + 0.5).alias("lowPrice"),
        F.lit("http://s/InStock").alias("availability"),
        F.struct(F.lit(0).alias("minValue"), (F.col("in_stock") * 5).alias("maxValue")).alias("inventoryLevel"),
    )
    variant = F.struct(F.concat_ws("/", "offering_id", "color", "size").alias("sku"), "color", "size", offer.alias("offers"))
    variants = o.groupBy(F.floor(F.col("offering_id") / 100000).alias("p_partkey")).agg(F.sort_array(F.collect_list(variant)).alias("v"))
    trail = lambda *n: F.struct(F.lit("BreadcrumbList").alias("@type"), F.array(*(F.struct(x.alias("name")) for x in n)).alias("itemListElement"))
    group = F.struct(F.lit("ProductGroup").alias("@type"), F.struct(F.col("p_brand").alias("name")).alias("brand"), F.col("v").alias("hasVariant"))
    ld = lambda x: F.concat(F.lit('<script type="application/ld+json">'), x, F.lit("</script>"))
    size = F.col("p_size").cast("string")
    html = F.concat(
        _say("<h1>", "p_name", ' &lt;1&gt;</h1><meta name="twitter:label1" content="購入地"><meta name="twitter:data1" content="City ', size, '"><span class="ac_count">', F.format_number(F.col("p_size") + 10000, 0), "</span>"),
        ld(F.to_json(F.array(trail(F.lit("TOP")), trail(F.lit("TOP"), F.col("p_type"), F.col("p_name"))))), ld(F.lit("{broken")), ld(F.to_json(group)),
        _say("<dl><dt>品番</dt><dd>MD-", F.col("p_partkey").cast("string"), "</dd></dl><p>タグ</p><ul><a>Logo</a><a>閉じる</a></ul><table><tr><th>size</th><th>length</th></tr><tr><td>S</td><td>61</td></tr></table>"),
    )
    made = read(spark, sf_dir, "part").join(variants, "p_partkey").select(F.col("p_partkey").alias("page_id"), html.alias("html"))
    total = lambda f: F.aggregate("variants", F.lit(0).cast("bigint"), lambda a, v: a + v[f])
    return pages.item_details(made).select(
        "page_id", "name", "brand", "category_path", "origin_country", "view_count", "inquiry_count", "model_number", F.array_join("tags", " ").alias("tags"), F.size("variants").cast("bigint").alias("variants"),
        F.array_join(F.array_sort(F.transform("variants", lambda v: v["sku"])), " ").alias("skus"), total("price").alias("prices"), total("stock_max").alias("stock"), F.col("size_chart")["S"]["length"].alias("length_s"),
    )


@query("""
WITH p AS (SELECT p_partkey AS page_id, p_brand, p_type, p_size FROM part)
SELECT page_id, 'brand' AS kind, p_brand AS name, 'b1' AS category_key, 'BRAND > ' || p_type || ' > ' || p_brand AS full_path FROM p
UNION ALL SELECT page_id, 'category', '여성', 'w', '여성' FROM p
UNION ALL SELECT page_id, 'brand', p_type, CAST(p_size AS VARCHAR), '여성 > ' || p_type FROM p""")
def store_trees(spark, sf_dir):
    """SRC-24: brands and categories of the category tree in a store page's state."""
    node = lambda name, key, *kids: F.struct(name.alias("name"), key.alias("id"), *([F.array(*kids).alias("subCategories")] if kids else []))
    tops = [
        node(F.lit("BRAND"), F.lit("b"), node(F.col("p_type"), F.lit("t"), node(F.concat("p_brand", F.lit("😀")), F.lit("b1")))),
        node(F.lit("여성"), F.lit("w"), node(F.col("p_type"), F.col("p_size").cast("string"), node(F.lit("below a brand"), F.lit("n")))),
    ]
    tree = F.to_json(F.struct(F.struct(F.struct(F.array(*tops).alias("subCategories")).alias("storeCategoryTree")).alias("categoryMenu")))
    made = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), F.concat(F.lit("<script>window.__PRELOADED_STATE__="), tree, F.lit("</script>")).alias("html"))
    return pages.tree_entries(made, "BRAND", ["여성"])


@query("""
SELECT p_partkey, p_name || CASE WHEN p_partkey % 6 = 4 THEN ' L/S' WHEN p_partkey % 6 = 5 THEN ' 25FW-' || p_partkey ELSE '' END || ' ZQ' || p_partkey || ' 23SU' AS name,
       'ZQ' || p_partkey || ' 19K' AS model FROM part""")
def clean_names(spark, sf_dir):
    """STRF-03, STRF-04, UDF-01: names after the rules of their store; a season at the end stays, others go."""
    i, kind = F.col("p_partkey"), F.col("p_partkey") % 6
    raw = F.when(kind == 0, F.concat(F.lit("[국내배송] 26SS "), "p_name")).when(kind == 1, F.concat(F.lit("[Aa][24 S/S] "), "p_name")).when(kind == 2, F.concat("p_name", F.lit(" 럭키찬스' ")))
    raw = raw.when(kind == 3, F.concat(F.lit("(국내매장) [2025FW] "), "p_name")).when(kind == 4, F.concat("p_name", F.lit("  L/S 26년F/W"))).otherwise(F.concat("p_name", F.lit(" 25FW-"), i))
    store = F.element_at(F.array(*map(F.lit, ("tuttobene", "labellusso", "9tems", "other", "other", "other"))), (kind + 1).cast("int"))
    # Products are dealt by their key: a table of few columns is few splits, and the rules take far longer than the scan.
    part = read(spark, sf_dir, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    rows = part.select("p_partkey", store.alias("store"), F.concat(raw, F.lit(" ZQ"), i, F.lit(" 23SU")).alias("raw"))
    model = names.without_seasons(F.concat(F.lit("SS24 ZQ"), i, F.lit(" 26S 19K")))
    return rows.select("p_partkey", names.clean_name(F.col("store"), F.col("raw")).alias("name"), model.alias("model"))
