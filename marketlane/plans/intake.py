"""Queries of what comes in: products of shops in one shape, market pages saved whole, and searches over stored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane import config
from marketlane.functions import dates, money, names, text
from marketlane.operators import filters, lookups, relational
from marketlane.plans import query
from marketlane.sources import domain, files, raw_rows, sinks
from marketlane.sources.domain import read, sql_over
from marketlane.sources.raw_rows import Field


def _shops(spark, sf_dir):
    """Three shops of different shapes: columns, JSON texts with nested fields, and offers with arrays of options."""
    part = read(spark, sf_dir, "part")
    k, name = F.col("p_partkey"), F.col("p_name")
    flat = raw_rows.mapped(
        part,
        "flat",
        {
            "mall_product_id": Field(k),
            "brand_name_en": Field(F.upper("p_brand")),
            "product_name": Field(F.when(k % 9 != 0, F.trim(name)), must={"no name": F.when(k % 9 != 0, name) != ""}),
            "p_name_full": Field(F.concat_ws(" ", name, "p_type")),
            "category_path": Field(F.concat_ws(" > ", "p_type", name), "none"),
            "raw_price": Field(F.floor("p_retailprice"), must={"no price": F.floor("p_retailprice") > 0}),
            "original_price": Field(F.floor("p_retailprice") + 100),
            "stock_status": Field(F.when(k % 4 == 0, "out_of_stock"), "in_stock"),
        },
    )
    c = read(spark, sf_dir, "customer")
    i = F.col("c_custkey")
    price = F.when(i % 7 == 0, "ask").otherwise(F.concat(F.lit("₩ "), F.format_number(F.floor("c_acctbal"), 0), F.lit(".50")))
    body = F.to_json(F.struct(i.alias("no"), F.struct(F.col("c_mktsegment").alias("en")).alias("brand"), F.concat(F.lit("[26SS] "), "c_name").alias("name"), price.alias("price")))
    texts = c.select(F.when(i % 11 == 0, F.substring(body, 2, 9)).otherwise(body).alias("body"), i.alias("row"))
    read_ = texts.withColumn("b", F.from_json("body", "no long, brand struct<en:string>, name string, price string"))
    paid = raw_rows.number(F.col("b.price"))
    nested = raw_rows.mapped(
        read_,
        "nested",
        {
            "mall_product_id": Field(F.coalesce("b.no", "row"), must={"not JSON": F.col("b.no").isNotNull()}),
            "brand_name_en": Field(F.col("b.brand.en"), "NONAME"),
            "product_name": Field(names.without_seasons(F.col("b.name"))),
            "raw_price": Field(paid, must={"no price": paid > 0}),
            "product_url": Field(F.concat(F.lit("https://shop/p/"), F.col("b.no").cast("string"))),
            "raw_json_data": Field(F.col("body")),
        },
    )
    o = domain.offering_options(spark, sf_dir).groupBy("offering_id").agg(F.collect_list("in_stock").alias("stock"), F.count("*").alias("n"))
    offers = raw_rows.mapped(
        o,
        "offers",
        {
            "mall_product_id": Field(F.col("offering_id")),
            "stock_status": Field(F.when(F.array_contains("stock", 1), "in_stock"), "out_of_stock"),
            "raw_price": Field(F.col("n"), must={"too many": F.col("n") <= 1, "odd": F.col("offering_id") % 2 == 0}),
        },
    )
    return flat.unionByName(nested).unionByName(offers)


_SHOPS = """
flat AS (
  SELECT 'flat' AS source_site, CAST(p_partkey AS VARCHAR) AS mall_product_id, upper(p_brand) AS brand_name_en, CASE WHEN p_partkey % 9 <> 0 THEN trim(p_name) END AS product_name,
         p_name || ' ' || p_type AS p_name_full, p_type || ' > ' || p_name AS category_path, CAST(floor(p_retailprice) AS BIGINT) + 100 AS original_price, CAST(floor(p_retailprice) AS BIGINT) AS raw_price,
         CASE WHEN p_partkey % 4 = 0 THEN 'out_of_stock' ELSE 'in_stock' END AS stock_status, NULL AS product_url,
         list_filter([CASE WHEN p_partkey % 9 = 0 THEN 'no name' END, CASE WHEN p_retailprice < 1 THEN 'no price' END], lambda x: x IS NOT NULL) AS reasons FROM part),
nested AS (
  SELECT 'nested', CAST(c_custkey AS VARCHAR), CASE WHEN bad THEN 'NONAME' ELSE c_mktsegment END, CASE WHEN NOT bad THEN c_name END, NULL, NULL, NULL::BIGINT, CASE WHEN NOT bad AND NOT ask THEN price END, NULL,
         CASE WHEN NOT bad THEN 'https://shop/p/' || c_custkey END,
         list_filter([CASE WHEN bad THEN 'not JSON' END, CASE WHEN bad OR ask OR price <= 0 THEN 'no price' END], lambda x: x IS NOT NULL)
  FROM (SELECT *, c_custkey % 11 = 0 AS bad, c_custkey % 7 = 0 AS ask, CAST(floor(c_acctbal) AS BIGINT) AS price FROM customer) AS c),
options AS (SELECT offering_id, max(in_stock) AS any_in, count(*) AS n FROM offering_options GROUP BY 1),
offers AS (
  SELECT 'offers', CAST(offering_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL::BIGINT, n, CASE WHEN any_in = 1 THEN 'in_stock' ELSE 'out_of_stock' END, NULL,
         list_filter([CASE WHEN n > 1 THEN 'too many' END, CASE WHEN offering_id % 2 = 1 THEN 'odd' END], lambda x: x IS NOT NULL) FROM options),
shops AS (SELECT * FROM flat UNION ALL SELECT * FROM nested UNION ALL SELECT * FROM offers)"""
_SHOWN = "source_site, mall_product_id, brand_name_en, product_name, p_name_full, category_path, original_price, raw_price, stock_status, product_url"


@query(sql_over("offering_options", f",{_SHOPS} SELECT {_SHOWN} FROM shops WHERE len(reasons) = 0"))
def shop_products(spark, sf_dir):
    """SRC-26: products of three shops in the common shape."""
    return raw_rows.accepted(_shops(spark, sf_dir)).select(*_SHOWN.split(", "))


@query(sql_over("offering_options", f",{_SHOPS} SELECT source_site, mall_product_id, unnest(reasons) AS reason FROM shops"))
def shop_rejects(spark, sf_dir):
    """SRC-26, SRC-13: rows that don't fit the common shape, by reason, malformed JSON among them."""
    return raw_rows.rejected(_shops(spark, sf_dir))


@query(sql_over("market_items", """,
seen AS (SELECT 0 AS batch, * FROM market_items WHERE seller_id % 2 = 0 UNION ALL SELECT 1, * FROM market_items WHERE status = 'ACTIVE'),
header AS (SELECT batch, model_no, count(*) AS n_results, min(current_price) AS floor_price FROM seen GROUP BY 1, 2),
state AS (SELECT model_no, max(batch) AS last_batch FROM header GROUP BY 1)
SELECT h.model_no, CAST(batch AS BIGINT) AS batch, n_results, floor_price, n_results AS n_details, CAST(last_batch AS BIGINT) AS last_batch FROM header AS h JOIN state USING (model_no)"""))
def saved_snapshots(spark, sf_dir):
    """SNK-14: header, details and state of each snapshot saved as one; the first batch is saved twice. Read back together."""
    base = sinks.new_path(spark, "snapshots")
    items = domain.market_items(spark, sf_dir)
    for number, rows in ((0, items.filter("seller_id % 2 = 0")), (0, items.filter("seller_id % 2 = 0")), (1, items.filter("status = 'ACTIVE'"))):
        header = rows.groupBy("model_no").agg(F.count("*").alias("n_results"), F.min("current_price").alias("floor_price"))
        details = rows.select("model_no", "item_id", F.col("current_price").alias("price"))
        sinks.composite_save({"header": header, "details": details, "state": header.select("model_no")}, base, number)
    header = sinks.composite_read(spark, base, "header", "model_no string, n_results long, floor_price long")
    details = sinks.composite_read(spark, base, "details", "model_no string, item_id string, price long").groupBy("model_no", "batch").agg(F.count("*").alias("n_details"))
    state = sinks.composite_read(spark, base, "state", "model_no string").groupBy("model_no").agg(F.max("batch").alias("last_batch"))
    return header.join(details, ["model_no", "batch"]).join(state, "model_no")


@query("""
SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE lower(c_name) LIKE '%17%' OR lower(c_mktsegment) LIKE '%17%' OR lower(n_name) LIKE '%17%' OR CAST(c_custkey AS VARCHAR) LIKE '%17%' OR CAST(c_acctbal AS VARCHAR) LIKE '%17%'""")
def five_column_search(spark, sf_dir):
    """FLT-02: one text in any of five columns."""
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.select("c_custkey", "c_name", "c_mktsegment", "n_name", F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").cast("string").alias("balance"))
    return filters.search(rows, text="17", columns=("c_name", "c_mktsegment", "n_name", "id", "balance")).select("c_custkey")


@query(sql_over("listings", """,
p AS (SELECT listing_id, paths || '/' || category_name || CASE WHEN listing_id % 3 = 0 THEN '/100%_wool' WHEN listing_id % 3 = 1 THEN '/100x_wool' ELSE '' END AS path FROM listings)
SELECT listing_id, path LIKE 'SMALL/%' AS starts, contains(path, '%_') AS signs, len(string_split(path, '/')) = 3 AS deep FROM p WHERE contains(path, 'ol')"""))
def like_forms(spark, sf_dir):
    """FLT-11: contains, prefix, escaped signs of patterns, and levels of a path."""
    k = F.col("listing_id")
    more = F.when(k % 3 == 0, "/100%_wool").when(k % 3 == 1, "/100x_wool").otherwise("")
    p = domain.listings(spark, sf_dir).select(k, F.concat(F.concat_ws("/", "paths", "category_name"), more).alias("path")).filter(filters.like(F.col("path"), "ol", "contains"))
    return p.select("listing_id", filters.like(F.col("path"), "SMALL/", "prefix").alias("starts"), filters.like(F.col("path"), "%_", "contains").alias("signs"), filters.path_level(F.col("path"), 3).alias("deep"))


@query("SELECT user_id, CASE WHEN user_id % 4 = 0 THEN NULL ELSE max(ts) + INTERVAL 5 DAY END AS due_at FROM events GROUP BY user_id HAVING user_id % 4 = 0 OR max(ts) + INTERVAL 5 DAY <= TIMESTAMP '2024-02-04 12:00:00'")
def due_or_never_seen(spark, sf_dir):
    """FLT-20: keys whose time has come, and those that have none yet."""
    last = read(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("at"))
    due = F.when(F.col("user_id") % 4 != 0, F.col("at") + F.make_dt_interval(F.lit(5)))
    return last.select("user_id", due.alias("due_at")).filter(filters.due(F.col("due_at"), "2024-02-04 12:00:00"))


@query(sql_over("listings", """
SELECT listing_id, CASE WHEN is_active = 0 THEN 'retired' WHEN sold > 20 THEN 'sold out' ELSE 'left over' END AS residue FROM listings
WHERE is_published = 0 AND listing_id % 3 <> 0"""))
def unpublished_residue(spark, sf_dir):
    """FLT-25: listings that are unpublished but keep their id at the market, by what they are left over from."""
    rows = domain.listings(spark, sf_dir).withColumn("market_id", F.when(F.col("listing_id") % 3 != 0, F.col("listing_id")))
    kind = F.when(F.col("is_active") == 0, "retired").when(F.col("sold") > 20, "sold out").otherwise("left over")
    return rows.filter("is_published = 0 AND market_id IS NOT NULL").select("listing_id", kind.alias("residue"))


@query("""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*/?', '') AS path FROM pages)
SELECT page_id, path, regexp_extract(rtrim(path, '/'), '[^/]*$') AS last FROM p""")
def url_paths(spark, sf_dir):
    """STRF-23: a URL's path, and its last part as a key."""
    path = text.url_path(F.col("url"))
    key = F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)
    return read(spark, sf_dir, "pages").select("page_id", path.alias("path"), key.alias("last"))


@query(sql_over("offerings", """
SELECT DISTINCT o.offering_id, o.source_site, o.purchase_price FROM offerings AS o"""))
def tabbed_and_read(spark, sf_dir):
    """SRC-10, SNK-17: rows as tab-separated text with a header read back, half of them by way of a log of JSON lines."""
    rows = domain.offerings(spark, sf_dir).select("offering_id", "source_site", "purchase_price")
    base = sinks.new_path(spark, "tabs")
    rows.filter("offering_id % 2 = 0").write.option("header", True).option("sep", "\t").csv(f"{base}/tabs")
    for k in (1, 3):  # the log grows, it isn't replaced
        sinks.json_lines(rows.filter(f"offering_id % 4 = {k}"), f"{base}/log")
    schema = "offering_id long, source_site string, purchase_price long"
    return files.csv_table(spark, f"{base}/tabs", schema, sep="\t").unionByName(spark.read.schema(schema).json(f"{base}/log"))


@query(sql_over("listings", "SELECT listing_id, price, CASE WHEN is_published = 1 THEN model_no END AS model_no FROM listings"))
def exported_scripts(spark, sf_dir):
    """SNK-15: rows exported as scripts that add JSON arrays to a list, and read back from them."""
    path = f"{sinks.new_path(spark, 'scripts')}/export"
    rows = domain.listings(spark, sf_dir).select("listing_id", "price", F.when(F.col("is_published") == 1, F.col("model_no")).alias("model_no"))
    sinks.json_export(rows, path, "listings", 500)
    array = F.regexp_extract("value", r"^window\.listings = \(window\.listings \|\| \[\]\)\.concat\((\[.*\])\);$", 1)
    read_ = spark.read.text(path).select(F.explode(F.from_json(array, "array<struct<listing_id:long,price:long,model_no:string>>")).alias("r"))
    return read_.select("r.*")


@query("""
WITH base AS (SELECT c_custkey % 50 AS owner, 'tab ' || c_custkey % 7 AS name, max(c_custkey) AS version FROM customer WHERE c_custkey % 3 <> 2 GROUP BY 1, 2),
gone AS (SELECT DISTINCT c_custkey % 50 AS owner, 'tab ' || c_custkey % 7 AS name FROM customer WHERE c_custkey % 3 = 2 AND c_custkey % 5 = 0)
SELECT owner, name, CASE WHEN owner % 2 = 0 THEN upper(name) ELSE name END AS title, version FROM base WHERE NOT EXISTS (SELECT 1 FROM gone AS g WHERE g.owner = base.owner AND g.name = base.name)""")
def saved_tabs(spark, sf_dir):
    """SNK-20: saved filters that are made, changed, renamed and deleted; a key is an owner and a name."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    keys = [(k % 50).alias("owner"), F.concat(F.lit("tab "), k % 7).alias("name")]
    made = c.filter(k % 3 == 0).groupBy(*keys).agg(F.max(k).alias("version"))
    changed = c.filter(k % 3 == 1).groupBy(*keys).agg(F.max(k).alias("version"))
    best = made.unionByName(changed).groupBy("owner", "name").agg(F.max("version").alias("version"))
    table = relational.upsert(relational.insert_absent(made, changed, ["owner", "name"]), best, ["owner", "name"])
    renamed = table.filter("owner % 2 = 0").select("owner", "name", F.upper("name").alias("title"))
    table = relational.upsert(table.withColumn("title", F.col("name")), renamed, ["owner", "name"])
    gone = c.filter((k % 3 == 2) & (k % 5 == 0)).select(*keys).distinct()
    return table.join(gone, ["owner", "name"], "left_anti").select("owner", "name", "title", "version")


@query("""
WITH r AS (
  SELECT c_custkey AS id, c_nationkey % 5 AS store, c_mktsegment AS label,
         CASE c_custkey % 6 WHEN 0 THEN ' ' WHEN 1 THEN lower(c_mktsegment) || ' Co' WHEN 2 THEN '브랜드' || c_custkey WHEN 3 THEN ' Maker ' || c_custkey % 7 WHEN 4 THEN '***' ELSE c_mktsegment END AS maker FROM customer),
c AS (SELECT DISTINCT c_nationkey % 5 AS store, CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE 'MAKER-' || c_custkey % 7 END AS name, 'Maker ' || c_custkey % 7 AS english FROM customer WHERE (c_custkey % 7 + c_nationkey % 5) % 2 = 0),
j AS (SELECT r.*, coalesce(c.name, c.english) AS spelling FROM r LEFT JOIN c ON c.store = r.store AND trim(maker) = c.english)
SELECT id, CASE id % 6 WHEN 0 THEN 'missing' WHEN 1 THEN 'keep' WHEN 2 THEN 'hangul' WHEN 4 THEN 'missing' WHEN 5 THEN 'keep' ELSE CASE WHEN spelling IS NULL THEN 'unmapped' ELSE 'replaced' END END AS outcome,
       CASE WHEN id % 6 <> 3 THEN label ELSE coalesce(spelling, trim(maker)) END AS label FROM j""")
def label_buckets(spark, sf_dir):
    """JOI-33: labels kept, replaced by the catalogue's spelling, or put apart as unmapped, in Hangul, or without a maker."""
    c = read(spark, sf_dir, "customer")
    i, store, k = F.col("c_custkey"), F.col("c_nationkey") % 5, F.col("c_custkey") % 7
    maker = (
        F.when(i % 6 == 0, " ")
        .when(i % 6 == 1, F.concat(F.lower("c_mktsegment"), F.lit(" Co")))
        .when(i % 6 == 2, F.concat(F.lit("브랜드"), i))
        .when(i % 6 == 3, F.concat(F.lit(" Maker "), k))
        .when(i % 6 == 4, "***")
        .otherwise(F.col("c_mktsegment"))
    )
    rows = c.select(i.alias("id"), store.alias("store"), F.col("c_mktsegment").alias("label"), maker.alias("maker"))
    listed = c.filter((k + store) % 2 == 0).select(store.alias("store"), F.when(k != 3, F.concat(F.lit("MAKER-"), k)).alias("name"), F.concat(F.lit("Maker "), k).alias("english"))
    return lookups.corrected_labels(rows, listed)


@query("""
WITH brands AS (SELECT CAST(substr(p_brand, 7) AS BIGINT) AS key, list(p_type ORDER BY first) AS types FROM (SELECT p_brand, p_type, min(p_partkey) AS first FROM part GROUP BY 1, 2) AS x GROUP BY 1)
SELECT 'list' AS shape, CAST(key AS VARCHAR) AS key, array_to_string(types, ' ') AS value FROM brands
UNION ALL SELECT 'url', url, NULL FROM pages WHERE url LIKE 'http%'
UNION ALL SELECT 'item', CAST(s_suppkey AS VARCHAR), s_name || ' 2001-11-05' FROM supplier""")
def file_shapes(spark, sf_dir):
    """SRC-09, SRC-11, SRC-12: a positional CSV gathered into lists, a list of URLs, and a JSON document, written and read back."""
    base = sinks.new_path(spark, "shapes")
    part = read(spark, sf_dir, "part").select(F.substring("p_brand", 7, 9).alias("k"), F.lit("-").alias("skipped"), "p_type", "p_partkey")
    # One file in order of the parts, below a header that is no number.
    header = spark.createDataFrame([("number", "-", "type", -1)], part.schema)
    header.unionByName(part).coalesce(1).sortWithinPartitions("p_partkey").drop("p_partkey").write.csv(f"{base}/lists")
    lists = files.keyed_lists(spark, f"{base}/lists", 0, 2).select(F.lit("list").alias("shape"), F.col("key").cast("string").alias("key"), F.array_join("values", " ").alias("value"))
    urls = read(spark, sf_dir, "pages").select(F.concat(F.lit(" "), "url").alias("value"))
    urls.unionByName(spark.createDataFrame([("URL",), ("",)], "value string")).write.text(f"{base}/urls")
    seen = files.urls(spark, f"{base}/urls").select(F.lit("url").alias("shape"), F.col("url").alias("key"), F.lit(None).cast("string").alias("value"))
    rows = read(spark, sf_dir, "supplier").groupBy(F.pmod("s_suppkey", F.lit(4)).alias("n")).agg(F.collect_list(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))).alias("items"))
    rows.select(F.lit("2001-11-05").alias("collected_at"), "items").write.json(f"{base}/documents")
    items = files.items_of(spark, f"{base}/documents", "id:long,name:string", lines=True)
    items = items.select(F.lit("item").alias("shape"), F.col("id").cast("string").alias("key"), F.concat_ws(" ", "name", "collected_at").alias("value"))
    return lists.unionByName(seen).unionByName(items)


@query(sql_over("offerings", """,
old AS (SELECT offering_id, listing_id, source_site, purchase_price AS price, 'old' AS note FROM offerings WHERE source_site <> 's3'),
found AS (SELECT offering_id, listing_id, source_site, purchase_price + 1 AS price, 'new' AS note FROM offerings WHERE listing_id % 5 = 0 OR source_site = 's3'),
added AS (SELECT * FROM old UNION ALL SELECT * FROM found WHERE offering_id NOT IN (SELECT offering_id FROM old)),
children AS (SELECT * FROM found WHERE listing_id % 10 = 0),
replaced AS (SELECT * FROM added WHERE listing_id NOT IN (SELECT listing_id FROM children) UNION ALL SELECT * FROM children)
SELECT offering_id, listing_id, source_site, CASE WHEN offering_id % 7 = 0 THEN NULL ELSE price END AS price, CASE WHEN offering_id % 9 = 0 THEN 'checked' ELSE note END AS note FROM replaced"""))
def edited_offers(spark, sf_dir):
    """SNK-03, SNK-05, SNK-19: rows added where absent, children of a listing replaced, and cells edited in the columns that may be."""
    o = domain.offerings(spark, sf_dir).select("offering_id", "listing_id", "source_site", F.col("purchase_price").alias("price"))
    old = o.filter("source_site <> 's3'").withColumn("note", F.lit("old"))
    found = o.filter("listing_id % 5 = 0 OR source_site = 's3'").withColumn("price", F.col("price") + 1).withColumn("note", F.lit("new"))
    table = relational.replace_children(relational.insert_absent(old, found, ["offering_id"]), found.filter("listing_id % 10 = 0"), "listing_id")
    cell = lambda k, column, value: table.filter(f"offering_id % {k} = 0").select("offering_id", F.lit(column).alias("column"), F.lit(value).alias("value"))
    changes = cell(7, "price", " ").unionByName(cell(9, "note", "checked")).unionByName(cell(3, "source_site", "not allowed"))
    return sinks.edited(table, changes, "offering_id", ["price", "note"])


@query("""
WITH o AS (SELECT o_orderkey AS k, o_orderdate AS d, CASE o_orderkey % 3 WHEN 0 THEN '+09:00' WHEN 1 THEN 'Z' ELSE '' END AS zone FROM orders)
SELECT k, strftime(d + INTERVAL 1 DAY * (k % 40), '%Y-%m-%dT%H:%M:%S') || zone AS moved, CASE WHEN k % 4 = 3 THEN NULL ELSE d + INTERVAL 1 MINUTE * CASE WHEN k % 4 = 1 THEN 65 ELSE 0 END END AS parsed FROM o""")
def date_texts(spark, sf_dir):
    """DAT-02, DAT-06: ISO texts moved by days with their offsets kept, and dates in several forms read."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    zone = F.when(k % 3 == 0, "+09:00").when(k % 3 == 1, "Z").otherwise("")
    iso = F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), zone)
    said = F.when(k % 4 == 0, F.date_format(d, "yyyy/MM/dd")).when(k % 4 == 1, F.concat(F.date_format(d, "yyyy/MM/dd"), F.lit(" 1:05"))).when(k % 4 == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).otherwise("soon")
    return read(spark, sf_dir, "orders").select(k.alias("k"), dates.iso_plus_days(iso, k % 40).alias("moved"), dates.any_timestamp(said).cast("timestamp_ntz").alias("parsed"))


@query("SELECT listing_id, CASE WHEN price <= 0 THEN NULL ELSE CAST(trunc((price * 10.0::DOUBLE + 3000 - price * 10.0::DOUBLE / 11) / (1 - 0.05::DOUBLE - 0.25::DOUBLE) / 9.0::DOUBLE) AS BIGINT) END AS target FROM (SELECT p_partkey AS listing_id, p_partkey * 7919 % 130000 AS price FROM part) AS l")
def tuned_targets(spark, sf_dir):
    """UDF-05: target prices under parameters that a table overrides; rows of unknown names count nothing."""
    rows = spark.createDataFrame([("fee", "0.05"), ("margin_rate", "0.25"), ("rate", "9.0"), ("color", "red")], "param_key string, value string")
    p = config.from_rows(config.MoneyParams, rows)
    l = domain.listings(spark, sf_dir)
    return l.select("listing_id", money.target_price(F.col("price") * 10, F.lit(3000), p).alias("target"))
