"""Queries of the selection rules: gates, candidates, exclusions, orders of work, images, documents and retirements."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlane.operators import selection
from marketlane.plans import query
from marketlane.sources import domain
from marketlane.sources.domain import AS_OF, read, sql_over

_REVIEWED = "reviewed AS (SELECT paths, CASE WHEN max(fav) > 50 THEN 1 ELSE 0 END AS flag FROM listings WHERE is_published = 1 GROUP BY paths)"


@query(sql_over("listings", f""", {_REVIEWED}
SELECT 'flow' AS kind, CAST(listing_id AS VARCHAR) AS what FROM listings WHERE paths IN (SELECT paths FROM reviewed WHERE flag = 1)
UNION ALL SELECT DISTINCT 'queue', paths FROM listings WHERE paths NOT IN (SELECT paths FROM reviewed)"""))
def review_gate(spark, sf_dir):
    """FLT-15: only approved categories flow; unknown ones are queued for review."""
    rows = domain.listings(spark, sf_dir)
    reviewed = rows.filter("is_published = 1").groupBy("paths").agg(F.when(F.max("fav") > 50, 1).otherwise(0).alias("flag"))
    flow, queue = selection.gated(rows, reviewed, "paths", "flag")
    named = flow.select(F.lit("flow").alias("kind"), F.col("listing_id").cast("string").alias("what"))
    return named.unionAll(queue.select(F.lit("queue").alias("kind"), F.col("paths").alias("what")))


@query(sql_over("listings", """,
raw AS (SELECT l_partkey AS listing_id, CAST(max(l_shipdate) AS DATE) AS updated_on FROM lineitem GROUP BY 1)
SELECT r.listing_id, l.listing_id IS NULL AS is_new FROM raw AS r LEFT JOIN (SELECT * FROM listings WHERE is_active = 1) AS l ON r.listing_id = l.listing_id
WHERE l.listing_id IS NULL OR (l.is_published = 0 AND r.updated_on > l.listed_on)"""))
def conversion_candidates(spark, sf_dir):
    """FLT-17: raw rows that were never converted, or are not registered and newer than their conversion."""
    raw = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("listing_id")).agg(F.max("l_shipdate").cast("date").alias("updated_on"))
    done = domain.listings(spark, sf_dir).filter("is_active = 1").select("listing_id", "is_published", "listed_on", F.lit(True).alias("converted"))
    joined = raw.join(done, "listing_id", "left")
    return joined.filter("converted IS NULL OR (is_published = 0 AND updated_on > listed_on)").select("listing_id", F.col("converted").isNull().alias("is_new"))


_EXCLUDED = {"s1": ["steel"], "s2": ["tin", "brass"], "s5": ["Copper"]}


@query(sql_over("listings offerings", """,
rules(site, word) AS (VALUES ('s1', 'steel'), ('s2', 'tin'), ('s2', 'brass'), ('s5', 'copper'))
SELECT o.offering_id FROM offerings AS o JOIN listings AS l ON o.listing_id = l.listing_id
WHERE NOT EXISTS (SELECT 1 FROM rules WHERE site = o.source_site AND (contains(lower(l.category_name), word) OR contains(lower(l.paths), word)))"""))
def store_keyword_exclusion(spark, sf_dir):
    """FLT-18: offers left after each store's own words, looked for in category and name."""
    rows = domain.offerings(spark, sf_dir).join(domain.listings(spark, sf_dir).select("listing_id", "category_name", "paths"), "listing_id")
    return rows.filter(~selection.keyword_excluded(_EXCLUDED, F.col("source_site"), F.col("category_name"), F.col("paths"))).select("offering_id")


@query(sql_over("listings offerings", """
SELECT listing_id FROM listings AS l WHERE is_published = 0 AND is_active = 1 AND price > 0 AND paths <> 'none/none' AND brand_name NOT LIKE 'Unknown%'
AND EXISTS (SELECT 1 FROM offerings AS o WHERE o.listing_id = l.listing_id AND o.is_active = 1 AND o.shipping IS NOT NULL)"""))
def registerable(spark, sf_dir):
    """FLT-19: the conjunction a product has to pass before it is registered."""
    own = (F.col("is_published") == 0) & (F.col("is_active") == 1) & (F.col("price") > 0) & (F.col("paths") != "none/none") & ~F.col("brand_name").startswith("Unknown")
    offers = domain.offerings(spark, sf_dir).filter("is_active = 1 AND shipping IS NOT NULL")
    return domain.listings(spark, sf_dir).filter(own).join(offers, "listing_id", "left_semi").select("listing_id")


@query(sql_over("listings", f"""
SELECT listing_id, coalesce(CASE WHEN listing_id % 4 = 0 THEN listed_on + 60 END, listed_on + 90) AS due_on FROM listings
WHERE is_published = 1 AND coalesce(CASE WHEN listing_id % 4 = 0 THEN listed_on + 60 END, listed_on + 90) <= DATE '{AS_OF}' + 7"""))
def expiring_listings(spark, sf_dir):
    """FLT-21: published listings whose own or usual end lies within a week."""
    own = F.when(F.col("listing_id") % 4 == 0, F.date_add("listed_on", 60))
    due = domain.listings(spark, sf_dir).withColumn("due_on", F.coalesce(own, F.date_add("listed_on", 90)))
    return due.filter((F.col("is_published") == 1) & (F.col("due_on") <= F.date_add(F.lit(AS_OF).cast("date"), 7))).select("listing_id", "due_on")


@query(sql_over("listings offerings", """
SELECT model_no, count(DISTINCT o.source_site) AS sources, min(o.purchase_price) AS cheapest FROM listings AS l JOIN offerings AS o ON l.listing_id = o.listing_id
WHERE o.is_active = 1 AND o.purchase_price > 0 AND l.model_no NOT IN (SELECT model_no FROM listings WHERE is_published = 1)
GROUP BY model_no HAVING count(DISTINCT o.source_site) >= 2"""))
def group_candidates(spark, sf_dir):
    """FLT-22: models of several sources with offers to buy, none of which is published."""
    rows = domain.listings(spark, sf_dir)
    offers = domain.offerings(spark, sf_dir).filter("is_active = 1 AND purchase_price > 0").select("listing_id", "source_site", "purchase_price")
    free = rows.join(rows.filter("is_published = 1").select("model_no"), "model_no", "left_anti").join(offers, "listing_id")
    return free.groupBy("model_no").agg(F.countDistinct("source_site").alias("sources"), F.min("purchase_price").alias("cheapest")).filter("sources >= 2")


@query(sql_over("listings offerings", """,
live AS (SELECT DISTINCT listing_id FROM offerings WHERE is_active = 1)
SELECT listing_id, 'new' AS kind FROM listings WHERE is_published = 0 AND listing_id IN (SELECT listing_id FROM live)
AND model_no NOT IN (SELECT model_no FROM listings WHERE is_published = 1)
UNION ALL SELECT listing_id, 'edit' FROM listings WHERE is_published = 1 AND (is_active = 0 OR listing_id NOT IN (SELECT listing_id FROM live))"""))
def clean_new_and_edit(spark, sf_dir):
    """FLT-23: listings to publish for the first time, and published ones that have to change."""
    rows = domain.listings(spark, sf_dir)
    live = domain.offerings(spark, sf_dir).filter("is_active = 1").select("listing_id").distinct().withColumn("live", F.lit(True))
    new = rows.filter("is_published = 0").join(live, "listing_id", "left_semi").join(rows.filter("is_published = 1").select("model_no"), "model_no", "left_anti")
    edit = rows.filter("is_published = 1").join(live, "listing_id", "left").filter("is_active = 0 OR live IS NULL")
    return new.select("listing_id", F.lit("new").alias("kind")).unionAll(edit.select("listing_id", F.lit("edit").alias("kind")))


@query("""
SELECT c_custkey, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment = 'BUILDING' OR (c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') AND n_nationkey = 7)""")
def seller_filter(spark, sf_dir):
    """FLT-24: all sellers of one kind, those of other kinds from one country only."""
    rows = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.col("c_mktsegment")
    return rows.filter((kind == "BUILDING") | (kind.isin("MACHINERY", "HOUSEHOLD") & (F.col("n_nationkey") == 7))).select("c_custkey", "c_mktsegment", "n_name")


@query(sql_over("listings", """
SELECT listing_id, CASE WHEN regexp_matches(split_part(brand_name, '(', 1), '^[A-Za-z0-9# ]+$') AND brand_name NOT LIKE 'Unknown%' THEN split_part(brand_name, '(', 1)
  WHEN paths <> 'none/none' THEN paths ELSE 'NO BRAND' END AS brand_en FROM listings"""))
def brand_name_chain(spark, sf_dir):
    """PRJ-04: the first candidate that passes its own test."""
    name, paths = F.substring_index("brand_name", "(", 1), F.col("paths")
    chain = selection.first_valid((name, name.rlike("^[A-Za-z0-9# ]+$") & ~F.col("brand_name").startswith("Unknown")), (paths, paths != "none/none"), (F.lit("NO BRAND"), F.lit(True)))
    return domain.listings(spark, sf_dir).select("listing_id", chain.alias("brand_en"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'DELETED' WHEN value > 90 THEN 'SOLD_OUT' ELSE 'ACTIVE' END AS status FROM events""")
def answer_status(spark, sf_dir):
    """PRJ-05: answer codes as item status; an unknown code fails the query."""
    code = F.when(F.col("event_type") == "error", 404).when(F.col("value") > 90, 410).otherwise(200)
    return read(spark, sf_dir, "events").select("event_id", selection.item_status(code).alias("status"))


@query("SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2, 3")
def scan_report(spark, sf_dir):
    """AGG-12: counts by three columns."""
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"))


@query(sql_over("offerings", """
SELECT offering_id, row_number() OVER (ORDER BY coalesce(shipping, 999999), is_published, offering_id) AS place FROM offerings
ORDER BY coalesce(shipping, 999999), is_published, offering_id LIMIT 10000"""))
def scheduled_batch(spark, sf_dir):
    """SRT-08, SRT-10: a batch of at most 10,000, by a triple in which null counts as late; a key settles ties."""
    order = [F.coalesce("shipping", F.lit(999999)), F.col("is_published"), F.col("offering_id")]
    batch = domain.offerings(spark, sf_dir).orderBy(*order).limit(10000)
    return batch.select("offering_id", F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"))


@query("SELECT p_partkey, p_name, length(p_name) AS size FROM part ORDER BY length(p_name), p_name, p_partkey LIMIT 20")
def shortest_names(spark, sf_dir):
    """SRT-11: a report of the 20 shortest names."""
    return read(spark, sf_dir, "part").select("p_partkey", "p_name", F.length("p_name").cast("long").alias("size")).orderBy("size", "p_name", "p_partkey").limit(20)


def _images(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    url = F.concat(F.lit("https://img/"), F.col("l_partkey"), F.lit("/"), F.col("l_suppkey"), F.lit("-"), F.col("l_linenumber"))
    return lines.select(F.col("l_partkey").alias("listing_id"), F.col("l_suppkey").alias("supplier"), url.alias("url"), "l_linenumber", "l_quantity")


_IMAGES = "images AS (SELECT l_partkey AS listing_id, l_suppkey AS supplier, 'https://img/' || l_partkey || '/' || l_suppkey || '-' || l_linenumber AS url, l_linenumber, l_quantity FROM lineitem)"


@query(f"""WITH {_IMAGES}, blocked AS (SELECT DISTINCT url FROM images WHERE l_quantity = 50)
SELECT i.listing_id, count(b.url) AS blocked, count(*) - count(b.url) AS remaining FROM (SELECT DISTINCT listing_id, url FROM images) AS i LEFT JOIN blocked AS b ON i.url = b.url GROUP BY 1""")
def blocked_images(spark, sf_dir):
    """JOI-31, AGG-35: images against blocked urls, counted by listing."""
    images = _images(spark, sf_dir)
    blocked = images.filter("l_quantity = 50").select("url").distinct().withColumn("blocked", F.lit(1))
    joined = images.select("listing_id", "url").distinct().join(blocked, "url", "left")
    return joined.groupBy("listing_id").agg(F.count("blocked").alias("blocked"), F.count_if(F.col("blocked").isNull()).alias("remaining"))


@query(f"""WITH {_IMAGES},
members AS (SELECT listing_id, supplier, count(DISTINCT url) AS images, row_number() OVER (PARTITION BY listing_id ORDER BY sum(l_quantity), supplier) = 1 AS is_winner, supplier % 7 AS priority FROM images GROUP BY 1, 2)
SELECT listing_id, donor_id FROM (SELECT listing_id, supplier AS donor_id, row_number() OVER (PARTITION BY listing_id ORDER BY (is_winner AND images > 3) DESC, images DESC, is_winner DESC, priority, supplier DESC) AS nth FROM members) AS x WHERE nth = 1""")
def image_donors(spark, sf_dir):
    """WIN-13: whose images a group takes."""
    sums = _images(spark, sf_dir).groupBy("listing_id", "supplier").agg(F.countDistinct("url").alias("images"), F.sum("l_quantity").alias("q"))
    first = F.row_number().over(Window.partitionBy("listing_id").orderBy("q", "supplier")) == 1
    members = sums.select("listing_id", F.col("supplier").alias("member_id"), "images", first.alias("is_winner"), (F.col("supplier") % 7).alias("priority"))
    return selection.donors(members, "listing_id", 3)


@query(f"""WITH {_IMAGES},
known AS (SELECT listing_id, url, row_number() OVER (PARTITION BY listing_id ORDER BY url) AS place FROM (SELECT DISTINCT listing_id, url FROM images WHERE l_linenumber <= 2) AS k),
fresh AS (SELECT DISTINCT listing_id, url FROM images WHERE (listing_id, url) NOT IN (SELECT (listing_id, url) FROM known)),
placed AS (SELECT f.listing_id, f.url, row_number() OVER (PARTITION BY f.listing_id ORDER BY f.url) + coalesce(m.last, 0) AS place FROM fresh AS f LEFT JOIN (SELECT listing_id, max(place) AS last FROM known GROUP BY 1) AS m ON f.listing_id = m.listing_id)
SELECT listing_id, url, CAST(place AS INTEGER) AS place FROM placed WHERE place <= 20""")
def appended_images(spark, sf_dir):
    """WIN-15: places of new images after those there are, at most 20 in all."""
    images = _images(spark, sf_dir)
    nth = F.row_number().over(Window.partitionBy("listing_id").orderBy("url"))
    known = images.filter("l_linenumber <= 2").select("listing_id", "url").distinct().withColumn("place", nth)
    return selection.appended(known, images.select("listing_id", "url").distinct(), "listing_id", "url", "place", 20)


@query(sql_over("offerings", """,
children AS (SELECT listing_id, offering_id, is_active FROM offerings WHERE is_published = 0), active AS (SELECT listing_id, offering_id FROM offerings WHERE is_active = 1 AND shipping IS NOT NULL)
SELECT coalesce(c.offering_id, a.offering_id) AS offering_id, CASE WHEN a.offering_id IS NULL THEN 0 ELSE 1 END AS is_active FROM children AS c FULL JOIN active AS a ON c.offering_id = a.offering_id"""))
def soft_replaced(spark, sf_dir):
    """SNK-08: all children go inactive, those of the new set are active or added."""
    rows = domain.offerings(spark, sf_dir)
    active = rows.filter("is_active = 1 AND shipping IS NOT NULL").select("offering_id", F.lit(1).alias("on"))
    return rows.filter("is_published = 0").select("offering_id").join(active, "offering_id", "full_outer").select("offering_id", F.coalesce("on", F.lit(0)).alias("is_active"))


@query(sql_over("listings market_items", """
SELECT listing_id FROM listings WHERE model_no IN (SELECT model_no FROM market_items WHERE status = 'ACTIVE') AND lower(trim(category_name)) NOT LIKE '%blue%'"""))
def kept_after_deletes(spark, sf_dir):
    """SNK-10, SNK-11: what is left after a delete by anti join on a keep-set and one by a normalised predicate."""
    keep = domain.market_items(spark, sf_dir).filter("status = 'ACTIVE'").select("model_no")
    return domain.listings(spark, sf_dir).join(keep, "model_no", "left_semi").filter(~F.lower(F.trim("category_name")).contains("blue")).select("listing_id")


@query(sql_over("listings offerings", """,
origins AS (SELECT listing_id, listed_on AS up_on, 1 AS origin FROM listings WHERE is_published = 1 UNION ALL SELECT listing_id, DATE '2001-01-01', 2 FROM offerings WHERE is_published = 1)
SELECT listing_id, up_on, origin FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY origin, up_on) AS nth FROM origins) AS x WHERE nth = 1"""))
def work_table(spark, sf_dir):
    """SNK-13, SET-07: rows of two origins by key; on a conflict the first origin's row stays."""
    own = domain.listings(spark, sf_dir).filter("is_published = 1").select("listing_id", F.col("listed_on").alias("up_on"), F.lit(1).alias("origin"))
    more = domain.offerings(spark, sf_dir).filter("is_published = 1").select("listing_id", F.lit("2001-01-01").cast("date").alias("up_on"), F.lit(2).alias("origin"))
    first = F.min(F.struct("origin", "up_on")).alias("first")
    return own.unionAll(more).groupBy("listing_id").agg(first).select("listing_id", "first.up_on", "first.origin")


@query(sql_over("offering_options", """,
docs AS (SELECT offering_id, to_json(list(struct_pack(color := color, size := size, stock := in_stock) ORDER BY color, size)) AS options FROM offering_options GROUP BY offering_id)
SELECT offering_id, CAST(options AS VARCHAR) AS options, '{"id":' || offering_id || ',"options":[]}' AS blanked, offering_id % 5 <> 0 AS valid FROM docs"""))
def json_documents(spark, sf_dir):
    """JSN-02, JSN-03, JSN-05: arrays of structs as text, one array of a document blanked, malformed documents told apart."""
    option = F.struct("color", "size", F.col("in_stock").alias("stock"))
    rows = domain.offering_options(spark, sf_dir).groupBy("offering_id").agg(F.sort_array(F.collect_list(option)).alias("o"))
    whole = F.to_json(F.struct(F.col("offering_id").alias("id"), F.col("o").alias("options")))
    # The text is made once a row, as several columns read it; what is blanked isn't read from it.
    rows = rows.select("offering_id", "o", whole.alias("whole"))
    blank = F.to_json(F.from_json("whole", "id bigint").withField("options", F.array().cast("array<struct<color:string,size:string,stock:bigint>>")))
    broken = F.when(F.col("offering_id") % 5 == 0, F.substring("whole", 1, 12)).otherwise(F.col("whole"))
    return rows.select("offering_id", F.to_json("o").alias("options"), blank.alias("blanked"), F.try_parse_json(broken).isNotNull().alias("valid"))


@query(sql_over("market_items", """
SELECT item_id, trim(split_part(category_path, ' > ', 2)) AS depth1, nullif(trim(split_part(category_path, ' > ', 3)), '') AS depth2, nullif(trim(split_part(category_path, ' > ', 4)), '') AS depth3,
       CASE WHEN contains(lower(category_path), 'women') THEN 'F' WHEN contains(lower(category_path), 'men') THEN 'M' ELSE 'U' END AS gender,
       len(list_filter(string_split(model_no, ' '), lambda x: regexp_matches(x, '[0-9]'))) >= 0.5 * len(string_split(model_no, ' ')) AS mostly_numbers FROM market_items"""))
def path_depths(spark, sf_dir):
    """ARR-03, ARR-05: levels of a category path with the gender it names; is half of a list of a kind?"""
    parts, path = F.split("category_path", " > "), F.lower("category_path")
    level = lambda k: F.nullif(F.trim(F.get(parts, F.lit(k))), F.lit(""))
    words = F.split("model_no", " ")
    gender = F.when(path.contains("women"), "F").when(path.contains("men"), "M").otherwise("U")
    mostly = F.size(F.filter(words, lambda x: x.rlike("[0-9]"))) >= 0.5 * F.size(words)
    return domain.market_items(spark, sf_dir).select("item_id", level(1).alias("depth1"), level(2).alias("depth2"), level(3).alias("depth3"), gender.alias("gender"), mostly.alias("mostly_numbers"))


@query("""
WITH m AS (SELECT p_partkey, unnest(['len', 'wid', 'zip']) AS name, unnest([CAST(p_size AS VARCHAR) || 'cm', CAST(p_size AS VARCHAR) || '.5', 'n/a']) AS said FROM part),
d(name, detail, twice) AS (VALUES ('len', 'length', false), ('wid', 'chest', true), ('zip', NULL, false))
SELECT p_partkey, string_agg(detail || '=' || CAST(CASE WHEN twice THEN 2 ELSE 1 END * CAST(regexp_extract(said, '[0-9]+(\\.[0-9]+)?') AS DOUBLE) AS VARCHAR), ';' ORDER BY detail) AS details
FROM m JOIN d USING (name) WHERE detail IS NOT NULL GROUP BY p_partkey""")
def measurement_details(spark, sf_dir):
    """MAP-01, NUM-11: measurements renamed by a dictionary, unmapped ones skipped, numbers read, widths doubled."""
    size = F.col("p_size").cast("string")
    said = F.create_map(F.lit("len"), F.concat(size, F.lit("cm")), F.lit("wid"), F.concat(size, F.lit(".5")), F.lit("zip"), F.lit("n/a"))
    rows = read(spark, sf_dir, "part").select("p_partkey", F.explode(said).alias("name", "said"))
    names = spark.createDataFrame([("len", "length", 1), ("wid", "chest", 2), ("zip", None, 1)], "name string, detail string, times int")
    number = F.regexp_extract("said", r"([0-9]+(\.[0-9]+)?)", 1).try_cast("double") * F.col("times")
    made = rows.join(names.filter("detail IS NOT NULL"), "name").withColumn("line", F.concat("detail", F.lit("="), number.cast("string")))
    return made.groupBy("p_partkey").agg(F.array_join(F.sort_array(F.collect_list("line")), ";").alias("details"))


@query("""
SELECT p_partkey, replace(replace(replace(lower(p_name), 'dark red', 'maroon'), 'blue', 'azure'), 'red', 'crimson') AS name,
       trim(split_part('shop of ' || p_brand || ' / ' || p_type, ' / ', 1)) AS shop FROM part""")
def replaced_names(spark, sf_dir):
    """STRF-18, STRF-22: words replaced by a dictionary, the longest first; a shop's name cut from a longer text."""
    name = selection.replaced(F.lower("p_name"), {"red": "crimson", "dark red": "maroon", "blue": "azure"})
    shop = F.trim(F.substring_index(F.concat(F.lit("shop of "), F.col("p_brand"), F.lit(" / "), F.col("p_type")), " / ", 1))
    return read(spark, sf_dir, "part").select("p_partkey", name.alias("name"), shop.alias("shop"))


@query(sql_over("listings", f"SELECT listing_id, price, sold, fav, DATE '{AS_OF}' AS frozen_on FROM listings WHERE is_published = 1 AND is_active = 0"))
def retired_snapshot(spark, sf_dir):
    """DOC-03: retired rows as they were, with the day; to be appended."""
    return domain.listings(spark, sf_dir).filter("is_published = 1 AND is_active = 0").select("listing_id", "price", "sold", "fav", F.lit(AS_OF).cast("date").alias("frozen_on"))


@query("""
WITH calls AS (SELECT event_type AS caller, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
SELECT caller, coalesce(sum(n) FILTER (WHERE day = DATE '2024-01-30'), 0) AS today, round(sum(n) FILTER (WHERE day >= DATE '2024-01-23' AND day < DATE '2024-01-30') / 7.0::DOUBLE * 0.25::DOUBLE, 6) AS still_expected FROM calls GROUP BY caller""")
def call_budget(spark, sf_dir):
    """DOC-04: calls used today, and the week's daily average times the share of the day that is left."""
    day = F.col("ts").cast("date")
    week = (day >= F.lit("2024-01-23").cast("date")) & (day < F.lit("2024-01-30").cast("date"))
    today = day == F.lit("2024-01-30").cast("date")
    expected = F.round(F.nullif(F.count_if(week), F.lit(0)) / F.lit(7.0) * F.lit(0.25), 6)
    return read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("caller")).agg(F.count_if(today).alias("today"), expected.alias("still_expected"))


@query(sql_over("listings", """
SELECT round(sum(greatest(sold, 0)) / (sum(fav) / 90.0::DOUBLE), 6) AS kappa, round(sum(margin_krw * greatest(sold, 0)) / (sum(margin_krw * fav) / 90.0::DOUBLE), 6) AS c FROM listings"""))
def calibration(spark, sf_dir):
    """DOC-07: how actual orders and margins stand to what exposure predicted."""
    rows, sold = domain.listings(spark, sf_dir), F.greatest("sold", F.lit(0))
    predicted = rows.select((F.col("fav") / 90).alias("orders"), (F.col("margin_krw") * F.col("fav") / 90).alias("margin"))
    found = selection.calibrated(predicted, rows.select(sold.alias("orders"), (F.col("margin_krw") * sold).alias("margin")))
    return found.select(F.round("kappa", 6).alias("kappa"), F.round("c", 6).alias("c"))
