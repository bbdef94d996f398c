"""Records from HTML, by regular expressions in the JVM: no Python stands between the scan and the rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane.functions import text


def between(html: Column, start: str, end: str) -> Column:
    """What stands between two patterns, at their first place; null if they don't occur."""
    return F.nullif(F.regexp_extract(html, f"(?s){start}(.*?){end}", 1), F.lit(""))


def attributes(html: Column, tag: str, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(f'(?is)<{tag}\\b[^>]*?\\b{name}="([^"]*)"'), F.lit(1))


def meta(html: Column, key: str) -> Column:
    return between(html, f'<meta[^>]*(?:property|name)="{key}"[^>]*content="', '"')


def json_ld(html: Column, schema: str) -> Column:
    """Objects of linked data, from all blocks in their order; a block may be a list of them. Malformed blocks are left out.

    ``schema`` lists the fields of one object.
    """
    blocks = F.regexp_extract_all(html, F.lit(r'(?s)<script[^>]*application/ld\+json[^>]*>(.*?)</script>'), F.lit(1))
    sound = F.filter(blocks, lambda b: F.try_parse_json(b).isNotNull())
    objects = F.transform(sound, lambda b: F.from_json(F.when(b.rlike(r"^\s*\["), b).otherwise(F.concat(F.lit("["), b, F.lit("]"))), f"array<struct<{schema}>>"))
    return F.filter(F.flatten(objects), lambda x: x.isNotNull())


def plain(html: Column) -> Column:
    """Text without tags, with the five named entities read, squeezed."""
    bare = F.regexp_replace(text.blank(html), "(?s)<[^>]*>", " ")
    for name, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("amp", "&")):
        bare = F.replace(bare, F.lit(f"&{name};"), F.lit(sign))
    return text.squeezed(bare)


def said(html: Column) -> Column:
    """``plain``, null where nothing is left."""
    return some(plain(html))


def some(c: Column) -> Column:
    """A text, null where it is empty; it is computed once, also for each element of an array."""
    return text.once(c, lambda x: F.when(x != "", x))


def element(html: Column, tag: str, name: str) -> Column:
    """What the first ``tag`` of a class holds, up to its end tag."""
    return F.regexp_extract(html, rf'(?s)<{tag}\b[^>]*\bclass="(?:[^"]* )?{name}(?: [^"]*)?"[^>]*>(.*?)</{tag}>', 1)


def pieces(html: Column, tag: str, name: str) -> Column:
    """What each ``tag`` of a class holds, in the page's order."""
    opened = F.slice(F.split(html, rf'<{tag}\b[^>]*\bclass="(?:[^"]* )?{name}(?: [^"]*)?"[^>]*>'), 2, 2**30)
    return F.transform(opened, lambda x: F.substring_index(x, f"</{tag}>", 1))


def number(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(c, r"([0-9][0-9,]*)", 1), ",", "").try_cast("long")


def variants(product: Column) -> Column:
    """sku, price (or the lowest price of an offer) and the last word of the availability, from a product's variants."""
    return F.transform(product, lambda v: F.struct(v["sku"].alias("sku"), F.coalesce(v["offers"]["price"], v["offers"]["lowPrice"]).try_cast("long").alias("price"), F.substring_index(v["offers"]["availability"], "/", -1).alias("availability")))


def search_listings(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per product of a search page that links an item, ranked in the page's order."""
    products = F.slice(F.split(F.col(html), r'<li class="product">'), 2, 2**30)
    p = F.col("p")
    rows = pages.select(*[c for c in pages.columns if c != html], F.posexplode(F.filter(products, lambda x: x.rlike(r"/item/[0-9]+"))).alias("at", "p"))
    return rows.select(
        *[c for c in pages.columns if c != html],
        (F.col("at") + 1).alias("rank"),
        F.regexp_extract(p, r"/item/([0-9]+)", 1).alias("item_id"),
        number(between(p, '<span class="Price_Txt">', "</span>")).alias("price"),
        F.trim(between(p, r'<a href="[^"]*/buyer/[^"]*">', "</a>")).alias("seller_name"),
        F.nullif(F.regexp_extract(p, r"/buyer/([0-9]+)", 1), F.lit("")).alias("seller_id"),
    )


def total_results(html: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(html, r"([0-9][0-9,]*)\s*件", 1), ",", "").try_cast("long")


def titles_and_links(pages: DataFrame) -> DataFrame:
    h = F.col("html")
    return pages.select("page_id", text.squeezed(between(h, "<title>", "</title>")).alias("title"), F.size(attributes(h, "a", "href")).cast("long").alias("n_links"), F.array_join(F.array_sort(F.array_distinct(attributes(h, "a", "href"))), " ").alias("links"))


# Class names, labels and links of the market's pages.
CARD, CARD_NAME, CARD_PRICE = "buyeritemtable_info", "buyeritem_name", "buyeritem_price"
QUANTITY, SOLD_ON = r"注文\s*数\s*[：:]\s*([0-9]+)", r"成約日\s*[：:]\s*([0-9]{4}/[0-9]{2}/[0-9]{2})"
ITEM_PAGES, LIST_PAGES = r"/buyer/[0-9]+/item_([0-9]+)\.html", r"-A2002003000_([0-9]+)/"
COUNTRIES = {"韓国": "한국", "한국": "한국"}


def _rows(pages: DataFrame, html: str, parts: Column, fields: Callable[[Column], Column], place: str) -> DataFrame:
    """A row for each part of a page, numbered in the page's order; ``fields`` reads a part as a struct.

    Parts are read before they become rows: a filter on the rows then compares fields and reads no part again.
    """
    own = [c for c in pages.columns if c != html]
    found = pages.select(*own, F.posexplode(F.transform(parts, fields)).alias("at", "card"))
    return found.select(*own, (F.col("at") + 1).alias(place), "card.*")


def seller_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """place, item_id, name, price of each card; cards without one of them are left out."""

    def fields(part: Column, head: Column) -> Column:
        return F.struct(
            some(F.regexp_extract(head, r'<a\b[^>]*href="/item/([0-9]+)/?"', 1)).alias("item_id"),
            said(F.regexp_extract(head, r"(?s)<a\b[^>]*>(.*?)</a>", 1)).alias("name"),
            number(plain(element(part, "p", CARD_PRICE))).alias("price"),
        )

    read = lambda part: text.once(element(part, "p", CARD_NAME), lambda head: fields(part, head))
    return _rows(pages, html, pieces(F.col(html), "li", CARD), read, "place").dropna(subset=["item_id", "name", "price"])


def sales(pages: DataFrame, html: str = "html") -> DataFrame:
    """place, sale_date, item_id, qty, item_name of each sold card; cards without one of them are left out."""
    lines = lambda part: F.array_join(F.transform(F.regexp_extract_all(part, F.lit(r"(?s)<p\b[^>]*>(.*?)</p>"), F.lit(1)), plain), "\n")

    def fields(x: Column) -> Column:
        return F.struct(
            some(F.regexp_extract(x["lines"], SOLD_ON, 1)).alias("sale_date"),
            some(F.regexp_extract(x["head"], r'<a\b[^>]*href="[^"]*/item/([0-9]+)/', 1)).alias("item_id"),
            F.regexp_extract(x["lines"], QUANTITY, 1).try_cast("long").alias("qty"),
            said(F.regexp_extract(x["head"], r"(?s)<a\b[^>]*>(.*?)</a>", 1)).alias("item_name"),
        )

    read = lambda part: text.once(F.struct(element(part, "p", CARD_NAME).alias("head"), lines(part).alias("lines")), fields)
    return _rows(pages, html, pieces(F.col(html), "li", CARD), read, "place").dropna(subset=["sale_date", "item_id", "qty", "item_name"])


def competitors(pages: DataFrame, site: str = "", html: str = "html") -> DataFrame:
    """rank, seller_id, seller_name, item_id, link, price, name of a search page's new products; used ones take no rank."""

    def fields(part: Column, x: Column) -> Column:
        digits = F.regexp_replace(plain(element(part, "span", "Price_Txt")), "[^0-9]", "")
        return F.struct(
            some(F.regexp_extract(x["seller"], r"/buyer/([0-9]+)", 1)).alias("seller_id"),
            said(x["seller"]).alias("seller_name"),
            some(F.regexp_extract(x["link"], r"/item/([0-9]+)", 1)).alias("item_id"),
            F.when(x["link"].startswith("http"), x["link"]).otherwise(F.concat(F.lit(site), x["link"])).alias("link"),
            digits.try_cast("long").alias("price"),
            said(F.regexp_extract(part, r'(?s)<(?:div|p|a|span)\b[^>]*class="(?:[^"]* )?product_name(?: [^"]*)?"[^>]*>(.*?)</(?:div|p|a|span)>', 1)).alias("name"),
        )

    link = lambda part: some(F.regexp_extract(part, r'<a\b[^>]*href="([^"]*/item/[^"]*)"', 1))
    read = lambda part: text.once(F.struct(element(part, "p", "product_Buyer").alias("seller"), link(part).alias("link")), lambda x: fields(part, x))
    new = F.filter(pieces(F.col(html), "li", "product"), lambda x: ~x.rlike(r'class="[^"]*\bproduct_used_tag\b'))
    return _rows(pages, html, new, read, "rank")


def seller_ids(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r'<a\b[^>]*href="/buyer/([0-9]+)\.html'), F.lit(1)))


def last_page(html: Column, links: str) -> Column:
    """The greatest page number of the page's links, 1 where there are none."""
    found = F.regexp_extract_all(html, F.lit(rf'<a\b[^>]*href="[^"]*{links}'), F.lit(1))
    return F.greatest(F.lit(1), F.array_max(F.transform(found, lambda x: x.try_cast("int"))))


def seller_profiles(pages: DataFrame, home: str = "한국", html: str = "html") -> DataFrame:
    """seller_name, seller_type, country and three counts of profile pages that name a seller: shops, and personal ones at home."""
    h = F.col(html)
    label = F.regexp_extract(h, r'(?s)<p\b[^>]*class="label"[^>]*>(.*?)</p>', 1)
    kind = F.when(label.rlike(r"\blabel_shop\b"), "SHOP").when(label.rlike(r"\blabel_premium\b"), "PREMIUM PERSONAL SHOPPER").otherwise(F.upper(plain(label)))
    head = F.regexp_extract(h, r'(?s)id="buyer_name".*?<h1[^>]*>(.*?)</h1>', 1)
    alt = F.nullif(F.trim(F.regexp_extract(head, r'<img\b[^>]*alt="([^"]*)"', 1)), F.lit(""))
    known = F.create_map(*(F.lit(x) for pair in COUNTRIES.items() for x in pair))
    count = lambda pattern: F.coalesce(number(plain(F.regexp_extract(h, f"(?s){pattern}", 1))), F.lit(0))
    rows = pages.select(
        *[c for c in pages.columns if c != html],
        plain(F.regexp_extract(head, r"(?s)<a\b[^>]*>(.*?)</a>", 1)).alias("seller_name"),
        kind.alias("seller_type"),
        F.coalesce(F.try_element_at(known, alt), alt).alias("country"),
        count(r'id="js_fan_count"[^>]*>(.*?)</').alias("follower_count"),
        count(r'<span\b[^>]*class="[^"]*\bsyohin_cnt_text\b[^"]*"[^>]*>(.*?)</span>').alias("listing_count"),
        count(r'<h3[^>]*>[^<]*注文実績[^<]*</h3>.*?<p\b[^>]*class="[^"]*\bbuyer_eva_text\b[^"]*"[^>]*>(.*?)</p>').alias("order_count"),
    )
    personal = F.col("seller_type").isin("PREMIUM PERSONAL SHOPPER", "PERSONAL SHOPPER") & F.coalesce(F.col("country") == home, F.lit(False))
    return rows.filter((F.col("seller_name") != "") & ((F.col("seller_type") == "SHOP") | personal))


def last_by_key(keys: Column, values: Column) -> Column:
    """A map of two arrays; of equal keys the last counts, and keys beyond the values are left out."""

    def of(k: Column, v: Column) -> Column:
        unique = F.array_distinct(k)
        return F.map_from_arrays(unique, F.transform(unique, lambda x: F.element_at(v, (F.size(k) - F.array_position(F.reverse(k), x) + 1).cast("int"))))

    def cut(x: Column) -> Column:
        n = F.least(F.size(x["k"]), F.size(x["v"]))
        return F.struct(F.slice(x["k"], 1, n).alias("k"), F.slice(x["v"], 1, n).alias("v"))

    pair = F.struct(keys.alias("k"), values.alias("v"))
    return text.once(text.once(pair, cut), lambda x: of(x["k"], x["v"]))


def size_chart(html: Column) -> Column:
    """Size, measure and value of the first table that holds numbers beside its first column; null if none does."""
    every = lambda h, pattern: F.regexp_extract_all(h, F.lit(f"(?s){pattern}"), F.lit(1))
    cells = F.transform(every(html, r"<table\b(.*?)</table>"), lambda t: F.transform(every(t, r"<tr\b[^>]*>(.*?)</tr>"), lambda r: F.transform(every(r, r"<t[hd]\b[^>]*>(.*?)</t[hd]>"), plain)))
    after = lambda row: F.slice(row, 2, 2**30)
    measured = F.filter(cells, lambda t: (F.size(t) >= 2) & (F.size(t[0]) >= 2) & F.exists(after(t), lambda r: F.exists(after(r), lambda c: c.rlike("[0-9]"))))

    def of(table: Column, rows: Column) -> Column:
        chart = last_by_key(F.transform(rows, lambda r: r[0]), F.transform(rows, lambda r: last_by_key(after(table[0]), after(r))))
        return F.when(F.size(rows) > 0, chart)

    named = lambda table: F.filter(after(table), lambda r: text.blank(F.try_element_at(r, F.lit(1))) != "")
    return text.once(F.try_element_at(measured, F.lit(1)), lambda table: text.once(named(table), lambda rows: of(table, rows)))


_DETAIL = "`@type` string, name string, brand string, description string, hasVariant array<struct<sku:string,color:string,size:string,image:string,offers:struct<price:string,lowPrice:string,availability:string,inventoryLevel:struct<minValue:string,maxValue:string>>>>, itemListElement array<struct<name:string,item:string>>"


def item_details(pages: DataFrame, html: str = "html") -> DataFrame:
    """The record of a product's page; what a page doesn't say is null, or an empty list."""
    own, h = [c for c in pages.columns if c != html], F.col(html)
    # The objects are a column of their own, so that the page is parsed once.
    read = pages.withColumn("__ld", json_ld(h, _DETAIL))
    group = F.try_element_at(F.filter("__ld", lambda x: x["@type"] == "ProductGroup"), F.lit(1))
    named = lambda x: F.nullif(F.trim(F.coalesce(F.nullif(x["name"], F.lit("")), F.get_json_object(x["item"], "$.name"))), F.lit(""))
    trails = F.transform(F.filter("__ld", lambda x: x["@type"] == "BreadcrumbList"), lambda x: F.filter(F.transform(x["itemListElement"], named), lambda n: n.isNotNull()))
    # Of trails of one length the first is the longest.
    longest = F.reduce(trails, F.array().cast("array<string>"), lambda best, t: F.when(F.size(t) > F.size(best), t).otherwise(best))
    spec = lambda label: said(F.regexp_extract(h, rf"(?s)<dt[^>]*>[^<]*{label}[^<]*</dt>\s*<dd[^>]*>(.*?)</dd>", 1))
    count = lambda pattern: number(plain(F.regexp_extract(h, f"(?s){pattern}", 1)))
    place = F.coalesce(*(F.when(meta(h, f"twitter:label{i}") == "購入地", F.nullif(F.trim(meta(h, f"twitter:data{i}")), F.lit(""))) for i in range(1, 5)))
    images = F.transform(group["hasVariant"], lambda v: F.when(v["image"].startswith("["), F.from_json(v["image"], "array<string>")).otherwise(F.array(v["image"])))
    tags = F.transform(F.regexp_extract_all(F.regexp_extract(h, r"(?s)<p\b[^>]*>[^<]*タグ[^<]*</p>.*?<(?:div|ul)\b(.*?)</(?:div|ul)>", 1), F.lit(r"(?s)<a\b[^>]*>(.*?)</a>"), F.lit(1)), plain)
    # Offers are read with their page; what isn't an object has no fields.
    offered = F.transform(F.filter(group["hasVariant"], lambda v: v["sku"].isNotNull()), lambda v: F.struct(v.alias("v"), v["offers"].alias("o")))
    variant = lambda x: F.struct(
        x["v"]["sku"].alias("sku"),
        x["v"]["color"].alias("color"),
        x["v"]["size"].alias("size"),
        F.coalesce(x["o"]["price"].try_cast("double"), x["o"]["lowPrice"].try_cast("double")).cast("long").alias("price"),
        some(F.substring_index(F.regexp_replace(x["o"]["availability"], "/+$", ""), "/", -1)).alias("availability"),
        x["o"]["inventoryLevel"]["minValue"].try_cast("long").alias("stock_min"),
        x["o"]["inventoryLevel"]["maxValue"].try_cast("long").alias("stock_max"),
    )
    track = F.regexp_extract(h, r"""<meta\b[^>]*name="[^"]*:track_item_json"[^>]*content='([^']*)'""", 1)
    return read.select(
        *own,
        F.coalesce(meta(h, "og:title"), said(F.regexp_extract(h, r"(?s)<h1[^>]*>(.*?)</h1>", 1))).alias("name"),
        F.coalesce(F.get_json_object(group["brand"], "$.name"), F.when(~group["brand"].startswith("{"), group["brand"])).alias("brand"),
        F.nullif(F.array_join(longest, " > "), F.lit("")).alias("category_path"),
        place.alias("origin_country"),
        meta(h, "og:image").alias("image_url"),
        F.coalesce(F.array_distinct(F.filter(F.flatten(F.filter(images, lambda x: x.isNotNull())), lambda u: u != "")), F.array().cast("array<string>")).alias("image_urls"),
        F.coalesce(F.nullif(group["description"], F.lit("")), meta(h, "og:description"), F.lit("")).alias("description"),
        count(r'<span\b[^>]*class="[^"]*\bac_count\b[^"]*"[^>]*>(.*?)</span>').alias("view_count"),
        count(r'<span\b[^>]*class="[^"]*\bfav_count\b[^"]*"[^>]*>(.*?)</span>').alias("fav_count"),
        count(r'id="tabmenu_inqcnt"[^>]*>(.*?)</').alias("inquiry_count"),
        spec("品番").alias("model_number"),
        F.filter(tags, lambda t: (t != "") & ~t.isin("もっと見る", "閉じる")).alias("tags"),
        spec("テーマ").alias("theme"),
        F.nullif(F.trim(F.get_json_object(track, "$.kokaidate")), F.lit("")).alias("listed_at"),
        F.coalesce(F.transform(offered, variant), F.array().cast("array<struct<sku:string,color:string,size:string,price:bigint,availability:string,stock_min:bigint,stock_max:bigint>>")).alias("variants"),
        size_chart(h).alias("size_chart"),
    )


_NODE = "array<struct<name:string,id:string,subCategories:{}>>"


def tree_entries(pages: DataFrame, brand_parent: str, roots: list[str], html: str = "html") -> DataFrame:
    """kind (brand or category), name, category_key, full_path of the category tree of a store page's state, three levels deep.

    Leaves under ``brand_parent`` are brands. Nodes of ``roots`` are categories, but those below them that aren't written in
    Hangul are brands, and nothing below such a brand counts.
    """
    own = [c for c in pages.columns if c != html]
    state = F.regexp_extract(html, r"(?s)window\.__PRELOADED_STATE__\s*=\s*(\{.*?\})\s*;?\s*</script>", 1)
    tops = F.from_json(F.get_json_object(state, "$.categoryMenu.storeCategoryTree.subCategories"), _NODE.format(_NODE.format(_NODE.format("string"))))
    clean = lambda c: F.trim(F.regexp_replace(text.blank(c), r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{26FF}\x{1F000}-\x{1F2FF}]", ""))
    levels = [pages.select(*own, F.explode(tops).alias("n")).select(*own, "n.id", clean(F.col("n.name")).alias("name"), clean(F.col("n.name")).alias("top"), clean(F.col("n.name")).alias("full_path"), F.lit(False).alias("under_brand"), F.col("n.subCategories").alias("kids"))]
    for _ in range(2):
        up = levels[-1]
        name = clean(F.col("n.name"))
        latin = (F.col("full_path") != F.col("top")) & ~text.has_hangul(F.col("name"))
        below = up.select(*own, "top", "full_path", (F.col("under_brand") | latin).alias("under_brand"), F.explode("kids").alias("n"))
        levels.append(below.select(*own, "n.id", name.alias("name"), "top", F.concat_ws(" > ", "full_path", name).alias("full_path"), "under_brand", F.col("n.subCategories").alias("kids")))
    leaf = lambda d: d.withColumn("leaf", F.coalesce(F.size("kids") == 0, F.lit(True)) if isinstance(d.schema["kids"].dataType, T.ArrayType) else F.lit(True)).drop("kids")
    nodes = reduce(DataFrame.unionByName, map(leaf, levels))
    brand = F.when(F.col("top") == brand_parent, F.when(F.col("leaf"), "brand"))
    walked = F.when(F.col("top").isin(roots) & ~F.col("under_brand"), F.when((F.col("full_path") != F.col("top")) & ~text.has_hangul(F.col("name")) & (F.col("name") != ""), "brand").otherwise("category"))
    return nodes.withColumn("kind", F.coalesce(brand, walked)).filter("kind IS NOT NULL").select(*own, "kind", "name", F.col("id").alias("category_key"), "full_path")
