"""Page readers on pages made up for them."""

import pytest
from pyspark.sql import functions as F

from marketlane.sources import pages

CARDS = """<ul><li class="x buyeritemtable_info"><p class="buyeritem_name"><a href="/item/71/">Cap &amp; <b>Co</b></a></p><p class="buyeritem_price">¥ 1,250</p>
<p>注文数： 2</p><p>成約日：2026/03/04</p></li><li class="buyeritemtable_info"><p class="buyeritem_name"><a href="/item/72/">Belt</a></p><p>注文数：1</p></li>
<li class="other"><p class="buyeritem_name"><a href="/item/73/">No</a></p></li></ul><a href="/buyer/9/item_12.html">12</a><a href="/buyer/9/item_3.html">3</a>"""
PROFILE = """<p class="label"><span class="{kind}">x</span>{said}</p><div id="buyer_name"><h1><img src="f.png" alt="韓国"><a href="#">Hat Corner</a></h1></div>
<b id="js_fan_count">1,002</b><span class="syohin_cnt_text">出品数 40</span><h3>平均</h3><p class="buyer_eva_text">9</p><h3>注文実績</h3><p class="buyer_eva_text">77件</p>"""
SEARCH = """<ul><li class="product"><a href="/item/5/">a</a><div class="product_name">Cap</div><p class="product_Buyer"><a href="/buyer/8.html">Hat Corner</a></p><span class="Price_Txt">¥9,800</span></li>
<li class="product"><span class="product_used_tag">used</span><a href="/item/6/">b</a></li><li class="product"><a href="https://y/item/7/">c</a></li></ul>"""
DETAIL = """<h1>Fallback</h1><meta property="og:image" content="i.png"><meta name="twitter:label2" content="購入地"><meta name="twitter:data2" content=" Rome ">
<meta name="shop:track_item_json" content='{"kokaidate": "2026-01-02T03:04:05+09:00"}'><span class="ac_count">1,234 views</span><i id="tabmenu_inqcnt">(3)</i>
<dl><dt>ブランド品番</dt><dd>AB <b>12</b></dd><dt>テーマ</dt><dd></dd></dl><p>この商品に関連するタグ</p><ul><li><a>Logo</a></li><a>もっと見る</a></ul>
<script type="application/ld+json">[{"@type": "BreadcrumbList", "itemListElement": [{"name": "A"}]}, {"@type": "BreadcrumbList", "itemListElement": [{"name": "A"}, {"item": {"name": "B"}}]}]</script>
<script type="application/ld+json">{"@type": "ProductGroup", "brand": {"name": "Zed"}, "hasVariant": [
{"sku": 1, "color": "red", "image": ["u1", "u2"], "offers": {"price": "bad", "lowPrice": "8.0", "availability": "http://s/InStock/", "inventoryLevel": {"minValue": 1, "maxValue": "4"}}},
{"color": "no sku", "image": "u1"}, {"sku": "s3", "offers": "none"}]}</script>
<table><tr><th>size</th><th>stock</th></tr><tr><td>23cm</td><td>○</td></tr></table>
<table><tr><th>size</th><th>length</th><th>width</th></tr><tr><td>S</td><td>60</td></tr><tr><td>M</td><td>62</td><td>40</td><td>9</td></tr><tr><td>S</td><td>61</td></tr><tr><td></td><td>1</td></tr></table>"""
TREE = """<script>window.__PRELOADED_STATE__={"categoryMenu": {"storeCategoryTree": {"subCategories": [
{"name": "BRAND", "id": "b", "subCategories": [{"name": "A", "id": "a", "subCategories": [{"name": "Aa\\ud83d\\ude00", "id": "aa"}]}, {"name": "Solo", "id": "s"}]},
{"name": "여성", "id": "w", "subCategories": [{"name": "가방", "id": "g", "subCategories": [{"name": "ZED", "id": "z"}]}, {"name": "KIDS", "id": "k", "subCategories": [{"name": "신발", "id": "n"}]}]},
{"name": "Other", "id": "o"}]}}};</script>"""


def page(spark, html):
    return spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id long, html string")


def test_cards(spark):
    d = page(spark, CARDS)
    assert [tuple(r) for r in pages.seller_items(d).collect()] == [(1, 1, "71", "Cap & Co", 1250)]
    assert [tuple(r) for r in pages.sales(d).collect()] == [(1, 1, "2026/03/04", "71", 2, "Cap & Co")]
    assert [r[0] for r in d.orderBy("page_id").select(pages.last_page(F.col("html"), pages.ITEM_PAGES)).collect()] == [12, 1, 1]


def test_profiles(spark):
    one = lambda kind, said: [tuple(r)[1:] for r in pages.seller_profiles(page(spark, PROFILE.format(kind=kind, said=said))).collect()]
    assert one("label_shop", "") == [("Hat Corner", "SHOP", "한국", 1002, 40, 77)]
    assert one("", "") == []
    assert [r[1] for r in one("label_premium", "y")] == ["PREMIUM PERSONAL SHOPPER"]
    away = page(spark, PROFILE.format(kind="label_premium", said="").replace("韓国", "Rome"))
    assert pages.seller_profiles(away).count() == 0 and pages.seller_profiles(away, home="Rome").count() == 1


def test_competitors(spark):
    got = [tuple(r) for r in pages.competitors(page(spark, SEARCH), "https://x").orderBy("rank").collect()]
    assert got == [(1, 1, "8", "Hat Corner", "5", "https://x/item/5/", 9800, "Cap"), (1, 2, None, None, "7", "https://y/item/7/", None, None)]


def test_item_details(spark):
    r, empty, _ = pages.item_details(page(spark, DETAIL)).orderBy("page_id").collect()
    assert (r.name, r.brand, r.category_path, r.origin_country, r.image_url, r.image_urls) == ("Fallback", "Zed", "A > B", "Rome", "i.png", ["u1", "u2"])
    assert (r.view_count, r.fav_count, r.inquiry_count, r.model_number, r.tags, r.theme, r.listed_at) == (1234, None, 3, "AB 12", ["Logo"], None, "2026-01-02T03:04:05+09:00")
    assert [tuple(v) for v in r.variants] == [("1", "red", None, 8, "InStock", 1, 4), ("s3", None, None, None, None, None, None)]
    assert r.size_chart == {"S": {"length": "61"}, "M": {"length": "62", "width": "40"}}
    assert (empty.name, empty.brand, empty.category_path, empty.image_urls, empty.variants, empty.size_chart, empty.description) == (None, None, None, [], [], None, "")


def test_tree(spark):
    got = pages.tree_entries(page(spark, TREE), "BRAND", ["여성"]).drop("page_id")
    assert sorted(map(tuple, got.collect())) == sorted(
        [
            ("brand", "Aa", "aa", "BRAND > A > Aa"),
            ("brand", "Solo", "s", "BRAND > Solo"),
            ("category", "여성", "w", "여성"),
            ("category", "가방", "g", "여성 > 가방"),
            ("brand", "ZED", "z", "여성 > 가방 > ZED"),
            ("brand", "KIDS", "k", "여성 > KIDS"),
        ]
    )


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tables_and_cards_are_read_once(spark):
    """A page's tables are parsed once and not for each cell; so is a card, also where rows without a field are left out."""
    made = spark.range(2).select(F.concat(F.lit("<table>"), F.col("id").cast("string")).alias("html"))
    assert _optimized(made.select(pages.size_chart(F.col("html")).alias("chart"))).count("regexp_extract_all(") <= 3
    for read in (pages.seller_items, pages.sales, pages.competitors):
        plan = _optimized(read(made))
        assert plan.count("buyeritem_name") + plan.count("product_Buyer") <= 1, read.__name__


@pytest.mark.parametrize("offers,price", [('"text"', None), ("null", None), ('[{"price": 5}]', None), ('{"price": {"a": 1}, "lowPrice": 3}', 3), ('{"price": 4, "inventoryLevel": [1]}', 4)])
def test_odd_offers_spoil_no_other_field(spark, offers, price):
    html = '<script type="application/ld+json">{"@type": "ProductGroup", "brand": "B", "hasVariant": [{"sku": "a", "offers": %s}, {"sku": "b", "offers": {"price": 9}}]}</script>' % offers
    row = pages.item_details(spark.createDataFrame([(1, html)], "page_id long, html string")).first()
    assert row.brand == "B" and [(v.sku, v.price) for v in row.variants] == [("a", price), ("b", 9)]
