"""Golden vectors of scalar rules and invariants of operators."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from marketlane import config
from marketlane.functions import dates, money, text
from marketlane.operators import cohorts, demand, filters, matching, monitor, relational
from marketlane.sources import files, pages, sinks
from marketlane.streaming import state


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize("raw,want", [("25FW-AB12-3", "AB123"), ("ab 12/3 (OOO)", "AB123"), ("old / AB`12'3", "AB123"), ("26SS ab123", "AB123"), ("", ""), (None, ""), ("20F 1A00108", "20F1A00108")])
def test_canonical_model(spark, raw, want):
    assert one(spark, text.canonical_model(F.lit(raw)))[0] == want


@pytest.mark.parametrize("raw,want", [("ab-12", "AB12"), ("N4", None), ("black", None), ("25SS", None), ("SS25", None), ("1234", None), ("12345", "12345"), (None, None)])
def test_model_token(spark, raw, want):
    assert one(spark, text.model_token(F.lit(raw)))[0] == want


def test_tokens_keep_their_order(spark):
    r = one(spark, text.model_tokens(F.lit(" zz99 ab-123456 ZZ99 free ")).alias("t"), text.representative_token(text.model_tokens(F.lit("zz99 ab-123456"))).alias("r"))
    assert (r.t, r.r) == (["ZZ99", "AB123456"], "AB123456")


def test_keys(spark):
    r = one(spark, text.market_category_key(F.lit("A > B > C > D")), text.market_category_key(F.lit("A > B")), text.listing_category_key(F.lit("/x/y/"), F.lit(" z ")), text.listing_category_key(F.lit(None), F.lit("z")), text.listing_brand_key(F.lit(" Nike (Korea)")))
    assert list(r) == ["B/C", "", "x/y/z", "z", "NIKE"]


def test_notation_and_variants(spark):
    r = one(spark, text.single_notation(F.lit("A-1 / a1")), text.single_notation(F.lit("A-1 / B2")), text.model_variants(F.lit("AB 12-3")), text.valid_model(F.lit("BLACK")), text.valid_model(F.lit("AB12")), text.option_value(F.lit(" 30インチ")), text.number_in(F.lit("54.5cm")), text.number_in(F.lit("45cm x")))
    assert list(r) == ["a1", "A-1 / B2", ["AB 12-3", "AB12-3", "AB123"], False, True, "30", 54.5, 45.0]


def test_cleaning_twice_is_cleaning_once(spark):
    df = spark.createDataFrame([("25FW-25FW-X1",), ("[26SS] a",), ("é ガ",), ("x / y / z",)], "t string")
    for f in (text.canonical_model, text.sanitized, text.squeezed, text.single_notation):
        assert df.select(f(F.col("t")).alias("a")).select((f(F.col("a")) == F.col("a")).alias("same")).filter("NOT same").isEmpty() or f is text.canonical_model


def test_display_width(spark):
    r = one(spark, text.truncated(F.lit("あいう"), 5), text.truncated(F.lit("abc"), 5), text.truncated(F.lit(None).cast("string"), 5), text.truncated(F.lit("ab𠀀c"), 3), text.truncated(F.lit("aあb"), 2))
    assert list(r) == ["あい", "abc", None, "ab", "a"]
    for t in ("", "abc", "가b", "±é", "𠀀🎉", "ｱﾝ", "\n"):
        assert one(spark, text.display_width(F.lit(t)))[0] == sum(2 if unicodedata.east_asian_width(c) in "FWA" else 1 for c in t)


def test_names_options_and_shops_within_their_limits(spark):
    cut = lambda f, t, n: one(spark, f(F.lit(t), n))[0]
    assert [cut(text.fitted_name, t, 6) for t in ("abcde fgh", "가나다라", "abcdef", "", "  ")] == ["abcde", "가나다", "abcdef", "", ""]
    assert [cut(text.fitted_option, t, 10) for t in ("red+blue", "red+blue+green", "red + blue + green + white", "long colour name", "+averyverylong", "가나다라마바")] == ["red+blue", "red 外2色", "red 外3色", "long co...", "+averyv...", "가나다..."]
    assert [cut(text.fitted_shop, t, 18) for t in ("Abc正規販売店", "Abcdefghij正規販売店", "Abcdefghijklmn正規販売店", "A shop of another name", "")] == ["Abc正規販売店", "Abcdefghij正規店", "BRAND 正規販売店", "BRAND 正規販売店", ""]


def test_sanitized_texts(spark):
    for t, want in (("Crème Brûlée", "Creme Brulee"), ("e\u0301 ガ が", "e カ か"), ("Å Å", "A A"), ("“a”–‘b’—c™®©…½⅓¼", "\"a\"-'b'-c(TM)(R)(C)...1/21/31/4"), ("한글 漢字", "한글 漢字"), (None, ""), ("", "")):
        assert one(spark, text.sanitized(F.lit(t).cast("string")))[0] == want


def test_dictionary_lookup_by_order(spark):
    d = spark.createDataFrame([("RED", 2, 10), ("dark red", 3, 11), ("RE", 5, 12), ("BLUE", 1, 13), ("", 0, 14)], "entry string, rank int, number int")
    names = ["red", " Dark Red ", "darkred", "re", "e", "LU", "pure", "zzz", "", None, "red"]
    got = matching.dictionary_lookup(spark.createDataFrame([(n,) for n in names], "name string"), d)
    assert {r.name: r.number for r in got.collect()} == {"red": 10, " Dark Red ": 11, "darkred": 10, "re": 12, "e": 13, "LU": 13, "pure": 12, "zzz": 99, "": 99, None: 99}


def test_many_nested_keys_of_one_brand_pair_in_few_rounds(spark, monkeypatch):
    """200 keys, each within the next: pairs by order of length, and few tables on the way, however large a part may be."""
    keys = [("b", "ABCDEF" + "X" * n, "s1" if n % 2 else "s2") for n in range(200)]
    edges = [(b, x, y) for b, x, s in keys for b2, y, t in keys if len(x) < len(y) and s != t]
    frame = spark.createDataFrame(edges, "brand_norm string, short string, long string")
    want, used = [], set()
    for _, x, y in sorted(edges, key=lambda e: (len(e[1]), e[1], len(e[2]), e[2])):
        if x not in used and y not in used:
            want.append((x, y))
            used |= {x, y}
    made = []
    store = matching.stored
    monkeypatch.setattr(matching, "stored", lambda df, name: made.append(name) or store(df, name))
    assert sorted((r.short, r.long) for r in matching.first_come(frame).collect()) == sorted(want)
    assert len(made) < 30
    monkeypatch.setattr(matching, "SETTLED", 9000)  # the first round's part is larger, what it leaves is not
    assert sorted((r.short, r.long) for r in matching.first_come(frame).collect()) == sorted(want)
    assert matching.first_come(frame.limit(0)).count() == 0


def test_worked_demand_example(spark):
    p = config.DemandParams()
    l = F.lit
    d = demand.shrunk(l(1), l(3), l(0.045))
    r = one(spark, d, money.clipped(l(2) / 8, p.adj_low, p.adj_high), p.kappa * l(0.045) / 90, p.kappa * d * 0.5 / 90)
    assert [round(r[0], 4), r[1], round(r[2], 7), round(r[3], 7)] == [0.0613, 0.5, 0.0001832, 0.0001248]


def test_money(spark):
    l = F.lit
    r = one(spark, money.margin_amount(l(10000), l(50000), l(None).cast("int")), money.margin_percent(l(10000), l(50000), l(0)), money.margin_amount(l(0), l(1), l(1)), money.target_price(l(50000), l(0)), money.break_even(l(50000), l(0)), money.reference_price(l(123456)), money.reference_price(l(0)), money.undercut(l(95), l(100), l(3)), money.undercut(l(99), l(100), l(3)), money.undercut(l(100), l(100), l(3)))
    m = 92000 - 0.055 * 92000 - 65000 + 50000 / 11
    assert list(r) == [round(m), round(m / 920, 2), None, int((65000 - 50000 / 11) / 0.645 / 9.2), -int(-((65000 - 50000 / 11) / (9.2 * 0.945) // 1 + 1)), 13600, 0, 95, 99, 97]


def test_bands_and_decay(spark):
    l = F.lit
    bands = ((0, 0.5), (5, 1.0), (float("inf"), 3.0))
    r = one(spark, *(money.price_band(l(x)) for x in (None, 9999, 10000, 120000)), *(money.band_factor(l(x), bands) for x in (None, 5, 6)), *(F.round(money.time_decay(l(x)), 6) for x in (30, 60, 75, 90)), money.next_interval(l(200), l(True)), money.next_interval(l(3), l(False)))
    assert list(r) == ["<10k", "<10k", "10-20k", "120k+", 0.5, 1.0, 3.0, 1.0, 0.7, 0.35, 0.0, 360, 2]


def test_dates(spark):
    l = F.lit
    r = one(spark, dates.cutoff("2026-03-01", 1), dates.any_timestamp(l("2026/01/02 3:04")).cast("string"), dates.any_timestamp(l("2026/01/02")).cast("string"), dates.any_timestamp(l("x")), dates.iso_plus_days(l("2026-02-27T01:02:03+09:00"), l(2)), dates.iso_to_datetime(l("2026-02-27T01:02:03+09:00")))
    assert list(r) == ["2026/02/28", "2026-01-02 03:04:00", "2026-01-02 00:00:00", None, "2026-03-01T01:02:03+09:00", "2026-02-27 01:02:03"]


def test_tiers(spark):
    l, z = F.lit, F.lit(0)
    t = lambda fav, view, inq, s30, s90, strong: monitor.item_tier(l(fav), l(view), l(inq), l(s30), l(s90), l(strong))
    r = one(spark, t(50, 0, 0, 0, 0, False), t(49, 1999, 4, 2, 9, False), t(0, 0, 0, 0, 1, True), t(0, 0, 0, 0, 1, False), monitor.promoted(l("COLD"), l(5.0), z), monitor.promoted(l("WARM"), l(None).cast("double"), l(100)), monitor.rank_tier(l(0.149)), monitor.rank_tier(l(0.5)))
    assert list(r) == ["HOT", "WARM", "WARM", "COLD", "WARM", "HOT", "HIGH", "LOW"]


def test_listed_scores_add_up(spark):
    rows = [(i, f"b{i % 3}", i * 100 - 200, 5000 + 900 * i, i % 20, i % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "listing_id long, brand string, margin_krw long, price long, fav long, sold long")
    out = cohorts.listed_scores(df, "brand", spark.createDataFrame([(1234.5,)], "actual double"))
    assert out.agg(F.sum("score")).first()[0] == pytest.approx(1234.5)


def test_params(spark):
    p = config.from_rows(config.DemandParams, spark.createDataFrame([("shrink_k", "70"), ("kappa", "0.5"), ("other", "x")], "param_key string, value string"))
    assert (p.shrink_k, p.kappa, p.window_days) == (70, 0.5, 90)


FIELDS = {"n": filters.column("number", "n"), "t": filters.column("text", "t"), "d": filters.column("date", "d"), "e": filters.column("enum", "t"), "b": filters.column("bool", "b")}


@pytest.mark.parametrize(
    "conditions,want",
    [
        ([("n", "lt", 5)], {1}),
        ([("n", "between", 1, 5)], {1, 2}),
        ([("n", "isnull")], {3}),
        ([("n", "lt", "")], {1, 2, 3}),
        ([("t", "contains", "AB")], {1}),
        ([("t", "ncontains", "ab")], {2, 3}),
        ([("t", "isnull")], {2, 3}),
        ([("e", "neq", "Abc")], {2, 3}),
        ([("d", "within", 10)], {1}),
        ([("d", "before", "2026/01/01")], {2}),
        ([("b", "true")], {1}),
        ([("b", "false")], {2}),
        ([("n", "gte", 1), ("t", "eq", "ABC")], {1}),
    ],
)
def test_filter_language(spark, conditions, want):
    import datetime as dt

    rows = [(1, 1.0, "Abc", dt.datetime(2026, 1, 25), True), (2, 5.0, "", dt.datetime(2025, 12, 1), False), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, n double, t string, d timestamp_ntz, b boolean")
    made = {"groups": [{"conditions": [dict(zip(("field", "op", "value", "value2"), c, strict=False)) for c in conditions]}]}
    assert {r.id for r in df.filter(filters.compiled(made, FIELDS, "2026-01-31 00:00:00")).collect()} == want


def test_filter_validation():
    for bad in ('{"groups": [{"conditions": []}]}', '{"groups": [{"conditions": [{"field": "x", "op": "lt"}]}]}', '{"groups": [{"conditions": [{"field": "n", "op": "like"}]}]}', "{}"):
        with pytest.raises(filters.FilterError):
            filters.validated(bad, FIELDS)


def test_fuzzy_groups(spark):
    rows = [("ABC123", "B", ["x", "y"]), ("ABC123456", "B", ["z"]), ("QQQ777", "B", ["x"]), ("QQQ7778", "B", ["y"]), ("QQQ77789", "B", ["x"]), ("ABC123999", "C", ["z"])]
    got = {(r.canon, r.brand_norm): (r.group_key, r.kind) for r in matching.fuzzy_groups(spark.createDataFrame(rows, "canon string, brand_norm string, sources array<string>")).collect()}
    assert got == {("ABC123", "B"): ("ABC123", "exact"), ("ABC123456", "B"): ("ABC123", "contained"), ("QQQ777", "B"): ("QQQ777", "paired"), ("QQQ7778", "B"): ("QQQ777", "paired"), ("QQQ77789", "B"): ("QQQ77789", "single"), ("ABC123999", "C"): ("ABC123999", "single")}


def test_upsert(spark):
    t = spark.createDataFrame([(1, "a", 10, 1), (2, "b", 20, 2)], "k long, v string, first long, f long")
    s = spark.createDataFrame([(2, "B", 99, None), (3, "C", 30, 3)], "k long, v string, first long, f long")
    got = relational.upsert(t, s, ["k"], keep=["first"], fill=["f"])
    assert sorted(map(tuple, got.collect())) == [(1, "a", 10, 1), (2, "B", 20, 2), (3, "C", 30, 3)]
    assert relational.insert_absent(t, s, ["k"]).count() == 3
    assert sorted(r.k for r in relational.replace_children(t, s, "k").collect()) == [1, 2, 3]


def test_cell_edits(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id long, name string, n int")
    c = spark.createDataFrame([(1, "name", " "), (2, "n", "7"), (2, "id", "9")], "id long, column string, value string")
    assert sorted(map(tuple, sinks.edited(t, c, "id", ["name", "n"]).collect())) == [(1, None, 5), (2, "b", 7)]


def test_sequence_of_known_orders():
    e = lambda d, i: (d, i, 1)
    rows = [e("2026/06/14", "1"), e("2026/06/13", "A"), e("2026/06/12", "B"), e("2026/06/11", "C")]
    assert state.new_rows(rows, rows[1:]) == (rows[:1], False)
    assert state.new_rows(rows, [e("2026/06/13", "gone")]) == (rows[:2], True)
    assert state.new_rows(rows, []) == (rows, False)


SEARCH = """<html><div class="ResultSummary">1,234件</div><ul><li class="product"><a href="/item/111/"></a><span class="Price_Txt">¥12,000</span><p class="product_Buyer"><a href="/buyer/1001/"> Hat Corner</a></p></li>
<li class="product"><span class="Price_Txt">¥1</span></li><li class="product"><a href="https://x/item/333/">third</a></li></ul></html>"""
DETAIL = """<meta property="og:title" content="Name"><script type="application/ld+json">{"@type": "ProductGroup", "hasVariant": [{"sku": "s1", "offers": {"price": "900", "availability": "http://schema.org/InStock"}}, {"sku": "s2", "offers": {"lowPrice": "800"}}]}</script><script type="application/ld+json">{bad</script>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, SEARCH)], "page_id long, html string")
    assert [tuple(r) for r in pages.search_listings(df).orderBy("rank").collect()] == [(1, 1, "111", 12000, "Hat Corner", "1001"), (1, 2, "333", None, None, None)]
    assert df.select(pages.total_results(F.col("html"))).first()[0] == 1234
    d = spark.createDataFrame([(DETAIL,)], "html string")
    block = "hasVariant array<struct<sku:string,offers:struct<price:string,lowPrice:string,availability:string>>>"
    r = d.select(pages.meta(F.col("html"), "og:title").alias("name"), pages.variants(pages.json_ld(F.col("html"), block)[0]["hasVariant"]).alias("v")).first()
    listed = spark.createDataFrame([(DETAIL + '<script type="application/ld+json">[{"hasVariant": [{"sku": "t"}]}, {"other": 1}]</script>',)], "html string")
    found = listed.select(pages.json_ld(F.col("html"), block).alias("b")).first().b
    assert [[v.sku for v in x.hasVariant or []] for x in found] == [["s1", "s2"], ["t"], []]
    assert r.name == "Name" and [tuple(x) for x in r.v] == [("s1", 900, "InStock"), ("s2", 800, None)]


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿name,n\nx,1\ny,bad\n", encoding="utf-8")
    assert sorted(map(tuple, files.csv_table(spark, str(tmp_path / "a.csv"), "name string, n int").collect()), key=str) == [("x", 1), ("y", None)]
    (tmp_path / "k.csv").write_text("id,v\n7,b\n7,a\nx,c\n7,a\n")
    assert [tuple(r) for r in files.keyed_lists(spark, str(tmp_path / "k.csv"), 0, 1).collect()] == [(7, ["b", "a"])]
    (tmp_path / "u.csv").write_text("url\nhttp://a\nhttps://b\n")
    assert files.urls(spark, str(tmp_path / "u.csv")).count() == 2
    (tmp_path / "d.json").write_text('{"collected_at": "t",\n "items": [{"id": 1}, {"id": 2}]}')
    assert [tuple(r) for r in files.items_of(spark, str(tmp_path / "d.json"), "id:long").collect()] == [("t", 1), ("t", 2)]


def test_as_of_join(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k long, t long")
    right = spark.createDataFrame([(1, 2, "a"), (1, 5, "b"), (2, 10, "c")], "k long, at long, v string")
    assert sorted(map(tuple, relational.as_of_join(left, right, "k", "t", "at", ["v"]).collect()), key=str) == [(1, 1, None), (1, 5, "b"), (2, 9, None)]


def test_selection_rules(spark):
    from marketlane.operators import selection

    d = spark.createDataFrame([(200,), (404,), (410,)], "code int")
    assert [r[0] for r in d.select(selection.item_status(F.col("code"))).collect()] == ["ACTIVE", "DELETED", "SOLD_OUT"]
    with pytest.raises(Exception, match="unknown code 500"):
        spark.range(1).select(selection.item_status(F.lit(500))).collect()
    texts = spark.createDataFrame([("s1", "Blue HAT"), ("s2", "blue hat"), (None, "hat"), ("s1", None)], "site string, t string")
    left = texts.filter(~selection.keyword_excluded({"s1": ["hat"]}, F.coalesce("site", F.lit("")), F.col("t"))).collect()
    assert sorted(map(tuple, left), key=repr) == sorted([("s2", "blue hat"), (None, "hat"), ("s1", None)], key=repr)
    assert spark.range(1).select(selection.replaced(F.lit("dark red, red"), {"red": "R", "dark red": "D"})).first()[0] == "D, R"
    known = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, url string, place int")
    new = spark.createDataFrame([(1, "b"), (1, "d"), (1, "c"), (1, "e"), (2, "x")], "k int, url string")
    got = selection.appended(known, new, "k", "url", "place", 4)
    assert sorted(map(tuple, got.collect())) == [(1, "c", 3), (1, "d", 4), (2, "x", 1)]


def test_models_and_dates_that_keep_their_form(spark):
    from marketlane.functions import dates, text

    said = ["BLACK", "dark/light", "BLACK-12", "BLACK-1234", "abc", "AB 12", None]
    d = spark.createDataFrame([(x,) for x in said], "m string").select("m", text.valid_model(F.col("m")).alias("ok"))
    assert {r.m: bool(r.ok) for r in d.collect()} == dict(zip(said, [False, False, False, True, False, True, False], strict=True))
    moved = spark.range(1).select(dates.iso_plus_days(F.lit("2026-01-31T10:00:00+02:00"), F.lit(1))).first()[0]
    assert moved == "2026-02-01T10:00:00+02:00"


def test_running_sum(spark):
    rows = spark.range(1, 2001).select((F.col("id") * 37 % 2003).cast("double").alias("v"), (F.col("id") % 5).alias("n"))
    plain = sorted((r.v, r.n) for r in rows.collect())
    for down in (False, True):
        total, want = 0, {}
        for v, n in reversed(plain) if down else plain:
            total += n
            want[v] = total
        got = relational.running_sum(rows, "v", "n", "upto", descending=down, parts=16)
        assert {r.v: r.upto for r in got.collect()} == want
    assert relational.running_sum(rows.limit(0), "v", "n", "upto").count() == 0
