"""Entity resolution: canonical groups, containment and prefix matches within a brand, brand names by levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane.functions import text
from marketlane.operators.relational import first_by
from marketlane.sources.sinks import dropped, stored


def canonical_groups(offers: DataFrame, model: str = "model_no", brand: str = "brand", source: str = "source_site", least: int = 4) -> DataFrame:
    """canon, brand_norm, sources (sorted), n: one row per key of at least four characters."""
    keyed = offers.select(text.canonical_model(F.col(model)).alias("canon"), text.brand_norm(F.col(brand)).alias("brand_norm"), F.col(source).alias("source")).filter(F.length("canon") >= least)
    return keyed.groupBy("canon", "brand_norm").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.count("*").alias("n"))


def contained_keys(keys: DataFrame, value: Column, least: int = 4) -> DataFrame:
    """brand_norm, short, long and the values of both: each key of a brand with all others of it that it contains.

    A long key states its pieces of every length, and those that are keys join by equality. So no part of a key that many
    keys share draws them together: the join's rows are the pairs themselves.
    """
    size = F.length("canon")
    pieces = F.flatten(
        F.transform(
            F.sequence(F.lit(1), size - least + 1),
            lambda i: F.transform(F.sequence(F.lit(least), size - i + 1), lambda n: F.col("canon").substr(i, n)),
        )
    )
    long = keys.filter(size > least).select("brand_norm", F.col("canon").alias("long"), value.alias("of_long"), F.explode(F.array_distinct(pieces)).alias("short"))
    short = keys.select("brand_norm", F.col("canon").alias("short"), value.alias("of_short"))
    return long.filter("short <> long").join(short, ["brand_norm", "short"])


#: A part of a brand's pairs that hang together is settled in one task if it has so many or fewer.
SETTLED = 100_000


def _rooted(edges: DataFrame) -> DataFrame:
    """brand_norm, key, root: the smallest key that each key of an edge hangs together with, in rounds that double their reach."""
    ends = edges.select("brand_norm", F.col("short").alias("v"), F.col("long").alias("u")).unionAll(edges.select("brand_norm", F.col("long").alias("v"), F.col("short").alias("u")))
    near = stored(ends.unionAll(ends.select("brand_norm", "v", F.col("v").alias("u"))).distinct(), "near")
    labels = stored(near.groupBy("brand_norm", "v").agg(F.min("u").alias("root")), "roots")
    while True:
        of = labels.select("brand_norm", F.col("v").alias("u"), "root")
        # What the neighbours know, and then what the root that this gives knows itself.
        least = near.join(of, ["brand_norm", "u"]).groupBy("brand_norm", "v").agg(F.min("root").alias("root"))
        jumped = least.join(of.select("brand_norm", F.col("u").alias("root"), F.col("root").alias("on")), ["brand_norm", "root"])
        new = jumped.join(labels.withColumnRenamed("root", "was"), ["brand_norm", "v"]).select("brand_norm", "v", F.col("on").alias("root"), (F.col("on") != F.col("was")).alias("moved"))
        after = stored(new, "roots")
        dropped(labels)
        labels = after
        if after.filter("moved").isEmpty():
            dropped(near)
            return labels.select("brand_norm", F.col("v").alias("key"), "root")


def first_come(edges: DataFrame) -> DataFrame:
    """Of brand_norm, short, long: the pairs taken one by one by length and text of the short key, then of the long one,
    each only if both its keys are still free.

    Pairs that don't hang together by common keys don't matter to one another. Those that do are settled in one pass over
    their sorted list if they are ``SETTLED`` or fewer. Of larger parts a round takes each pair that comes first for both
    its keys, and drops the pairs of their keys, until the rest is small or gone.
    """
    order = F.struct(F.length("short").alias("a"), "short", F.length("long").alias("b"), "long")
    edges, taken = stored(edges.distinct(), "pairs-left"), []
    while not edges.isEmpty():
        root = _rooted(edges)
        parts = stored(edges.join(root.withColumnRenamed("key", "short"), ["brand_norm", "short"]), "parts")
        sizes = parts.groupBy("brand_norm", "root").agg(F.count("*").alias("size"))
        lists = parts.join(sizes.filter(F.col("size") <= SETTLED), ["brand_norm", "root"]).groupBy("brand_norm", "root").agg(F.array_sort(F.collect_list(order)).alias("pairs"))
        none = F.struct(F.array().cast("array<string>").alias("used"), F.array().cast("array<struct<short:string,long:string>>").alias("taken"))

        def settle(s: Column, p: Column) -> Column:
            free = ~F.array_contains(s["used"], p["short"]) & ~F.array_contains(s["used"], p["long"])
            more = F.struct(F.concat(s["used"], F.array(p["short"], p["long"])).alias("used"), F.concat(s["taken"], F.array(F.struct(p["short"].alias("short"), p["long"].alias("long")))).alias("taken"))
            return F.when(free, more).otherwise(s)

        settled = lists.select("brand_norm", F.explode(F.aggregate("pairs", none, settle)["taken"]).alias("p")).select("brand_norm", "p.short", "p.long")
        taken.append(stored(settled, "pairs-taken"))
        large = stored(parts.join(sizes.filter(F.col("size") > SETTLED), ["brand_norm", "root"], "left_semi").select("brand_norm", "short", "long"), "pairs-left")
        dropped(edges, parts)
        edges = large
        if not edges.isEmpty():
            ends = edges.select("brand_norm", order.alias("pair"), F.explode(F.array("short", "long")).alias("key"))
            firsts = ends.groupBy("brand_norm", "key").agg(F.min("pair").alias("pair"))
            both = firsts.groupBy("brand_norm", "pair").count().filter("count = 2")
            taken.append(stored(both.select("brand_norm", "pair.short", "pair.long"), "pairs-taken"))
            used = taken[-1].select("brand_norm", F.explode(F.array("short", "long")).alias("key"))
            left = edges
            for end in ("short", "long"):
                left = left.join(used.withColumnRenamed("key", end), ["brand_norm", end], "left_anti")
            left = stored(left.select("brand_norm", "short", "long"), "pairs-left")
            dropped(edges)
            edges = left
    return reduce(DataFrame.unionByName, taken) if taken else edges


def fuzzy_groups(groups: DataFrame, least: int = 6) -> DataFrame:
    """canon, brand_norm, group_key, kind: keys of one source join a group of their brand that they contain or are contained in.

    A key has several sources if its offers of any brand have. Of the groups that fit, the first by length, then by text,
    counts. The keys left over pair up among themselves where one contains the other and their sources differ.
    """
    sources = F.array_distinct(F.flatten(F.collect_list("sources")))
    spread = groups.groupBy("canon").agg((F.size(sources) >= 2).alias("multi"))
    keys = stored(groups.join(spread, "canon").select("canon", "brand_norm", "multi", F.try_element_at("sources", F.lit(1)).alias("source")), "keys")
    pairs = stored(contained_keys(keys, F.struct("multi", "source")), "contained")
    one, many = lambda end: ~F.col(f"of_{end}.multi") & (F.length(end) >= least), lambda end: F.col(f"of_{end}.multi")
    hits = [pairs.filter(one(x) & many(y)).select("brand_norm", F.col(x).alias("canon"), F.col(y).alias("group")) for x, y in (("long", "short"), ("short", "long"))]
    joined = stored(first_by(hits[0].unionByName(hits[1]), ["brand_norm", "canon"], [F.length("group"), F.col("group")]), "joined")
    edges = pairs.filter(one("short") & one("long") & (F.col("of_short.source") != F.col("of_long.source"))).select("brand_norm", "short", "long")
    for end in ("short", "long"):
        edges = edges.join(joined.select("brand_norm", F.col("canon").alias(end)), ["brand_norm", end], "left_anti")
    paired = first_come(edges).select("brand_norm", F.explode(F.array("short", "long")).alias("canon"), F.col("short").alias("mate"))
    out = keys.join(joined, ["brand_norm", "canon"], "left").join(paired, ["brand_norm", "canon"], "left")
    kind = F.when(F.col("multi"), "exact").when(F.col("group").isNotNull(), "contained").when(F.col("mate").isNotNull(), "paired").otherwise("single")
    return out.select("canon", "brand_norm", F.coalesce("group", "mate", "canon").alias("group_key"), kind.alias("kind"))


def _starts(key: Column, least: int) -> Column:
    """All starts of a key of ``least`` characters or more, itself included; none of a shorter key."""
    return F.when(F.length(key) >= least, F.transform(F.sequence(F.lit(least), F.length(key)), lambda n: F.substring(key, F.lit(1), n))).otherwise(F.array())


def _pieces(key: Column, least: int) -> Column:
    """All pieces of a key of ``least`` characters or more, itself included, each once; none of a shorter key."""
    of = lambda i: F.transform(F.sequence(F.lit(least), F.length(key) - i + 1), lambda n: F.substring(key, i, n))
    return F.when(F.length(key) >= least, F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length(key) - least + 1), of)))).otherwise(F.array())


def prefix_match(left: DataFrame, right: DataFrame, brand: str = "brand_norm", key: str = "canon", least: int = 6) -> DataFrame:
    """left rows with match: an equal key of the brand, else the shortest longer or shorter one of which one starts the other.

    The longer key states all of its starts, and the shorter one is one of them: an equality join, whose rows are the pairs
    themselves. A start that all keys of a brand share joins nothing unless it is a key.
    """
    r = right.filter(F.length(key) >= least).select(brand, F.col(key).alias("match")).distinct()
    l = left.filter(F.length(key) >= least).select(brand, key).distinct()
    within = l.select(brand, key, F.explode(_starts(F.col(key), least)).alias("match")).join(r, [brand, "match"])
    beyond = r.select(brand, "match", F.explode(_starts(F.col("match"), least)).alias(key)).join(l, [brand, key]).filter(F.col("match") != F.col(key))
    pairs = within.select(brand, key, "match").unionByName(beyond.select(brand, key, "match"))
    best = first_by(pairs.withColumn("__far", F.col("match") != F.col(key)), [brand, key], [F.col("__far"), F.length("match"), F.col("match")])
    return left.join(best.select(brand, key, "match"), [brand, key], "left")


def brand_levels(names: DataFrame, brands: DataFrame, name: str = "name", brand: str = "brand", size: int = 3) -> DataFrame:
    """name, match, level: equal, equal by letters and digits, else the contained or containing brand closest in length.

    The longer of two keys states its pieces of ``size`` characters or more, and the shorter one is one of them.
    """
    b = brands.select(F.col(brand).alias("match"), text.alnum_upper(F.col(brand)).alias("bk")).distinct()
    n = names.select(F.col(name).alias("name"), text.alnum_upper(F.col(name)).alias("nk")).distinct()
    inside = n.withColumn("piece", F.explode(_pieces(F.col("nk"), size))).join(b.withColumn("piece", F.col("bk")), "piece")
    around = b.withColumn("piece", F.explode(_pieces(F.col("bk"), size))).join(n.withColumn("piece", F.col("nk")), "piece")
    rows = n.join(b, F.col("name") == F.col("match")).select("name", "match", F.lit(1).alias("level"), F.lit(0).alias("gap"))
    rows = rows.unionAll(n.filter("nk <> ''").join(b, F.col("nk") == F.col("bk")).select("name", "match", F.lit(2), F.lit(0)))
    rows = rows.unionAll(inside.unionByName(around).select("name", "match", F.lit(3), F.abs(F.length("nk") - F.length("bk"))))
    best = first_by(rows, ["name"], [F.col("level"), F.col("gap"), F.col("match")])
    return n.select("name").join(best.select("name", "match", "level"), "name", "left")


def dictionary_lookup(names: DataFrame, dictionary: DataFrame, name: str = "name", default: int = 99) -> DataFrame:
    """name (each once) and number: of the dictionary's entry that equals it, else of the first that contains it or that it contains.

    ``dictionary``: entry, rank, number. Names and entries are compared trimmed and in capitals. Pieces of names meet
    entries, and names meet an index of the entries' pieces, by equality; the least rank of both counts. Null and empty
    names, and those that fit nothing, have the default.
    """
    plain = lambda c: F.upper(F.trim(c))
    d = dictionary.select(plain(F.col("entry")).alias("entry"), F.struct("rank", "number").alias("of")).filter("entry <> ''")
    first = d.groupBy("entry").agg(F.min("of").alias("of"))
    n = names.select(F.col(name)).distinct().withColumn("key", plain(F.col(name)))
    keys = n.select("key").filter("key <> ''").distinct()
    exact = keys.join(first.select(F.col("entry").alias("key"), F.col("of").alias("exact")), "key")
    index = first.select(F.explode(_pieces(F.col("entry"), 1)).alias("key"), "of").groupBy("key").agg(F.min("of").alias("of"))
    inside = keys.select("key", F.explode(_pieces(F.col("key"), 1)).alias("entry")).join(first, "entry").select("key", "of")
    near = inside.unionByName(keys.join(index, "key")).groupBy("key").agg(F.min("of").alias("near"))
    found = n.join(exact, "key", "left").join(near, "key", "left")
    return found.select(name, F.coalesce("exact.number", "near.number", F.lit(default)).alias("number"))


def same_family(models: Column, start: int = 6) -> Column:
    """All models contain the shortest one, or all share their first six characters."""
    short = F.element_at(F.array_sort(F.transform(models, lambda m: F.struct(F.length(m).alias("n"), m.alias("m")))), 1)["m"]
    lead = F.substring(F.element_at(models, 1), 1, start)
    return F.forall(models, lambda m: m.contains(short)) | ((F.length(lead) >= start) & F.forall(models, lambda m: m.startswith(lead)))


def same_brand(a: Column, b: Column, least: int = 3) -> Column:
    """Equal or contained by letters and digits; unknown brands pass."""
    x, y = text.alnum_upper(a), text.alnum_upper(b)
    return (x == "") | (y == "") | (x == y) | ((F.least(F.length(x), F.length(y)) >= least) & (x.contains(y) | y.contains(x)))


def matched_variants(stored: DataFrame, offered: DataFrame, key: str) -> DataFrame:
    """key, stored_id, code, state: stored variants by option code, else by colour and size, else gone; offered ones without
    a stored variant are new. A key with one row on each side matches without looking at them.

    ``stored``: key, stored_id, code, color, size; ``offered``: key, code, color, size, in_stock (code unique per key).
    """
    pair = lambda: F.concat_ws("/", F.lower(F.trim("color")), F.lower(F.trim("size")))
    count = F.count("*").over(Window.partitionBy(key))
    s = stored.withColumn("pair", pair()).withColumn("__ns", count)
    o = offered.withColumn("pair", pair())
    by_code = o.select(key, F.col("code"), F.struct("code", "in_stock").alias("__c"))
    by_pair = first_by(o.select(key, "pair", "code", "in_stock"), [key, "pair"], [F.col("code")]).select(key, "pair", F.struct("code", "in_stock").alias("__p"))
    alone = o.groupBy(key).agg(F.count("*").alias("__no"), F.min(F.struct("code", "in_stock")).alias("__a")).filter("__no = 1").select(key, "__a")
    m = s.join(by_code, [key, "code"], "left").join(by_pair, [key, "pair"], "left").join(alone, key, "left")
    hit = F.coalesce(F.when(F.col("__ns") == 1, F.col("__a")), F.col("__c"), F.col("__p"))
    found = m.select(key, "stored_id", hit["code"].alias("code"), F.when(hit.isNull(), "gone").when(hit["in_stock"] == 1, "in").otherwise("out").alias("state"))
    new = o.select(key, "code").join(found.select(key, "code").filter("code IS NOT NULL").distinct(), [key, "code"], "left_anti")
    return found.unionByName(new.select(key, F.lit(None).cast(stored.schema["stored_id"].dataType).alias("stored_id"), "code", F.lit("new").alias("state")))
