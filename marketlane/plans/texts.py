"""Queries of texts for the marketplace: safe signs, names within a display width, and words looked up in a dictionary."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane.functions import text
from marketlane.operators import matching
from marketlane.plans import query
from marketlane.sources.domain import read


@query("""
WITH t AS (SELECT p_partkey AS i, translate(p_name, 'aeiou', 'áèîöů') || CASE p_partkey % 4 WHEN 0 THEN '™ “x”' WHEN 1 THEN ' – ½…' WHEN 2 THEN ' 가é®' ELSE '' END AS t FROM part)
SELECT i, replace(replace(replace(replace(replace(replace(replace(strip_accents(t), '™', '(TM)'), '“', '"'), '”', '"'), '–', '-'), '½', '1/2'), '…', '...'), '®', '(R)') AS safe FROM t""")
def safe_texts(spark, sf_dir):
    """STRF-13: accents taken off, by composed characters and by marks that stand apart, and signs that are refused replaced."""
    i = F.col("p_partkey")
    more = F.when(i % 4 == 0, "™ “x”").when(i % 4 == 1, " – ½…").when(i % 4 == 2, " 가é®").otherwise("")
    said = F.concat(F.translate("p_name", "aeiou", "áèîöů"), more)
    return read(spark, sf_dir, "part").select(i.alias("i"), text.sanitized(said).alias("safe"))


_LONG = "CASE p_partkey % 5 WHEN 0 THEN p_name || ' ' || p_brand WHEN 1 THEN '가나다라 ' || p_name WHEN 2 THEN 'ブランド' || p_type || ' 正規販売店' WHEN 3 THEN '±' || p_name || '+ ' || p_type || '+x' ELSE p_brand || '正規販売店' END"
_FIT = """
{n} AS (SELECT i, coalesce(string_agg(c, '' ORDER BY pos) FILTER (WHERE used <= {limit}), '') AS s FROM (
  SELECT i, c, pos, sum(CASE WHEN regexp_matches(c, '[가-힣ァ-ヿ一-龥±]') THEN 2 ELSE 1 END) OVER (PARTITION BY i ORDER BY pos) AS used FROM chars) AS x GROUP BY i)"""


@query(f"""
WITH t AS (SELECT p_partkey AS i, {_LONG} AS t FROM part),
chars AS (SELECT i, unnest(string_split(t, '')) AS c, unnest(range(1, length(t) + 1)) AS pos FROM t),
widths AS (SELECT i, t, length(t) + length(regexp_replace(t, '[^가-힣ァ-ヿ一-龥±]', '', 'g')) AS width FROM t),
{_FIT.format(n="named", limit=14).strip()}, {_FIT.format(n="cut", limit=15).strip()},
colors AS (SELECT i, list_filter(list_transform(string_split(t, '+'), lambda x: trim(x)), lambda x: x <> '') AS p FROM t)
SELECT i, CAST(width AS INTEGER) AS width, regexp_replace(n.s, '\\s+$', '') AS name,
       CASE WHEN width <= 18 THEN t WHEN len(p) > 1 AND length(p[1]) + 6 + CASE WHEN p[1] LIKE '%±%' THEN 1 ELSE 0 END <= 18 THEN p[1] || ' 外' || (len(p) - 1) || '色' ELSE c.s || '...' END AS option,
       CASE WHEN width <= 19 THEN t WHEN ends_with(t, '正規販売店') AND width - 4 <= 19 THEN replace(t, '正規販売店', '正規店') ELSE 'BRAND 正規販売店' END AS shop
FROM widths JOIN named AS n USING (i) JOIN cut AS c USING (i) JOIN colors USING (i)""")
def fitted_texts(spark, sf_dir):
    """STRF-14: names, options and shops cut to a display width, in which wide characters count two."""
    i = F.col("p_partkey")
    said = (
        F.when(i % 5 == 0, F.concat_ws(" ", "p_name", "p_brand"))
        .when(i % 5 == 1, F.concat(F.lit("가나다라 "), "p_name"))
        .when(i % 5 == 2, F.concat(F.lit("ブランド"), "p_type", F.lit(" 正規販売店")))
        .when(i % 5 == 3, F.concat(F.lit("±"), "p_name", F.lit("+ "), "p_type", F.lit("+x")))
        .otherwise(F.concat("p_brand", F.lit("正規販売店")))
    )
    fitted = text.fitted_name(said, 14).alias("name"), text.fitted_option(said, 18).alias("option"), text.fitted_shop(said, 19).alias("shop")
    return read(spark, sf_dir, "part").select(i.alias("i"), text.display_width(said).alias("width"), *fitted)


_COLORS = """
words AS (SELECT upper(split_part(p_name, ' ', 1)) AS entry, min(p_partkey) AS rank FROM part GROUP BY 1),
d AS (SELECT *, CAST(rank % 50 AS INTEGER) AS number FROM words UNION ALL SELECT substr(entry, 1, 2), rank + 1000, 60 FROM words WHERE rank % 2 = 0),
n AS (SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN ' ' || split_part(p_name, ' ', 1) WHEN 1 THEN p_name WHEN 2 THEN substr(p_name, 2, 2) WHEN 3 THEN 'ZQ' || p_partkey % 7 ELSE '' END AS name FROM part)"""


@query("WITH " + _COLORS.strip() + """
SELECT name, coalesce((SELECT arg_min(number, rank) FROM d WHERE entry = upper(trim(name)) AND entry <> ''),
       CASE WHEN trim(name) <> '' THEN (SELECT arg_min(number, rank) FROM d WHERE contains(upper(trim(name)), entry) OR contains(entry, upper(trim(name)))) END, 99) AS number FROM n""")
def dictionary_numbers(spark, sf_dir):
    """JOI-24: words of a dictionary whose entries hide one another, the first in its order that contains or is contained, else 99."""
    part = read(spark, sf_dir, "part")
    i, first = F.col("p_partkey"), F.substring_index("p_name", " ", 1)
    words = part.groupBy(F.upper(first).alias("entry")).agg(F.min(i).alias("rank"))
    short = words.filter("rank % 2 = 0").select(F.substring("entry", 1, 2).alias("entry"), (F.col("rank") + 1000).alias("rank"), F.lit(60).alias("number"))
    d = words.withColumn("number", (F.col("rank") % 50).cast("int")).unionByName(short)
    name = F.when(i % 5 == 0, F.concat(F.lit(" "), first)).when(i % 5 == 1, F.col("p_name")).when(i % 5 == 2, F.substring("p_name", 2, 2)).when(i % 5 == 3, F.concat(F.lit("ZQ"), i % 7)).otherwise("")
    return matching.dictionary_lookup(part.select(name.alias("name")), d)
