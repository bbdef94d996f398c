"""Line dedup: overlapping windows of three lines, hashed and counted over all documents, in DataFrame functions only.

The windows of a document are rows of two 64-bit hashes and a place. A grouped count finds the windows that repeat and
their first place; rows meet these firsts again in a join that is salted by document, so one window that is in a third
of all rows is spread over ``salts`` tasks. Covered places merge into intervals by a running maximum, and the text keeps
the slices between them. Texts move once, to meet their intervals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlane.llm.common import id_key, without

NEW = ("n_lines", "n_removed_lines", "removed_lines")


def _lines(text_col: str) -> F.Column:
    return F.split(F.col(text_col), "\n", -1)


def _windows(keyed: DataFrame, text_col: str, window: int) -> DataFrame:
    lines = _lines(text_col)
    hashed = keyed.select("__key", "__row", F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (F.trim(x) != "").alias("full"))).alias("h"))
    places = F.when(F.size("h") >= window, F.sequence(F.lit(0), F.size("h") - window)).otherwise(F.array().cast("array<int>"))
    at = lambda i, k: F.get(F.col("h"), i + k)
    made = F.transform(
        places,
        lambda i: F.struct(
            i.alias("at"),
            F.xxhash64(*(at(i, k)["a"] for k in range(window))).alias("a"),
            F.xxhash64(*(at(i, k)["b"] for k in range(window))).alias("b"),
            F.greatest(*(at(i, k)["full"] for k in range(window))).alias("full"),
        ),
    )
    return hashed.select("__key", "__row", F.explode(made).alias("w")).select("__key", "__row", "w.*").filter("full").drop("full")


def removed_intervals(keyed: DataFrame, text_col: str, window: int, salts: int) -> DataFrame:
    """For each document that loses lines, by (__key, __row): the ascending, disjoint intervals of lines to remove."""
    windows = _windows(keyed, text_col, window)
    place = F.struct("__key", "__row", "at")
    firsts = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select("a", "b", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = windows.withColumn("salt", F.pmod(F.xxhash64("__key", "__row"), F.lit(salts)).cast("int"))
    later = salted.join(firsts, ["a", "b", "salt"]).filter(place > F.col("first")).select("__key", "__row", "at")
    by_doc = Window.partitionBy("__key", "__row").orderBy("at")
    reach = F.max(F.col("at") + window).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("at") > F.col("reach"), 1).otherwise(0)).over(by_doc)
    merged = later.withColumn("reach", reach).withColumn("island", island).groupBy("__key", "__row", "island").agg(F.min("at").alias("start"), (F.max("at") + window).alias("end"))
    return merged.groupBy("__key", "__row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__gone"))


def line_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = 3, salts: int = 16) -> DataFrame:
    """``docs`` with the text that stays, and n_lines, n_removed_lines, removed_lines (intervals of line numbers from 0).

    Lines end at ``\\n``. A line goes if a window of ``window`` lines that covers it is equal to one that starts earlier:
    in a document of smaller id, or earlier in the same one; all windows are judged on the input. Windows of blank lines
    (nothing but spaces) only are no windows. A null text stays null and has no lines, an empty one has one line. Null
    ids count as smaller than any other; different texts with one id are ordered by hash, rows that repeat an id and its
    text are one document and get one result. New columns replace those of the same names.
    """
    kept_columns = [c for c in docs.columns if c in without(docs, NEW)]
    keyed = docs.select(*kept_columns, id_key(id_col).alias("__key"), F.xxhash64(text_col).alias("__row"))
    joined = keyed.join(removed_intervals(keyed, text_col, window, salts), ["__key", "__row"], "left")
    lines, gone = _lines(text_col), F.col("__gone")
    begin = lambda k: F.when(k == 0, 0).otherwise(F.get(gone, k - 1)["end"])
    end = lambda k: F.when(k == F.size(gone), F.size(lines)).otherwise(F.get(gone, k)["start"])
    stay = F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), lambda k: F.slice(lines, begin(k) + 1, end(k) - begin(k))))
    text = F.when(gone.isNull(), F.col(text_col)).otherwise(F.array_join(stay, "\n"))
    count = F.coalesce(F.aggregate(gone, F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"])), F.lit(0).cast("long"))
    return joined.select(
        *(text.alias(c) if c == text_col else F.col(c) for c in kept_columns),
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        count.alias("n_removed_lines"),
        F.coalesce(gone, F.array().cast("array<struct<start:int,end:int>>")).alias("removed_lines"),
    )


def digest(found: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, "n_lines", "n_removed_lines", F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("kept_sha256"))


SQL = """
WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
places AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS pos FROM lines),
windows AS (SELECT doc_id, pos, l[pos] AS x, l[pos + 1] AS y, l[pos + 2] AS z FROM places),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, pos) AS nth
  FROM windows WHERE trim(x) <> '' OR trim(y) <> '' OR trim(z) <> ''),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM ranked, (SELECT unnest([0, 1, 2]) AS k) AS steps WHERE nth > 1),
numbered AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM lines),
kept AS (
  SELECT n.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed_lines,
         coalesce(string_agg(n.line, chr(10) ORDER BY n.pos) FILTER (WHERE g.pos IS NULL), '') AS kept
  FROM numbered AS n LEFT JOIN gone AS g ON n.doc_id = g.doc_id AND n.pos = g.pos GROUP BY n.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed_lines, 0) AS n_removed_lines, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents AS d LEFT JOIN kept AS k ON d.doc_id = k.doc_id
"""
