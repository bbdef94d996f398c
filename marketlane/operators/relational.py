"""Building blocks that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane.sources.sinks import stored


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in a total order: an aggregate that combines before the shuffle, not a sort."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*keys, *(F.col(f"__row.{c}").alias(c) for c in rest))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "nth") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), fill: Sequence[str] = ()) -> DataFrame:
    """``target`` after a merge: source rows win; columns in ``keep`` stay once set, those in ``fill`` change only to non-null."""
    t, s = target.select("*", F.lit(1).alias("__t")).alias("t"), source.select("*", F.lit(1).alias("__s")).alias("s")
    joined = t.join(s, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "full_outer")

    def pick(c: str) -> Column:
        if c not in source.columns:
            return F.col(f"t.{c}")
        if c in keys or c in fill:
            return F.coalesce(f"s.{c}", f"t.{c}")
        if c in keep:
            return F.coalesce(f"t.{c}", f"s.{c}")
        return F.when(F.col("__s").isNotNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    return joined.select(*(pick(c).alias(c) for c in target.columns))


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(source.dropDuplicates(list(keys)).join(target, list(keys), "left_anti"))


def replace_children(target: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """All children of the keys present in ``children`` are replaced; those of other keys stay."""
    return target.join(children.select(key).distinct(), key, "left_anti").unionByName(children)


def full_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """keys, change (new, changed, gone, same) and the new values."""
    o = old.select(*keys, F.struct(*values).alias("__old"))
    n = new.select(*keys, F.struct(*values).alias("__new"))
    change = F.when(F.col("__old").isNull(), "new").when(F.col("__new").isNull(), "gone").when(F.col("__old") != F.col("__new"), "changed").otherwise("same")
    return o.join(n, list(keys), "full_outer").select(*keys, change.alias("change"), *(F.col(f"__new.{v}").alias(v) for v in values))


def running_sum(rows: DataFrame, order: str | Sequence[Column], amount: str, name: str, descending: bool = False, parts: int | None = None) -> DataFrame:
    """``rows`` with the sum of ``amount`` up to each row, in an order that no two rows share: a column's, or that of several.

    Spark deals the rows into parts by ranges of the order; they are stored with their part, so ``rows`` are computed once.
    Sums of whole parts, one row for each, give what lies before a part, and a window within the part the rest. No task
    sorts much more than one in ``parts`` of the rows (by default, as many as the session's shuffles have partitions), and
    rows equal in the first column don't have to stay together.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [(F.desc if descending else F.asc)(order)] if isinstance(order, str) else list(order)
    placed = stored(rows.repartitionByRange(parts, *by).withColumn("__part", F.spark_partition_id()), "running")
    sums = placed.groupBy("__part").agg(F.sum(amount).alias("__sum"))
    before = sums.select("__part", (F.sum("__sum").over(Window.orderBy("__part")) - F.col("__sum")).alias("__before"))
    within = F.sum(amount).over(Window.partitionBy("__part").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("__within", within).join(F.broadcast(before), "__part").withColumn(name, F.col("__within") + F.col("__before")).drop("__part", "__within", "__before")


def prefix_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], size: Column, budget: int) -> DataFrame:
    """The longest start of each ordered group whose sizes sum up to the budget, and how many rows don't fit."""
    w = Window.partitionBy(*keys).orderBy(*order)
    used = df.withColumn("__used", F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__at", F.row_number().over(w))
    fits = F.col("__used") <= budget
    return used.groupBy(*keys).agg(F.count_if(fits).alias("n_kept"), F.count_if(~fits).alias("n_over"), F.coalesce(F.max(F.when(fits, F.col("__used"))), F.lit(0)).alias("used"))


def as_of_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: Sequence[str]) -> DataFrame:
    """``left`` with the latest right row of its key at or before its time: one union and one running window, no range join."""
    rows_l = left.withColumns({"__time": F.col(left_time), "__side": F.lit(1), **{f"__{v}": F.lit(None).cast(right.schema[v].dataType) for v in values}})
    filler = [F.lit(None).cast(left.schema[c].dataType).alias(c) if c != key else F.col(key) for c in left.columns]
    rows_r = right.select(*filler, F.col(right_time).alias("__time"), F.lit(0).alias("__side"), *(F.col(v).alias(f"__{v}") for v in values))
    w = Window.partitionBy(key).orderBy("__time", "__side").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("__side") == 0, F.struct(*(F.col(f"__{v}") for v in values))), ignorenulls=True).over(w)
    out = rows_l.unionByName(rows_r).withColumn("__seen", seen).filter("__side = 1")
    return out.select(*left.columns, *(F.col(f"__seen.__{v}").alias(v) for v in values))


def grid(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """For each key, every pair of its values of two columns: two small arrays per key, never a product of tables."""
    sets = df.groupBy(key).agg(F.collect_set(a).alias("__a"), F.collect_set(b).alias("__b"))
    return sets.select(key, F.explode("__a").alias(a), "__b").select(key, a, F.explode("__b").alias(b))


def share_split(df: DataFrame, flag: Column) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.count_if(flag).alias("n_flag"), F.round(F.try_divide(F.count_if(flag), F.count("*")), 6).alias("share"))
