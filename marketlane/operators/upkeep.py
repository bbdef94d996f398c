"""Tables that are kept up: updates from joins, rescans, gaps that are filled, recomputing of what changed, daily sweeps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.operators.relational import first_by, ranked, upsert


def updated_from(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str], only_empty: bool = False) -> DataFrame:
    """``target`` with columns from the source row of its key; rows without one stay. ``only_empty`` fills nulls alone.

    Of source rows with one key the first by value counts, so no target row is doubled.
    """
    one = first_by(source.select(key, *columns), [key], [F.col(c) for c in columns])
    s = one.select(key, *(F.col(c).alias(f"__{c}") for c in columns), F.lit(True).alias("__hit"))
    new = lambda c: F.coalesce(c, f"__{c}") if only_empty else F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c))
    return target.join(s, key, "left").select(*(new(c).alias(c) if c in columns else F.col(c) for c in target.columns))


def rescanned(target: DataFrame, scan: DataFrame, key: str, first_seen: str = "first_seen", status: str = "status", gone: str = "gone_at") -> DataFrame:
    """``target`` after a scan: rows seen again become active whatever they were, and keep when they were first seen."""
    seen = scan.withColumn(status, F.lit("ACTIVE")).withColumn(gone, F.lit(None).cast(target.schema[gone].dataType))
    return upsert(target, seen, [key], keep=[first_seen])


def gaps(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has nothing derived yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def stale(stored: DataFrame, rows: DataFrame, key: str, value: str, new: Column) -> DataFrame:
    """key, was, value: stored values that the present rule derives otherwise from ``rows``; keys that aren't stored are none.

    Null and a value differ; two nulls don't.
    """
    fresh = rows.select(key, new.alias("__new"))
    differ = stored.select(key, F.col(value).alias("was")).join(fresh, key).filter(~F.col("was").eqNullSafe(F.col("__new")))
    return differ.select(key, "was", F.col("__new").alias(value))


def recomputed(result: DataFrame, rows: DataFrame, changed: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``result`` with the groups of changed keys computed anew from ``rows``; groups that have no rows any more go."""
    keys = changed.select(key).distinct()
    return result.join(keys, key, "left_anti").unionByName(compute(rows.join(keys, key, "left_semi")))


def swept(state: DataFrame, targets: DataFrame, key: str, day: str, collect: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``state`` (key, day, status) after a day's sweep: targets without a row of the day that says ``done`` are collected.

    ``collect`` gives key and status. A sweep that is run again takes up what failed, and nothing else.
    """
    done = state.filter((F.col("day") == day) & (F.col("status") == "done"))
    fresh = collect(gaps(targets.select(key).distinct(), done, key)).select(key, F.lit(day).alias("day"), "status")
    return upsert(state, fresh, [key, "day"])


def winner_first(rows: DataFrame, group: str, winner: Column, order: Sequence[Column], limit: int) -> DataFrame:
    """Each group's first rows as an array ``rows`` of structs: the winner, then the others by order, ``limit`` at most; and how many there are.

    Ranks are cut before the rows are gathered, so a large group never stands whole in one array.
    """
    first = ranked(rows, [group], [F.coalesce(winner, F.lit(False)).desc(), *order]).filter(F.col("nth") <= limit)
    kept = F.struct("nth", *(c for c in rows.columns if c != group))
    lists = first.groupBy(group).agg(F.sort_array(F.collect_list(kept)).alias("rows"))
    return lists.join(rows.groupBy(group).agg(F.count("*").alias("n")), group)
