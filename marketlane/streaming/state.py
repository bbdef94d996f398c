"""Keyed state: up/down days, and order lists that continue a known sequence."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Fixed value: so many of the newest orders are remembered as the known sequence.
WATERMARK_SIZE = 30


def up_days_step(n: int, closed: float, since: int | None, events: list) -> tuple[int, float, int | None]:
    """The state after events (microseconds, kind) in order of time."""
    for us, what in events:
        if what == "up" and since is None:
            n, since = n + 1, us
        elif what == "down" and since is not None:
            closed, since = closed + (us - since) / 1e6, None
    return n, closed, since


def up_days_stream(events: DataFrame, key: str, time: str, kind: str, late: str | None = None) -> DataFrame:
    """Per key and batch: n_ups, closed seconds, and since (microseconds, null when down), of all events so far by time.

    Events may arrive in any order: a key's events stay in its state until the watermark has passed them. Without
    ``late`` there is no watermark, and all stay; with it, events that come later no longer count.
    """
    schema = "key long, n_ups long, closed double, since long"

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, closed, since, held = state.get if state.exists else (0, 0.0, None, "[]")
        passed = state.getCurrentWatermarkMs() * 1000 if late else None
        rows = pd.concat(batches)[["us", "kind"]].itertuples(index=False)
        waiting = sorted([*map(tuple, json.loads(held)), *((int(us), what) for us, what in rows if passed is None or us >= passed)], key=lambda e: e[0])
        done = 0 if passed is None else sum(us < passed for us, _ in waiting)
        n, closed, since = up_days_step(n, closed, since, waiting[:done])
        state.update((n, closed, since, json.dumps(waiting[done:])))
        n, closed, since = up_days_step(n, closed, since, waiting[done:])
        yield pd.DataFrame({"key": [k[0]], "n_ups": [n], "closed": [closed], "since": pd.array([since], "Int64")})

    timed = events.withColumn("__time", F.col(time).cast("timestamp"))
    timed = timed.withWatermark("__time", late) if late else timed
    rows = timed.select(F.col(key).alias("key"), "__time", F.unix_micros("__time").alias("us"), F.col(kind).alias("kind"))
    return rows.groupBy("key").applyInPandasWithState(step, schema, "n_ups long, closed double, since long, held string", "update", GroupStateTimeout.NoTimeout)


def up_days_at(emitted: DataFrame, key: str, as_of: str) -> DataFrame:
    """What ``up_days`` gives in batch, from the last update of each key."""
    open_us = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.col("since")
    return emitted.select(F.col("key").alias(key), "n_ups", (F.col("closed") + F.coalesce(open_us, F.lit(0)) / 1_000_000).alias("seconds"), F.col("since").isNotNull().alias("is_up"))


def boundary(rows: list, known: list) -> int | None:
    """How many rows stand before the first place where ``known`` stands whole; null if it doesn't, or is empty."""
    places = range(len(rows) - len(known) + 1) if known else ()
    return next((at for at in places if rows[at : at + len(known)] == known), None)


def new_rows(rows: list[tuple[str, str, int]], known: list[tuple[str, str, int]]) -> tuple[list, bool]:
    """Of a list that is newest first, the rows before the known sequence, and whether too much may have been taken.

    If the sequence isn't found, rows of the newest known date or later count as new.
    """
    at = boundary(rows, known)
    if at is not None:
        return rows[:at], False
    if not known:
        return rows, False
    newest = max(k[0] for k in known)
    return [r for r in rows if r[0] >= newest], True


def sequence_stream(crawls: DataFrame) -> DataFrame:
    """``crawls``: seller_id, crawl, place (0 is newest), sale_date, item_id, qty. New rows per seller, crawl by crawl."""
    schema = "seller_id long, crawl long, sale_date string, item_id string, qty long, over boolean"

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = [tuple(x) for x in json.loads(state.get[0])] if state.exists else []
        out = []
        for crawl, rows in pd.concat(batches).sort_values(["crawl", "place"]).groupby("crawl"):
            listed = list(zip(rows.sale_date, rows.item_id, map(int, rows.qty), strict=True))
            new, over = new_rows(listed, known)
            out += [(k[0], crawl, *r, over) for r in new]
            known = listed[:WATERMARK_SIZE] or known
        state.update((json.dumps(known),))
        yield pd.DataFrame(out, columns=["seller_id", "crawl", "sale_date", "item_id", "qty", "over"])

    return crawls.groupBy("seller_id").applyInPandasWithState(step, schema, "known string", "append", GroupStateTimeout.NoTimeout)


def record_stream(observations: DataFrame, key: str, time: str, fav: str, view: str) -> DataFrame:
    """For each batch and key: its two newest observations so far, ``new`` and ``old``, and obs_count, for ``monitor.recorded``.

    The state is these two and the count. A late observation takes its place among them if it is newer than the older one.
    """
    shape = "struct<at:timestamp_ntz,fav:long,view:long>"

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, count = state.get if state.exists else ("[]", 0)
        two = [tuple(x) for x in json.loads(held)]
        for b in batches:
            count += len(b)
            two = sorted([*two, *zip(b["us"].tolist(), b["fav"].tolist(), b["view"].tolist(), strict=True)], reverse=True)[:2]
        state.update((json.dumps(two), count))
        flat = [*two, *[(None, None, None)] * (2 - len(two))]
        yield pd.DataFrame([(k[0], *flat[0], *flat[1], count)], columns=["key", "at1", "fav1", "view1", "at2", "fav2", "view2", "obs_count"]).astype({c: "Int64" for c in ("at1", "fav1", "view1", "at2", "fav2", "view2")})

    us = F.unix_micros(F.col(time).cast("timestamp")).alias("us")
    rows = observations.select(F.col(key).alias("key"), us, F.col(fav).cast("long").alias("fav"), F.col(view).cast("long").alias("view"))
    schema = "key long, at1 long, fav1 long, view1 long, at2 long, fav2 long, view2 long, obs_count long"
    emitted = rows.groupBy("key").applyInPandasWithState(step, schema, "two string, n long", "update", GroupStateTimeout.NoTimeout)
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    one = lambda n: F.when(F.col(f"at{n}").isNotNull(), F.struct(at(f"at{n}").alias("at"), F.col(f"fav{n}").alias("fav"), F.col(f"view{n}").alias("view"))).cast(shape)
    return emitted.select(F.col("key").alias(key), one(1).alias("new"), one(2).alias("old"), "obs_count")


def window_counts(events: DataFrame, time: str, kind: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts per event-time window and kind; rows later than ``late`` no longer count."""
    timed = events.withColumn("__time", F.col(time).cast("timestamp")).withWatermark("__time", late)
    counted = timed.groupBy(F.window("__time", width).alias("w"), F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), "kind", "n")
