"""Streams over many files that are not in order of time, one file a batch, against the whole tables."""

import functools

import pytest
from pyspark.sql import functions as F

from conftest import SF
from marketlane import plans
from marketlane.operators import monitor
from marketlane.streaming import runs, state

QUERIES = plans.load()[0]


@pytest.fixture(scope="module")
def scattered(spark, tmp_path_factory):
    """The tables of the streams as files by hash, in no order of time."""
    out = str(tmp_path_factory.mktemp("scattered"))
    spark.read.parquet(f"{SF}/events.parquet").repartition(6, F.xxhash64("event_id")).write.parquet(f"{out}/events.parquet")
    spark.read.parquet(f"{SF}/lineitem.parquet").repartition(3).write.parquet(f"{out}/lineitem.parquet")
    return out


@pytest.fixture
def file_by_file(monkeypatch):
    monkeypatch.setattr(runs, "file_stream", functools.partial(runs.file_stream, files_per_batch=1))


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_window_counts_in_any_order(spark, scattered, file_by_file):
    e = spark.read.parquet(f"{SF}/events.parquet")
    whole = e.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("start"), F.col("event_type").alias("kind")).agg(F.count("*").alias("n"))
    assert same(QUERIES["stream_window_counts"](spark, scattered), whole)


def test_status_merge_in_any_order(spark, scattered, file_by_file):
    e = spark.read.parquet(f"{SF}/events.parquet")
    whole = e.groupBy("user_id").agg(F.max_by("event_type", "ts").alias("status"), F.max("ts").alias("at"), F.max_by("value", "ts").alias("value"))
    assert same(QUERIES["stream_status_merge"](spark, scattered), whole)


def test_listing_days_in_any_order(spark, scattered, file_by_file):
    assert same(QUERIES["stream_listing_days"](spark, scattered), QUERIES["listing_days"](spark, SF))


def stream_of(spark, folder, parts, schema):
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return runs.file_stream(spark, folder, 1)


def test_merge_keeps_the_first_and_fills_the_last(spark, tmp_path):
    parts = [[(1, 3, "c", "f3", None)], [(1, 1, "a", "f1", "g1"), (2, 1, "x", None, None)], [(1, 2, "b", None, "g2")]]
    got = runs.merged(stream_of(spark, str(tmp_path / "in"), parts, "k long, at long, s string, first string, g string"), ["k"], "at", "m", keep=("first",), fill=("g",))
    assert sorted(map(tuple, got.collect())) == [(1, 3, "c", "f1", "g2"), (2, 1, "x", None, None)]


def test_up_days_pass_out_of_the_state(spark, tmp_path):
    """Events wait for the watermark: one that is late by less counts in its place, one that is later doesn't count."""
    parts = [[(1, 100, "up"), (1, 500, "down")], [(1, 300, "down")], [(1, 5000, "up")], [(1, 10, "up")], [(1, 4900, "down"), (1, 5100, "down")]]
    rows = stream_of(spark, str(tmp_path / "in"), parts, "k long, s long, kind string").withColumn("ts", F.timestamp_seconds("s"))
    for late, closed in (("1000 seconds", 200 + 100), (None, 290 + 100)):
        got = runs.latest_per_key(runs.drained(state.up_days_stream(rows, "k", "ts", "kind", late), "update", "up"), "key").first()
        assert (got.n_ups, got.closed, got.since) == (2, closed, None)


def sales(spark):
    l = spark.read.parquet(f"{SF}/lineitem.parquet").filter("l_shipdate < TIMESTAMP_NTZ '2001-11-05 00:00:00'")
    return l.select(F.col("l_suppkey").alias("seller_id"), F.date_format("l_shipdate", "yyyy/MM/dd").alias("sale_date"), F.col("l_partkey").cast("string").alias("item_id"), F.col("l_quantity").cast("long").alias("qty"))


@pytest.fixture
def file_per_partition(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_sequence_file_by_file(spark, scattered, file_by_file, file_per_partition):
    got = QUERIES["stream_watermark"](spark, scattered)
    assert got.filter("over").isEmpty() and same(sales(spark).filter("sale_date >= '2001/08/01'"), got.filter("sale_date >= '2001/08/01'"))
    assert got.filter("crawl > 0 AND sale_date < '2001/09/05'").isEmpty()


def test_sequence_takes_the_whole_history(spark):
    got = QUERIES["stream_watermark"](spark, SF)
    print("rows emitted, sales:", got.filter("NOT over").count(), sales(spark).count())
    assert same(sales(spark), got.filter("NOT over"))


def test_records_as_a_table(spark, tmp_path):
    """Late observations, in batches of more than one file each: the newest two and the count, as in batch."""
    rows = [(n % 5, (n * 37) % 101, n % 60, n * 7) for n in range(100)] + [(9, 5, 60, 1)]
    frame = spark.createDataFrame(rows, "k long, s long, fav long, view long").withColumn("at", F.timestamp_seconds("s").cast("timestamp_ntz"))
    path, files = runs.scattered(frame, "s", str(tmp_path / "in"))
    step = lambda batch, known: monitor.record_step(batch, known, "k", "at", "fav", "view")
    got = monitor.recorded(runs.table_after(runs.file_stream(spark, path, files), step, "records", monitor.RECORDS.replace("item_id", "k")), "k")
    assert files > 1 and same(got, monitor.records(frame, "k", "at", "fav", "view"))


def test_sequence_step_takes_what_the_python_form_takes(spark):
    """Two crawls in one batch, a known sequence that is found, one that is lost, a seller that comes later, and one that stays away."""
    lists = {
        1: [[("2026/01/03", "c", 1), ("2026/01/02", "b", 2), ("2026/01/01", "a", 1)], [("2026/01/04", "d", 1), ("2026/01/03", "c", 1), ("2026/01/02", "b", 2)], [("2026/01/05", "e", 1), ("2026/01/04", "d", 1), ("2026/01/03", "c", 1)]],
        2: [[("2026/01/03", "c", 1), ("2026/01/02", "b", 2)], [("2026/01/04", "d", 1), ("2026/01/03", "x", 1), ("2026/01/02", "b", 2)], None],
        3: [None, None, [("2026/01/01", "a", 9)]],
        4: [[("2026/01/01", "a", 9)], None, None],
    }
    want = []
    for seller, crawls in lists.items():
        known = []
        for n, rows in enumerate(crawls):
            if rows is not None:
                new, over = state.new_rows(rows, known)
                want += [(seller, n, *r, over) for r in new]
                known = rows[:2] or known
    schema = "seller_id long, crawl long, place int, sale_date string, item_id string, qty long"
    batch = lambda *ns: monitor.sequence_lists(spark.createDataFrame([(k, n, i, *r) for k, cs in lists.items() for n in ns if cs[n] for i, r in enumerate(cs[n])], schema))
    first, known = monitor.sequence_step(batch(0, 1), None, 2)
    second, known = monitor.sequence_step(batch(2), known, 2)
    assert sorted(map(tuple, first.unionByName(second).collect())) == sorted(want)
    assert {r.seller_id: [x.item_id for x in r.known] for r in known.collect()} == {1: ["e", "d"], 2: ["d", "x"], 3: ["a"], 4: ["a"]}
