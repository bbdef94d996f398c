"""Writers, files, raw rows, labels and budgets on rows made up for them."""

import pytest
from pyspark.sql import functions as F

from marketlane.functions import money
from marketlane.operators import demand, filters, lookups, monitor, selection
from marketlane.sources import files, raw_rows, sinks
from marketlane.sources.raw_rows import Field
from marketlane.streaming import runs, state


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])


def test_a_batch_that_dies_between_two_tables(spark, tmp_path, monkeypatch):
    """What is written before the manifest isn't seen; the batch is repeated as if nothing had been."""
    base, schema = str(tmp_path), "k long"
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], schema)
    sinks.composite_save({"header": rows(1), "details": rows(1, 1), "state": rows(1)}, base, 0)
    broken = rows(2).select(F.when(F.raise_error(F.lit("lost")).isNull(), F.col("k")).alias("k"))
    with pytest.raises(Exception, match="lost"):
        sinks.composite_save({"header": rows(2), "details": broken, "state": rows(2)}, base, 1)
    read = lambda name: plain(sinks.composite_read(spark, base, name, schema))
    assert (read("header"), read("details"), read("state")) == ([(1, 0)], [(1, 0), (1, 0)], [(1, 0)])
    for _ in range(2):
        sinks.composite_save({"header": rows(2), "details": rows(2, 2, 2), "state": rows(2)}, base, 1)
    assert sinks.composite_batches(spark, base) == [0, 1]
    assert (read("header"), len(read("details")), read("state")) == ([(1, 0), (2, 1)], 5, [(1, 0), (2, 1)])


def test_nothing_saved_reads_as_no_rows(spark, tmp_path):
    got = sinks.composite_read(spark, str(tmp_path / "none"), "header", "k long")
    assert got.columns == ["k", "batch"] and got.count() == 0


def test_json_lines_are_added(spark, tmp_path):
    for k in (1, 2):
        sinks.json_lines(spark.createDataFrame([(k, None)], "k long, s string"), str(tmp_path / "log"))
    assert plain(spark.read.schema("k long, s string").json(str(tmp_path / "log"))) == [(1, None), (2, None)]


def test_exports_as_arrays_and_scripts(spark, tmp_path):
    rows = spark.range(25).withColumn("s", F.lit("a'\"</b>")).repartition(3)
    sinks.json_export(rows, str(tmp_path / "plain"), group=4)
    lines = [r.value for r in spark.read.text(str(tmp_path / "plain")).collect()]
    import json

    assert sorted(x["id"] for line in lines for x in json.loads(line)) == list(range(25)) and max(len(json.loads(line)) for line in lines) == 4
    sinks.json_export(rows, str(tmp_path / "script"), "data")
    assert all(r.value.startswith("window.data = (window.data || []).concat([{") for r in spark.read.text(str(tmp_path / "script")).collect())


def test_tables_of_a_database(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/base;create=true"
    rows = spark.range(100).select(F.col("id").alias("K"), (F.col("id") * 2).alias("V"))
    rows.write.format("jdbc").options(url=url, dbtable="T", driver="org.apache.derby.jdbc.EmbeddedDriver").save()
    read = files.jdbc(spark, url, "T", "K", 0, 100, 4, driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert read.rdd.getNumPartitions() == 4 and read.agg(F.sum("V")).first()[0] == 9900


def test_newest_rows_with_and_without_the_column(spark):
    spark.range(50).withColumn("at", F.col("id") * 3).createOrReplaceTempView("browsed")
    assert [r.id for r in files.newest(spark, "browsed", "at", 3).collect()] == [49, 48, 47]
    assert files.newest(spark, "browsed", "missing", 3).count() == 3


def test_tab_separated_text(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("﻿a\tb\n1\tx\ny\t\n", encoding="utf-8")
    assert plain(files.csv_table(spark, str(tmp_path / "t.tsv"), "b string, a long", sep="\t")) == [(None, None), ("x", 1)]


def test_raw_rows_and_their_reasons(spark):
    d = spark.createDataFrame([(1, "a" * 300, "₩1,200"), (2, None, "free"), (3, "c", None)], "id int, name string, price string")
    price = raw_rows.number(F.col("price"))
    got = raw_rows.mapped(d, "s", {"mall_product_id": Field(F.col("id")), "product_name": Field(F.col("name"), "NONAME", {"no name": F.col("name") != ""}), "raw_price": Field(price, 0, {"no price": price > 0})})
    assert got.columns == [*raw_rows.RAW, "reasons"]
    assert [(r.mall_product_id, len(r.product_name), r.raw_price, r.reasons) for r in got.collect()] == [("1", 255, 1200, []), ("2", 6, 0, ["no name", "no price"]), ("3", 1, 0, ["no price"])]
    assert raw_rows.accepted(got).count() == 1 and plain(raw_rows.rejected(got)) == [("s", "2", "no name"), ("s", "2", "no price"), ("s", "3", "no price")]
    with pytest.raises(ValueError, match="other"):
        raw_rows.mapped(d, "s", {"other": Field(F.col("id"))})


@pytest.mark.parametrize("said,want", [("1,200원", 1200), ("₩ 3 000", 3000), ("12.90", 12), ("KRW5", 5), ("ask", None), ("", None), (None, None)])
def test_prices_as_shops_write_them(spark, said, want):
    assert spark.range(1).select(raw_rows.number(F.lit(said).cast("string"))).first()[0] == want


def test_like_takes_texts_as_they_stand(spark):
    d = spark.createDataFrame([("a%b",), ("axb",), ("a_b",), ("a\\b",), (None,)], "t string")
    found = lambda text, form: [r.t for r in d.filter(filters.like(F.col("t"), text, form)).collect()]
    assert (found("%", "contains"), found("_b", "suffix"), found("a\\", "prefix"), found("", "contains")) == (["a%b"], ["a_b"], ["a\\b"], ["a%b", "axb", "a_b", "a\\b"])


def test_shards_of_known_check_sums(spark):
    """CRC32 of 123456789 is 0xCBF43926."""
    d = spark.createDataFrame([("123456789",), ("",), (None,)], "t string")
    assert [r[0] for r in d.select(filters.in_shard(F.col("t"), 1000)).collect()] == [0xCBF43926 % 1000, 0, 0]


def test_auc_with_ties(spark):
    def auc(rows):
        return demand.auc(spark.createDataFrame(rows, "s double, hit int"), "hit", "s").first().auc

    assert auc([(1.0, 0), (2.0, 1), (3.0, 1)]) == 1.0
    assert auc([(1.0, 1), (1.0, 0), (1.0, 0)]) == 0.5
    assert auc([(1.0, 0), (2.0, 1), (2.0, 0), (3.0, 0)]) == (1 + 0.5) / 3
    assert auc([(1.0, 1)]) is None


def test_calls_slots_and_rest(spark):
    calls = spark.createDataFrame([("2024-01-09",)] * 14 + [("2024-01-10",)] * 2 + [("2023-12-01",)] * 99, "at string").withColumn("at", F.to_date("at"))
    left = selection.calls_left(calls, "at", "2024-01-10")
    assert left.first().calls == 3 - 2 and selection.calls_left(calls, "at", "2024-01-09").first().calls == 0
    waiting = spark.createDataFrame([(i, i) for i in range(9)], "k int, s int")
    slots = lambda n: spark.createDataFrame([(n,)], "slots int")
    budget = spark.createDataFrame([(9,)], "calls int")
    assert [r.k for r in selection.filled(waiting, "s", "k", slots(7), budget, 4, 5).collect()] == [8, 7]
    assert [r.k for r in selection.filled(waiting, "s", "k", slots(1), budget, 4, 5).collect()] == [8]
    swaps = spark.createDataFrame([(1, "2024-01-09 12:00:00"), (2, "2024-01-01 00:00:00"), (3, "2024-01-11 00:00:00")], "k int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    assert [r.k for r in selection.rested(waiting, swaps, "k", "at", "2024-01-10 00:00:00", 3).orderBy("k").collect()] == [0, 2, 3, 4, 5, 6, 7, 8]
    pairs = selection.swapped(waiting.filter("k < 4"), waiting.filter("k >= 4"), "s", "k", 6, 2)
    assert plain(pairs) == [(0, 8, 8), (1, 7, 6)]


def test_labels_by_bucket(spark):
    rows = spark.createDataFrame([(1, "s", "Acme", "ACME Corp"), (2, "s", "Acme", "아크메"), (3, "s", "Acme", "Zed"), (4, "s", "Acme", "Other"), (5, "s", "Acme", None), (6, "t", "Acme", "Zed"), (7, "s", None, "Zed")], "id int, store string, label string, maker string")
    catalogue = spark.createDataFrame([("s", None, "zed"), ("s", "Z-E-D", "Zed Inc"), ("t", "", "")], "store string, name string, english string")
    got = {r.id: (r.outcome, r.label) for r in lookups.corrected_labels(rows, catalogue).collect()}
    assert got == {1: ("keep", "Acme"), 2: ("hangul", "Acme"), 3: ("replaced", "Z-E-D"), 4: ("unmapped", "Other"), 5: ("missing", "Acme"), 6: ("unmapped", "Zed"), 7: ("keep", None)}


def test_draws_repeat_themselves(spark):
    a = [r[0] for r in spark.range(500).select(money.seeded_draw(F.col("id"), 3)).collect()]
    assert a == [r[0] for r in spark.range(500).select(money.seeded_draw(F.col("id"), 3)).collect()] and set(a) == set(range(1, 10))
    assert a != [r[0] for r in spark.range(500).select(money.seeded_draw(F.col("id"), 4)).collect()]


SCANS = [(0, 1, "a", 1), (0, 1, "b", 0), (0, 2, "a", 1), (1, 1, "a", 1), (2, 1, "b", 1), (2, 1, "c", 0), (2, 2, "a", 1), (3, 1, "a", 1), (3, 1, "b", 1)]
HISTORY = [(1, "a", 0, 1), (1, "a", 2, 2), (1, "a", 3, 1), (1, "b", 0, 0), (1, "b", 1, 2), (1, "b", 2, 1), (1, "c", 2, 0), (1, "c", 3, 2), (2, "a", 0, 1)]
_SCAN = "scan long, item long, sku string, availability long"


def test_variants_over_scans(spark):
    """Item 2 isn't scanned in 1 and 3, so nothing of it is gone."""
    assert plain(monitor.variant_history(spark.createDataFrame(SCANS, _SCAN))) == HISTORY


def test_variants_as_a_stream_that_is_restarted(spark, tmp_path):
    """A scan is a batch; a run that dies within one is repeated from the checkpoint, and only two versions of the state stay."""
    base, table = str(tmp_path), "item long, sku string, availability long"
    for k in range(4):
        spark.createDataFrame([s for s in SCANS if s[0] == k], _SCAN).write.mode("append").parquet(f"{base}/in")
        stream = runs.file_stream(spark, f"{base}/in", 1_000_000)
        if k == 2:

            def dies(batch, known):
                return monitor.variant_step(batch.withColumn("availability", F.raise_error(F.lit("lost")).cast("long")), known)

            with pytest.raises(Exception, match="lost"):
                runs.versioned(stream, dies, base, table)
        out = runs.versioned(runs.file_stream(spark, f"{base}/in", 1_000_000), monitor.variant_step, base, table)
    assert plain(out.drop("batch")) == HISTORY
    assert sorted(p.name for p in tmp_path.iterdir() if p.name.startswith("v")) == ["v2", "v3"]


def test_records_of_late_observations(spark, tmp_path):
    day = 86_400
    rows = [(1, 0, 0, 0), (1, 4 * day, 30, 100), (1, 2 * day, 10, 50), (2, 5, 60, 1), (1, 1 * day, 9, 9)]
    frame = spark.createDataFrame(rows, "k long, s long, fav long, view long").withColumn("at", F.timestamp_seconds("s").cast("timestamp_ntz"))
    want = monitor.records(frame, "k", "at", "fav", "view")
    got = {r.k: r for r in want.collect()}
    assert (got[1].base_tier, got[1].tier, got[1].fav_velocity, got[1].obs_count) == ("WARM", "HOT", 10.0, 4)
    assert (got[2].base_tier, got[2].fav_velocity, got[2].obs_count) == ("HOT", None, 1)
    for r in rows:
        frame.filter((F.col("k") == r[0]) & (F.col("s") == r[1])).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    emitted = runs.drained(state.record_stream(runs.file_stream(spark, str(tmp_path / "in"), 1), "k", "at", "fav", "view"), "update", "records")
    assert plain(monitor.recorded(runs.latest_per_key(emitted, "k"), "k")) == plain(want)


def test_nothing_of_a_query_stays_in_the_shared_folder_but_what_it_returns(spark):
    """Superseded tables of loops go; the rest is marked to go when the session's process ends."""
    from marketlane.operators import matching

    made = []
    path = sinks.new_path
    try:
        sinks.new_path = lambda s, name: made.append(path(s, name)) or made[-1]
        edges = spark.createDataFrame([("b", "a" * n, "a" * (n + 1)) for n in range(6, 40)], "brand_norm string, short string, long string")
        assert matching.first_come(edges).count() == 17
    finally:
        sinks.new_path = path
    left = [p for p in made if sinks._file_system(spark, p)[0].exists(sinks._file_system(spark, p)[1])]
    assert len(made) > 5 and len(left) <= 3
