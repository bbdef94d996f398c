"""Name rules on names made up for them."""

import pytest
from pyspark.sql import functions as F

from marketlane.functions import names


@pytest.mark.parametrize(
    "raw,want",
    [
        ("26SS wool coat", "wool coat"),
        ("[26SS] wool coat", "wool coat"),
        ("[26SS new in] coat", "[new in] coat"),
        ("coat 25F/W long", "coat long"),
        ("26년F/W coat", "coat"),
        ("L/S shirt", "L/S shirt"),
        ("25FW-AB1201-54 bag", "25FW-AB1201-54 bag"),
        ("A25SS bag", "A25SS bag"),
        ("스투시26SS 백", "스투시 백"),
        ("ZQ77 19K 23SU", "ZQ77 19K 23SU"),
        ("26SS ZQ77 20F", "ZQ77 20F"),
        ("26SS", ""),
        ("coat F/W 25 long", "coat long"),
        ("coat 2025 f/w (25ss) long", "coat long"),
        ("가방26SS코트 [25FW][AW24]", "가방코트"),
        ("6F bag {SS26 x} 25", "bag {x} 25"),
        ("  ", ""),
        (None, None),
    ],
)
def test_without_seasons(spark, raw, want):
    d = spark.range(1).select(names.without_seasons(F.lit(raw).cast("string")).alias("once"))
    assert d.select("once", names.without_seasons(F.col("once")).alias("twice")).first() == (want, want)


@pytest.mark.parametrize(
    "store,raw,want",
    [
        ("brickmansion", "[Aa x Bb] cap [SALE]", "Aa x Bb cap"),
        ("gimpooutlet", "(국내아울렛)(수량한정) cap (L)", "cap (L)"),
        ("gimpooutlet", "(스크래치 있음) cap", "(스크래치 있음) cap"),
        ("labellusso", "[Aa] [23SS] cap", "cap"),
        ("9tems", "cap 럭키찬스' red", "cap red"),
        ("dmont", " 디몬트 cap", "cap"),
        ("other", "(국내매장) [Aa] 26SS cap", "[Aa] cap"),
        (None, "[국내배송] cap", "cap"),
        ("dmont", None, None),
    ],
)
def test_clean_name(spark, store, raw, want):
    d = spark.createDataFrame([(store, raw)], "store string, name string")
    once = d.withColumn("name", names.clean_name(F.col("store"), F.col("name")))
    assert once.first().name == want
    assert once.select(names.clean_name(F.col("store"), F.col("name"))).first()[0] == want


def test_no_season_without_protection(spark):
    d = spark.range(1).select(names.without_seasons(F.lit("ZQ77 23SU"), protect_last=False), names.first_without([F.lit("한"), F.lit(""), F.lit("b")], "[가-힣]"))
    assert d.first() == ("ZQ77", "b")


def test_a_name_is_read_once(spark):
    """Runs and words of a name are computed once, not for each element that looks at its neighbours."""
    rows = spark.createDataFrame([("tuttobene", "[국내배송] 26SS bag")], "store string, raw string")
    plan = rows.select(names.clean_name(F.col("store"), F.col("raw")).alias("name"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") <= 2
