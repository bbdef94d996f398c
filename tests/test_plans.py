"""What the plans of large queries read and shuffle: each table once, and no more often than the job needs."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from marketlane import plans

QUERIES = plans.load()[0]


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_dealt_once(spark):
    plan = QUERIES["json_documents"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


@pytest.mark.parametrize("name", ["prefix_match", "variant_checks"])
def test_what_is_read_several_times_is_stored(spark, name):
    assert "l_partkey" not in logical(QUERIES[name](spark, SF))


def test_a_token_is_made_once(spark):
    from marketlane.functions import text

    plan = logical(spark.range(1).select(text.model_tokens(F.concat(F.lit("MD00001 SZ"), F.col("id").cast("string"))).alias("t")))
    assert plan.count("upper(") == 1


def test_models_are_summed_before_their_tokens(spark):
    from marketlane.operators import demand

    keyed = spark.createDataFrame([("B", "MD00001 SZ1", 1, 2, 3), ("B", "MD00001 SZ1", 0, 5, 9), ("B", "MD00001", 1, 1, 4), ("", "MD00001", 1, 1, 8)], "brand_key string, model_no string, act long, ord long, fav long")
    cells = demand._codes(keyed)
    assert [tuple(r) for r in cells.collect()] == [("MD00001", "B", 2, 8, 4)]
    plan = logical(cells)
    assert plan.index("Generate explode") < plan.rindex("Aggregate")


def test_variants_are_matched_without_joins_of_counts(spark):
    assert logical(QUERIES["stock_changes"](spark, SF)).count("Join ") <= 8
