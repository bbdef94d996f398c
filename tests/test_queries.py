"""Every query with SQL against DuckDB, and streams against their batch twins, on the smallest tables."""

import math

import duckdb
import pytest

from conftest import SF
from marketlane import plans

QUERIES, SQL = plans.load()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr)
    if name not in SQL:
        assert got
        return
    found = duck.sql(SQL[name])
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    assert got == sorted(([plain(r[i]) for i in at] for r in found.fetchall()), key=repr)


def test_both_forms_of_registered_agree(spark):
    a, b = (QUERIES[n](spark, SF) for n in ("registered_semi", "registered_join"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_sequence_stream_loses_and_doubles_nothing(spark):
    """Crawls that contain the known sequence: every sale of the last crawl comes out once."""
    got = QUERIES["stream_watermark"](spark, SF)
    assert got.filter("NOT over").groupBy("seller_id", "sale_date", "item_id", "qty").count().filter("count > 3").isEmpty()


def test_entry_without_optional_parts():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
