"""Queries against DuckDB on tables whose product keys pass a million, as they do at sixty times sf0.1."""

import shutil

import duckdb
import pytest

from conftest import SF
from marketlane import plans
from test_queries import TABLES, plain

QUERIES, SQL = plans.load()


@pytest.fixture(scope="module")
def large(tmp_path_factory):
    """sf0.001 with product keys from 999,900 to 1,000,099, and views of it."""
    folder, c = tmp_path_factory.mktemp("large"), duckdb.connect()
    for t in TABLES:
        key = {"part": "p_partkey", "lineitem": "l_partkey"}.get(t)
        if key:
            c.execute(f"COPY (SELECT * REPLACE ({key} + 999900 AS {key}) FROM '{SF}/{t}.parquet') TO '{folder}/{t}.parquet' (FORMAT parquet)")
        else:
            shutil.copyfile(f"{SF}/{t}.parquet", folder / f"{t}.parquet")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return str(folder), c


def same(spark, large, name):
    folder, duck = large
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    found = duck.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    return sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr) == sorted(([plain(v) for v in r] for r in found), key=repr)


@pytest.mark.parametrize("name", ["canonical_groups", "canonical_keys", "fuzzy_groups", "label_correction", "model_families", "tokens_exploded", "prefix_match"])
def test_models_of_offers(spark, large, name):
    assert same(spark, large, name)


@pytest.mark.parametrize("name", ["clean_new_and_edit", "daily_sweep", "exported_scripts", "group_candidates", "group_list_price", "mart_wide", "token_gap"])
def test_models_of_listings(spark, large, name):
    assert same(spark, large, name)
