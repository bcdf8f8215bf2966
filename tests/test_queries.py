"""Registered queries: smoke, SQL-oracle parity on the smallest tables, layout."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date_key", "month_name", "mrr", "customers", "arpa"]


def test_every_query_has_a_callable_and_oracles_subset():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, cur.fetchall())


@pytest.mark.parametrize("name", ["a3_revenue_monthly", "c1_dedupe", "a6_concentration",
                                  "m9_auc_roc", "k1_folds"])
def test_same_answer_with_one_and_many_shuffle_partitions(spark, name, tmp_path):
    out = []
    for parts in ("1", "8"):
        # a path of its own: the panel is built anew under each setting
        folder = tmp_path / parts
        folder.symlink_to(SF_SMALL)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        df = entry.queries()[name](spark, str(folder))
        out.append(_rows(df.columns, [tuple(r) for r in df.collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]
