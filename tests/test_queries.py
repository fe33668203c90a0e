"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__
from loomstep.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    out = duckdb.connect()
    for t in TABLES:
        out.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return out


def rows_of(frame):
    show = lambda v: "-" if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(show, r)) for r in frame[sorted(frame.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql(spark, sf_dir, duck, name):
    got, want = registry.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_rows_only(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_large_sizes(spark, tmp_path):
    """Keys from the last GiB below 1,024 on: beyond them X19's SQL goes on in GiB."""
    keys = [1, 2, 3, 90, 91, 92_681, 92_682, 100_000, 599_999, 8_999_999, 36_000_000]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    own = duckdb.connect()
    own.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    got = registry.QUERIES["X19_human_bytes"](spark, str(tmp_path)).toPandas()
    assert rows_of(got) == rows_of(own.execute(registry.ORACLES["X19_human_bytes"]).df())
