from datetime import datetime
from functools import reduce
from operator import add

import duckdb
import pytest

from cohortica.plans import catalog

PRICES = [0.1, 0.2, 0.3, 1e6 + 0.7, 1e-4]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Customers with the same prices, each in another order, whose sums in doubles differ."""
    path = str(tmp_path_factory.mktemp("orders"))
    spark.createDataFrame([(i, "BUILDING", 1, 5.0) for i in range(6)], "c_custkey long, c_mktsegment string, c_nationkey int, c_acctbal double").write.parquet(f"{path}/customer.parquet")
    orders = [PRICES[i:] + PRICES[:i] for i in range(5)]
    rows = [(10 * i + j, i, "O", p, datetime(1995, 1, 1), "1-URGENT") for i, ps in enumerate(orders) for j, p in enumerate(ps)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").coalesce(1).write.parquet(f"{path}/orders.parquet")
    return path


def test_equal_orders_in_another_order(spark, folder):
    assert len({reduce(add, PRICES[i:] + PRICES[:i]) for i in range(5)}) > 1  # sum() makes up for rounding
    got = {(r.spend, r.mean_order, r.n_orders) for r in catalog.respondents(spark, folder).collect()}
    assert got == {(1000001.3001, 1000001.3001 / 5, 5.0), (None, None, 0.0)}


@pytest.mark.parametrize("name", ["dictionary", "entropy", "screen_features", "topk_per_group"])
def test_as_their_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("customer", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df, rel = catalog.queries()[name](spark, folder), con.sql(catalog.oracle_sql()[name])
    cols = sorted(df.columns)
    at = [rel.columns.index(x) for x in cols]
    assert sorted(map(repr, ([r[x] for x in cols] for r in df.collect()))) == sorted(map(repr, ([r[i] for i in at] for r in rel.fetchall())))
    assert name != "dictionary" or {r.n_unique for r in df.collect() if r.variable in ("spend", "mean_order")} == {1}
