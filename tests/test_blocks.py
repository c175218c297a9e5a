import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortica.operators import allpairs, distance, validity

C = list("abc")


def table(spark, n=300, seed=8):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(5, 2, (n, 3)), 1)
    return x, spark.createDataFrame([(f"k{i}", i % 3, *map(float, r)) for i, r in enumerate(x)], "id string, cluster int, a double, b double, c double")


def test_rows_are_written_once_however_many_blocks_there_are(spark, monkeypatch):
    """Rows sent to every block that they meet would be shuffled n / BLOCK_ROWS times, in each pass anew."""
    monkeypatch.setattr(allpairs, "BLOCK_ROWS", 20)
    _, df = table(spark)
    blocks = allpairs.blocks_of(df, "id", [("manhattan", C)])
    held = blocks.packed.select("block", F.size("rows").alias("n"), F.spark_partition_id().alias("p")).collect()
    assert len(held) == 15 and sum(r.n for r in held) == 300 and len({r.p for r in held}) == 15
    plan = allpairs.over_blocks(blocks, lambda met: iter(()), "n long")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan and "Generate" not in plan


@pytest.mark.parametrize("method", distance.METHODS)
def test_many_blocks_give_all_pairs(spark, method, monkeypatch):
    monkeypatch.setattr(allpairs, "BLOCK_ROWS", 75)
    _, df = table(spark)
    pairs = distance.pairwise(df, "id", C, method)
    assert allpairs.distribution(df, "id", C, method).first().asDict() == pytest.approx(distance.distance_distribution(pairs).first().asDict(), abs=1e-7)
    of = lambda d: {r.id: r.silhouette for r in d.collect()}
    assert of(allpairs.silhouette(df, "id", C, "cluster", method)) == pytest.approx(of(validity.silhouette(pairs, df)), abs=1e-7)


def test_ranks_without_a_table_of_pairs(spark, monkeypatch):
    """Counted cells give the pairs' coefficient between sure ends, and no table of pairs is made."""
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 1, (700, 3)) * [1, 3, 9], np.zeros((9, 3))])  # copies: pairs at distance 0
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")
    want = distance.distance_correlation(distance.pairwise_many(df, "id", C, ("manhattan", "gower")), "manhattan", "gower").first()
    monkeypatch.setattr(allpairs, "FEW_PAIRS", 0)
    found, (low, middle, high) = allpairs._cells_ranked(allpairs.blocks_of(df, "id", [("manhattan", C), ("gower", C)]), 1 << 12)
    assert low <= want.spearman <= high and high - low < 2e-3 and middle == pytest.approx(want.spearman, abs=1e-5)
    with monkeypatch.context() as m:
        m.setattr(allpairs, "values", None)
        got = allpairs.rank_correlation(df, "id", C, "manhattan", "gower", 3).first()
    assert (got.n_pairs, got.pearson, got.spearman) == (want.n_pairs, pytest.approx(want.pearson, abs=1e-9), pytest.approx(want.spearman, abs=1e-5))


def test_ranks_that_cells_leave_open_are_those_of_the_pairs(spark, monkeypatch):
    """Distances that nearly tie differ by ranks within a cell, which only the pairs tell."""
    x, df = table(spark, 120)
    df = df.withColumn("c", F.col("c") + 1e6)
    want = distance.distance_correlation(allpairs.values(df, "id", C, ("manhattan", "gower")), "manhattan", "gower").first()
    monkeypatch.setattr(allpairs, "FEW_PAIRS", 0)
    got = allpairs.rank_correlation(df, "id", C, "manhattan", "gower").first()
    assert (got.n_pairs, got.spearman) == (want.n_pairs, pytest.approx(want.spearman, abs=1e-9))
