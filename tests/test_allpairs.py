import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortica.operators import allpairs, cluster, distance, validity
from cohortica.plans import catalog, reports

C = list("abc")


def table(spark, n=300, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(5, 2, (n, 3)), 1)
    x[n // 2 :] = x[: n - n // 2]  # copies, and ties among distances
    x[:, 2] += 1e6
    labels = rng.integers(0, 4, n).tolist()
    labels[0], labels[1] = 9, None
    return x, labels, spark.createDataFrame([(i, label, *map(float, r)) for i, (label, r) in enumerate(zip(labels, x, strict=True))], "id long, cluster int, a double, b double, c double")


@pytest.mark.parametrize("method", distance.METHODS)
@pytest.mark.parametrize("most", [10**6, 10])
def test_distribution_as_of_a_table_of_pairs(spark, method, most, monkeypatch):
    """Quartiles are exact, also where the bins that they fall into are counted in finer ones first."""
    monkeypatch.setattr(allpairs, "MOST_VALUES", most)
    x, _, df = table(spark)
    got, want = allpairs.distribution(df, "id", C, method).first(), distance.distance_distribution(distance.pairwise(df, "id", C, method)).first()
    assert got.n_pairs == 300 * 299 // 2 and got.asDict() == pytest.approx(want.asDict(), abs=1e-7)
    assert allpairs.distribution(df.limit(1), "id", C, method).first().asDict() == distance.distance_distribution(distance.pairwise(df.limit(1), "id", C, method)).first().asDict()


def test_correlations_as_of_a_table_of_pairs(spark):
    x, _, df = table(spark)
    pairs = distance.pairwise_many(df, "id", C, distance.METHODS)
    got, want = distance.distance_correlation(allpairs.values(df, "id", C, ("manhattan", "gower")), "manhattan", "gower").first(), distance.distance_correlation(pairs, "manhattan", "gower").first()
    assert got.n_pairs == want.n_pairs and (got.pearson, got.spearman) == pytest.approx((want.pearson, want.spearman), abs=1e-9)
    of = lambda d: {(r.method_1, r.method_2, r.n_pairs): r.pearson for r in d.collect()}
    assert of(allpairs.correlations(df, "id", C, distance.METHODS)) == pytest.approx(of(distance.all_correlations(pairs, distance.METHODS)), abs=1e-9)


@pytest.mark.parametrize("method", ["euclidean", "gower"])
def test_silhouette_as_of_a_table_of_pairs(spark, method):
    x, labels, df = table(spark)
    of = lambda d: {r.id: (r.cluster, r.silhouette) for r in d.collect()}
    got, want = of(allpairs.silhouette(df, "id", C, "cluster", method)), of(validity.silhouette(distance.pairwise(df, "id", C, method), df))
    assert {i: c for i, (c, _) in got.items()} == dict(enumerate(labels)) and got[0][1] == got[1][1] == 0.0
    assert {i: s for i, (_, s) in got.items()} == pytest.approx({i: s for i, (_, s) in want.items()}, abs=1e-7)


def test_short_vectors_and_missing_keys(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 3.0, None), (3, 3.0, 5.0), (None, 9.0, 9.0)], "id int, a double, b double")
    for method, values in (("manhattan", [3.0, 7.0, 0.0]), ("euclidean", [3.0, 5.0, 0.0])):
        r = allpairs.distribution(df, "id", ["a", "b"], method).first()
        assert (r.n_pairs, r.minimum, r.maximum, r.median) == (3, min(values), max(values), float(np.median(values)))
    with pytest.raises(ValueError, match="unknown distance"):
        allpairs.spreads(df, "id", [("cosine", ["a"])])


def test_no_table_of_pairs(spark):
    """No query of whole vectors or of all respondents makes rows of pairs: fifty times the rows would be 2,500 times the shuffle."""
    for f in (catalog._register_distances, catalog.distance_correlation, catalog.silhouette, reports.distance_pearson, reports.distance_method_summary):
        assert "pairwise" not in inspect.getsource(f)
