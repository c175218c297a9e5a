import numpy as np
import pytest

from cohortica.operators import allpairs, spreads
from cohortica.plans import catalog

C = list("abc")
MEASURES = [("manhattan", C), ("gower", C), ("manhattan", ["a", "c"]), ("gower", ["b"])]


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")


@pytest.mark.parametrize("kind", ["apart", "ties", "constant"])
def test_spreads_as_of_all_pairs(spark, kind, monkeypatch):
    """Over several ranges, with copies, values that fill more than one range, and a column of one value."""
    monkeypatch.setattr(spreads, "RANGE_ROWS", 60)
    monkeypatch.setattr(spreads, "NEAR_ROWS", 20)
    x = np.random.default_rng(7).normal(3, 2, (330, 3)) * [1, 30, 0.1]
    if kind != "apart":
        x[:200, 0], x[100:, 1], x[:50] = 2.5, np.round(x[100:, 1] / 20), x[50:100]
    if kind == "constant":
        x[:, 2] = 4.0
    df = frame(spark, x)
    want = allpairs.spreads(df, "id", MEASURES)
    monkeypatch.setattr(allpairs, "over_blocks", None)
    for got, w in zip(spreads.spreads(df, "id", MEASURES), want, strict=True):
        assert got == pytest.approx(w, abs=1e-9)


def test_grown_counts_each_pair_once():
    rng = np.random.default_rng(3)
    u, y = rng.integers(0, 20, 90), rng.integers(0, 9, 90).astype(float)
    x = u + rng.random(90) * 0
    want = sum((x[j] - x[i]) * (y[j] - y[i]) for i in range(90) for j in range(90) if u[i] < u[j] and y[i] < y[j])
    assert spreads.grown(u, x, y) == pytest.approx(want)


def test_distance_method_summary_makes_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(allpairs, "over_blocks", None)
    assert catalog.queries()["distance_method_summary"](spark, "/root/testdata/sf0.001").count() == 2
