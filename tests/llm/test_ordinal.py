import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortica.llm import ordinal

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    test = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = ordinal.train(docs, labels.where(~test))
    assert model.thresholds[0] < model.thresholds[1]
    rated = labels.where(test).withColumn("grade", ordinal.grade(F.col("quality"), F.col("toxic")))
    got = ordinal.classify(docs.join(rated.select("doc_id", "grade"), "doc_id"), model).select("grade", "expected_grade", "quality_kept").collect()
    of = lambda g: [r for r in got if r.grade == g]
    assert np.mean([r.quality_kept for r in of(2)]) > 0.98
    assert np.mean([r.quality_kept for r in of(0)]) < 0.05
    assert np.mean([r.quality_kept for r in of(1)]) < 0.3
    assert np.mean([r.expected_grade for r in of(0)]) < np.mean([r.expected_grade for r in of(1)]) < np.mean([r.expected_grade for r in of(2)])


def plain_loss(x, y, th, w):
    """The documented loss once more, row by row in plain terms: x is a 0/1 matrix."""
    share = np.array([np.mean(y == k) if (y == k).any() else 1 for k in range(3)])
    weight = 1 / np.sqrt(share[y])
    edges = np.array([-np.inf, *th, np.inf])
    below = lambda z: 1 / (1 + np.exp(-z))
    s = x @ w
    return -(weight / weight.sum() * np.log(np.maximum(below(edges[y + 1] - s) - below(edges[y] - s), 1e-12))).sum() + ordinal.L1 * abs(w).sum() + ordinal.RIDGE / 2 * (np.array(th) ** 2).sum()


def least_along(f, low, high):
    for _ in range(40):
        a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
        low, high = (low, b) if f(a) < f(b) else (a, high)
    return (low + high) / 2


@pytest.mark.parametrize("grades", [(0, 1, 2), (0, 2)])
def test_fit_is_at_the_optimum_that_coordinate_search_finds(grades):
    rng = np.random.default_rng(7)
    x = (rng.random((80, 6)) < 0.4).astype(float)
    y = np.array(grades)[np.digitize(x @ np.array([2.0, -1.5, 1, 0.3, 0, 0]) + rng.logistic(size=80), [0, 1.5][: len(grades) - 1])]
    th, used, w = ordinal.fit([np.flatnonzero(r) for r in x], y)
    dense = np.zeros(6)
    dense[used] = w
    got = plain_loss(x, y, th, dense)
    full = np.zeros(1 << ordinal.BITS)
    full[:6] = dense
    assert got == pytest.approx(ordinal.loss([np.flatnonzero(r) for r in x], y, th, full), abs=1e-9)
    at, best = [-0.7, 0.7], np.zeros(6)
    for _ in range(40):
        for j in range(6):
            best[j] = least_along(lambda v, j=j: plain_loss(x, y, at, np.where(np.arange(6) == j, v, best)), -9, 9)
        at[0] = least_along(lambda v: plain_loss(x, y, [v, at[1]], best), -9, at[1])
        at[1] = least_along(lambda v: plain_loss(x, y, [at[0], v], best), at[0], 9)
        both = least_along(lambda v: plain_loss(x, y, [at[0] + v, at[1] + v], best), -3, 3)
        at = [at[0] + both, at[1] + both]
    assert got <= plain_loss(x, y, at, best) + 1e-5 and th[0] < th[1]
    for j in range(2):
        moved = [[*th[:j], th[j] + d, *th[j + 1 :]] for d in (-1e-4, 1e-4)]
        if len(grades) == 3:
            assert abs(plain_loss(x, y, moved[1], dense) - plain_loss(x, y, moved[0], dense)) / 2e-4 < 1e-4


def test_all_of_one_grade_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "some words")] * 30 + [(2, "other words")] * 5, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)] * 4, "doc_id long, quality int, toxic int")
    out = ordinal.classify(docs, ordinal.train(docs, labels)).collect()
    assert len(out) == 35 and all(r.quality_kept for r in out)


def test_odd_rows(spark):
    rows = [(1, "good words here " * 20, 7), (2, None, None), (3, "", 1), (None, "x" * 200_000, 2), (1, "good words here " * 20, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality_kept int")
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 1), (None, 1, 0), (3, None, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")
    out = ordinal.classify(docs, ordinal.train(docs, labels)).collect()
    assert len(out) == 5 and all(r.expected_grade is not None for r in out) and out[0] == out[4]
    unrated = ordinal.classify(docs, ordinal.train(docs, labels.where("false"))).collect()
    assert all(r.quality_kept and r.expected_grade is None for r in unrated)
    assert ordinal.classify(docs.where("false"), ordinal.train(docs, labels)).count() == 0
    assert ordinal.train(docs.where("false"), labels) is None


def test_features_ignore_order_and_repeat():
    assert list(ordinal.features("a b c")) == list(ordinal.features("c b a"))
    assert len(ordinal.features("")) > 0


@pytest.mark.parametrize("quality, toxic, want", [(0, 0, 0), (0, 1, 0), (1, 1, 1), (1, 0, 2), (1, None, 2), (None, 1, None)])
def test_grades(spark, quality, toxic, want):
    row = spark.createDataFrame([(quality, toxic)], "quality int, toxic int")
    assert row.select(ordinal.grade(F.col("quality"), F.col("toxic"))).first()[0] == want


def test_a_long_text_does_not_end_the_sample(spark, monkeypatch):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    first = labels.orderBy(F.xxhash64("doc_id")).first().doc_id
    docs = spark.createDataFrame([(i, "x" * 5000 if i == first else f"text {'good' if i % 2 else 'bad'} " * 5) for i in range(40)], "doc_id long, text string")
    monkeypatch.setattr(ordinal, "SAMPLE_CHARS", 4000)
    assert ordinal.train(docs, labels) is not None
    monkeypatch.setattr(ordinal, "SAMPLE_CHARS", 10)
    with pytest.raises(ValueError, match="none of them is in the sample"):
        ordinal.train(docs, labels)
