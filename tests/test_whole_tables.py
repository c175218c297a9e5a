"""Operators over all rows that make no pairs, no window over all rows and no sample that decides alone."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortica.operators import cluster, distance, numbering, validity


@pytest.mark.parametrize("ranges", [1, 3, 17])
def test_gapless_numbers(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice([None, 1, 2, 2, 3, 40]), i) for i in range(300)]
    got = numbering.number_rows(spark.createDataFrame(rows, "a int, id int").repartition(5), "a", F.col("id").desc(), name="n", ranges=ranges).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert [(r.a, r.id) for r in sorted(got, key=lambda r: r.n)] == want and sorted(r.n for r in got) == list(range(1, 301))
    assert numbering.number_rows(spark.createDataFrame([], "a int"), "a").count() == 0
    same = numbering.number_rows(spark.createDataFrame([(1,)] * 50, "a int"), "a", first=0, ranges=ranges)
    assert sorted(r.row_id for r in same.collect()) == list(range(50))
    with pytest.raises(ValueError, match="in the way"):
        numbering.number_rows(spark.createDataFrame([(1,)], "place int"), "place")


@pytest.mark.parametrize("method", ["manhattan", "gower"])
@pytest.mark.parametrize("ranges", [1, 9])
def test_mean_distances_without_pairs(spark, method, ranges):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, 3, (120, 4)), 1)
    x[:50, 0] = 1.5  # a value that many rows share
    x[:, 3] = 7  # a column without range
    labels = rng.integers(0, 3, 120)
    labels[labels == 2] = 1
    labels[17] = 5  # alone in its cluster
    df = spark.createDataFrame([(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, labels, strict=True))], "id int, a double, b double, c double, d double, cluster int").repartition(6)
    d = cluster.distance_matrix(x, method)
    got = {(r.id, r.other): r.mean_distance for r in validity.mean_distances(df, "id", list("abcd"), method, ranges=ranges).collect()}
    for i in range(120):
        for c in (0, 1, 5):
            others = [j for j in range(120) if labels[j] == c and j != i]
            assert got[i, c] == (pytest.approx(d[i, others].mean(), abs=1e-9) if others else None)
    s = {r.id: r.silhouette for r in validity.silhouette_by_coordinates(df, "id", list("abcd"), method, ranges=ranges).collect()}
    assert s == pytest.approx(dict(enumerate(cluster.mean_silhouette(d, labels))), abs=1e-9)
    alone = validity.silhouette_by_coordinates(df.where("cluster = 0"), "id", list("abcd"), method).collect()
    assert alone and all(r.silhouette == 0 for r in alone)
    assert validity.silhouette_by_coordinates(df.limit(0), "id", ["a"], method).count() == 0
    with pytest.raises(ValueError, match="no sum over coordinates"):
        validity.distance_sums(df, "id", ["a"], "euclidean")


def blobs(rng, n, k=4):
    return np.round(rng.normal(0, 1, (n, 3)) + 6 * rng.integers(0, k, n)[:, None] * np.array([1, 0.5, -1]), 3)


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double").repartition(5)


@pytest.mark.parametrize("method", distance.METHODS)
def test_medoids_of_small_tables(spark, method):
    """No worse than k-medoids of all rows at once, and no swap of any row for a medoid helps."""
    x = blobs(np.random.default_rng(8), 60)
    d = cluster.distance_matrix(x, method)
    got = {r.id: (r.cluster, r.distance) for r in cluster.k_medoids(frame(spark, x), "id", ["a", "b", "c"], 4, method).collect()}
    cost, plain = sum(v[1] for v in got.values()), d[cluster.pam(d, 4)[0]].min(axis=0).sum()
    assert cost <= plain + 1e-9
    medoids = [min((i for i in got if got[i][0] == c), key=lambda i: got[i][1]) for c in (1, 2, 3, 4)]
    assert all(got[m][1] == pytest.approx(0, abs=1e-12) for m in medoids) and cost == pytest.approx(d[medoids].min(axis=0).sum())
    for m in range(4):
        for c in range(60):
            assert d[[*medoids[:m], *medoids[m + 1 :], c]].min(axis=0).sum() >= cost - 1e-6


def test_medoids_beyond_the_samples(spark):
    x = blobs(np.random.default_rng(9), 900, 5)
    d = cluster.distance_matrix(x, "manhattan")
    best = d[cluster.pam(d, 5)[0]].min(axis=0).sum()
    small = cluster.k_medoids(frame(spark, x), "id", ["a", "b", "c"], 5, samples=3, sample=60, candidates=40).collect()
    assert len(small) == 900 and sum(r.distance for r in small) <= 1.03 * best
    with pytest.raises(ValueError, match="unknown distance"):
        cluster.k_medoids(frame(spark, x), "id", ["a"], 2, "cosine")
    assert cluster.k_medoids(frame(spark, x).limit(0), "id", ["a"], 2).count() == 0
    assert {r.cluster for r in cluster.k_medoids(frame(spark, x[:2]), "id", ["a"], 5).collect()} == {1, 2}


@pytest.mark.parametrize(("n", "pairs"), [(20, 500), (60, 600), (400, 1000)])
def test_drawn_pairs(spark, n, pairs):
    """All pairs where there are no more, and otherwise as many different ones as asked for, from the whole range."""
    df = spark.range(n).withColumn("x", F.col("id").cast("double"))
    got = [(r.i, r.j) for r in distance.draw_pairs(df, "id", pairs).collect()]
    assert len(got) == len(set(got)) == min(pairs, n * (n - 1) // 2) and all(0 <= i < j < n for i, j in got)
    assert n < 400 or abs(np.mean([j for _, j in got]) - 2 * n / 3) < 12
    many = distance.sample_pairs(df, "id", ["x"], ("manhattan", "euclidean", "gower"), pairs=pairs).collect()
    assert {(r.id_a, r.id_b) for r in many} == set(got) and all(r.manhattan == r.euclidean == r.id_b - r.id_a == pytest.approx(r.gower * (n - 1)) for r in many)
    assert distance.draw_pairs(df.limit(1), "id").count() == 0


def test_pair_numbers(spark):
    far = 3_000_000_000
    wanted = [(0, 1), (0, 2), (1, 2), (0, far), (far - 1, far), (far - 2, far - 1), (12345, far - 7)]
    df = spark.createDataFrame([(j * (j - 1) // 2 + i,) for i, j in wanted], "p long")
    assert [tuple(r) for r in df.select(*distance._pair_of(F.col("p"))).collect()] == wanted


def test_mixed_gower(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 1.0, 2.0, 5.0]), 3.0, rng.choice([None, "x", "y"]), rng.choice(["u", "v", None])) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, a double, flat double, s string, t string")
    got = {(r.id_a, r.id_b): r.mixed for r in distance.sample_pairs(df, "id", ["a", "flat"], ("mixed",), ["s", "t"]).collect()}
    for x, y in combinations(rows, 2):
        terms = [abs(x[1] - y[1]) / 4] if None not in (x[1], y[1]) else []
        terms += [float(x[c] != y[c]) for c in (3, 4) if None not in (x[c], y[c])]
        assert got[x[0], y[0]] == (pytest.approx(sum(terms) / len(terms)) if terms else None)
    assert len(got) == 780


def test_blocks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(distance, "BLOCK_ROWS", 4)
    df = spark.range(50).withColumn("x", F.col("id") * 1.5)
    pairs = distance.pairwise(df, "id", ["x"], "manhattan")
    assert pairs.rdd.getNumPartitions() == 13**2 and pairs.count() == 50 * 49 // 2


def squares(x, labels):
    return sum(((x[labels == c] - x[labels == c].mean(axis=0)) ** 2).sum() for c in np.unique(labels))


@pytest.mark.parametrize("seed", [1, 2])
def test_no_transfer_improves(spark, seed):
    """Not above Lloyd's sum of squares from the same start, and no row is better off in another cluster."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0, 1, (150, 3)), 3)  # no clear clusters, so Lloyd ends early
    df, k = frame(spark, x), 6
    labels = lambda d: np.array([r.cluster for r in sorted(d.collect(), key=lambda r: r.id)])
    lloyd = labels(cluster.kmeans(df, "id", ["a", "b", "c"], k, starts=1, sample=50))
    got = labels(cluster.hartigan_wong(df, "id", ["a", "b", "c"], k, starts=1, sample=50))
    cost = squares(x, got)
    assert len(got) == 150 and cost <= squares(x, lloyd) + 1e-9
    for i in range(150):
        for c in set(np.unique(got)) - {got[i]}:
            if (got == got[i]).sum() > 1:
                moved = got.copy()
                moved[i] = c
                assert squares(x, moved) >= cost - 1e-6
    assert cluster.hartigan_wong(df, "id", ["a"], 1, starts=1).select("cluster").distinct().count() == 1
