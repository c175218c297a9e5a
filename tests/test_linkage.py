import numpy as np
import pytest

from cohortica.operators import cluster, linkage

ABC = ["a", "b", "c"]


def frame(spark, x, parts=5):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double").repartition(parts)


def labels_of(d):
    return [r.cluster for r in sorted(d.collect(), key=lambda r: r.id)]


def same_parts(a, b):
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


def matrix(x, distance):
    return cluster.distance_matrix(x, "euclidean") ** 2 if distance == "euclidean_squared" else cluster.distance_matrix(x, distance)


@pytest.mark.parametrize("distance", linkage.DISTANCES)
def test_a_cell_for_each_row_is_plain_average_linkage(spark, distance):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (80, 3)) * [1, 20, 0.01]
    x = np.vstack([x, x[:15], x[:15]])  # equal rows weigh as many
    for k in (2, 5, 11):
        want = cluster.cut(cluster.average_linkage(matrix(x, distance)), len(x), k)
        assert same_parts(labels_of(linkage.average_linkage_rows(frame(spark, x), "id", ABC, k, distance)), want)


def test_mean_distance_of_cells(spark):
    """Squared distances from sums are those of all pairs; so are Manhattan's by coordinates in which cells lie apart."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(0, 2, (200, 3)), 3)
    df = frame(spark, x)
    cells, found = linkage.grow(df, ABC, 24, np.ones(3))
    leaf = cells.leaf(x)
    assert len(found.n) == 24 and found.n.sum() == 200 and sorted(set(leaf)) == sorted(found.leaf)
    d, m = matrix(x, "euclidean_squared"), matrix(x, "manhattan")
    exact, means = linkage.between(found, "euclidean_squared"), linkage.between(found, "manhattan")
    apart = 0
    for i in range(24):
        for j in range(24):
            rows = np.ix_(leaf == found.leaf[i], leaf == found.leaf[j])
            assert exact[i, j] == pytest.approx(d[rows].mean(), abs=1e-8)
            assert means[i, j] <= m[rows].mean() + 1e-9
            if all(found.high[i] < found.low[j]) or all(found.high[j] < found.low[i]):
                assert means[i, j] == pytest.approx(m[rows].mean())
                apart += 1
    assert apart


@pytest.mark.parametrize("distance", linkage.DISTANCES)
def test_more_rows_than_cells(spark, distance):
    """Clusters that lie apart, and a far row alone, are found through few cells, on any number of tasks."""
    rng = np.random.default_rng(6)
    of = rng.integers(0, 4, 1500)
    x = rng.uniform(-1, 1, (1500, 3)) + of[:, None] * np.array([9, -7, 8])
    x, of = np.vstack([x, [[60, -60, 60]]]), [*of, 4]
    got = [labels_of(linkage.average_linkage_rows(frame(spark, x, parts), "id", ABC, 5, distance, most=60)) for parts in (2, 7)]
    assert got[0] == got[1] and same_parts(got[0], of)


def test_odd_tables(spark):
    x = np.ones((30, 3))
    assert labels_of(linkage.average_linkage_rows(frame(spark, x), "id", ABC, 4)) == [1] * 30
    x[7:, 1] = 5
    assert labels_of(linkage.average_linkage_rows(frame(spark, x), "id", ABC, 4, "gower")) == [1] * 7 + [2] * 23
    df = frame(spark, x)
    assert linkage.average_linkage_rows(df.limit(0), "id", ABC, 3).collect() == []
    assert linkage.average_linkage_rows(df, "id", ABC, 3).dtypes == [("id", "int"), ("cluster", "int")]
    with pytest.raises(ValueError, match="unknown distance"):
        linkage.average_linkage_rows(df, "id", ABC, 2, "cosine")
    x[3, 0], x[4, 0] = np.nextafter(1, 2), 1e300  # sides of one step, and far ones
    assert len(set(labels_of(linkage.average_linkage_rows(frame(spark, x), "id", ABC, 4)))) == 4
