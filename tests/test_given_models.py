"""Several segmentations measured together: one sorting, one pass for the nearest centroids, no join of respondents with themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortica.operators import cluster, numbering, validity
from cohortica.plans import catalog, reports

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sorted_tables(monkeypatch):
    """The tables that are sorted by coordinates."""
    made, plain = [], numbering.in_ranges
    monkeypatch.setattr(numbering, "in_ranges", lambda df, *a, **k: made.append(df.columns) or plain(df, *a, **k))
    return made


def test_models_are_sorted_once(spark, sorted_tables):
    assert catalog._given_models(spark, SF).count() == 4
    assert len(sorted_tables) == 1


def test_distances_are_judged_by_one_sorting(spark, sorted_tables):
    assert reports.best_distance(spark, SF).count() == 4
    assert len(sorted_tables) == 1


def test_candidates_read_respondents_once(spark, sorted_tables, monkeypatch):
    made, plain = [], catalog.respondents
    for module in (catalog, reports):
        monkeypatch.setattr(module, "respondents", lambda *a: made.append(a) or plain(*a))
    assert reports.candidate_profile_summary(spark, SF).count() == 3
    assert len(made) == 1 and len(sorted_tables) == 1


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(0, 2, (90, 3)), 1)
    x[:, 2] = 3  # without range
    p, q = rng.integers(0, 3, 90), rng.integers(0, 2, 90)
    p[11] = 7  # alone in its cluster
    rows = [(i, *map(float, r), f"p{a}", None if i % 9 == 0 else f"q{b}", None) for i, (r, a, b) in enumerate(zip(x, p, q, strict=True))]
    return x, rows, spark.createDataFrame(rows, "id int, a double, b double, c double, p string, q string, none string").repartition(5)


@pytest.mark.parametrize("ranges", [1, 2, 9])
def test_average_silhouettes(labelled, ranges):
    x, rows, df = labelled
    measures = [(list("abc"), "manhattan", "p"), (["b"], "gower", "p"), (["c", "a"], "gower", "q"), (list("ab"), "manhattan", "q"), (["a"], "manhattan", "none")]
    got = {r.measure: r.average_silhouette for r in validity.average_silhouettes(df, "id", measures, ranges).collect()}
    for i, (cols, method, m) in enumerate(measures[:4]):
        known = [r for r in rows if r[{"p": 4, "q": 5}[m]] is not None]
        y = x[:, ["abc".index(c) for c in cols]]
        d = cluster.distance_matrix(y, method)  # Gower's ranges are those of all rows
        at = [r[0] for r in known]
        labels = np.unique([r[{"p": 4, "q": 5}[m]] for r in known], return_inverse=True)[1]
        assert got[i] == pytest.approx(np.mean(cluster.mean_silhouette(d[np.ix_(at, at)], labels)), abs=1e-9)
    assert got[4] is None


def test_nearest_of_models(labelled):
    x, rows, df = labelled
    long = df.select(F.explode(F.array(*[F.struct(F.lit(m).alias("model_id"), F.col(m).alias("cluster")) for m in ("p", "q", "none")])).alias("v"), *"abc").select("v.*", *"abc")
    by = validity.moments(long, list("abc"), "model_id", "cluster")
    got = {(r.model_id, r.cluster, r.near): (r.n, r.away) for r in validity.nearest_of_models(df, by, list("abc"), ["p", "q", "none"]).collect()}
    want = {}
    for m, at in (("p", 4), ("q", 5)):
        known = [(x[r[0]], r[at]) for r in rows if r[at] is not None]
        centres = {c: np.mean([v for v, k in known if k == c], axis=0) for c in sorted({k for _, k in known})}
        for v, k in known:
            d = {c: float(np.linalg.norm(v - z)) for c, z in centres.items()}
            n, away = want.get((m, k, near := min(d, key=d.get)), (0, 0.0))
            want[m, k, near] = (n + 1, away + d[k])
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert {k: v[1] for k, v in got.items()} == pytest.approx({k: v[1] for k, v in want.items()})


def test_ties_go_to_the_least_cluster(spark):
    df = spark.createDataFrame([(-1.0, "b"), (1.0, "a"), (0.0, None)], "a double, m string").withColumn("m", F.coalesce("m", F.lit("c")))
    by = spark.createDataFrame([("m", "b", 1, -1.0), ("m", "a", 1, 1.0), ("m", "c", 1, 9.0)], "model_id string, cluster string, n long, s_a double")
    assert {(r.cluster, r.near) for r in validity.nearest_of_models(df, by, ["a"], ["m"]).collect()} == {("b", "b"), ("a", "a"), ("c", "a")}


def test_as_by_one_model(labelled):
    """Moments and tables by model say what the operators on one model's rows say."""
    _, _, df = labelled
    by = validity.moments(df.withColumn("model_id", F.lit("p")), list("ab"), "model_id", "p")
    one, two = validity.variance_separation(df, list("ab"), "p").first(), validity.separation_of(by, list("ab"), "model_id").drop("model_id").first()
    assert tuple(one) == pytest.approx(tuple(two)) and validity.cluster_sizes(df, "p").first()["balance"] == validity.sizes_of(by, "model_id").first()["balance"]


def test_agreement_of_columns(labelled):
    _, _, df = labelled
    long = df.select("id", F.explode(F.array(*[F.struct(F.lit(m).alias("model_id"), F.col(m).alias("cluster")) for m in "pq"])).alias("v")).select("id", "v.*")
    told = lambda d: {(r.model_1, r.model_2): (r.n_compared, round(r.adjusted_rand_index, 12)) for r in d.collect()}
    assert told(validity.adjusted_rand_of_columns(df, ["p", "q"])) == told(validity.pairwise_adjusted_rand(long))
