import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from cohortica import config
from cohortica.operators import cluster, distance
from cohortica.plans import catalog

SF = "/root/testdata/sf0.001"


def vectors():
    t = ds.dataset(f"{SF}/embeddings.parquet").to_table().sort_by("vec_id")
    return t["vec_id"].to_pylist(), np.array(t["label"].to_pylist()), np.array(t["embedding"].to_pylist(), float)


def test_whole_vectors(spark):
    ids, labels, x = vectors()
    assert x.shape[1] > 8
    upper, q = np.triu_indices(len(x), 1), catalog.queries()
    d = {m: cluster.distance_matrix(x, m) for m in distance.METHODS}
    for m in distance.METHODS:
        r, of = q[f"distance_distribution_{m}"](spark, SF).first(), d[m][upper]
        assert r.n_pairs == len(of)
        assert (r.minimum, r.mean, r.maximum, r.median, r.standard_deviation) == pytest.approx((of.min(), of.mean(), of.max(), np.median(of), of.std(ddof=1)), abs=2e-5)
    r = q["distance_correlation"](spark, SF).first()
    assert (r.n_pairs, r.pearson) == (len(upper[0]), pytest.approx(np.corrcoef(d["manhattan"][upper], d["gower"][upper])[0, 1], abs=2e-5))
    assert all(q[f"whole_{n}"] is q[n] and catalog.oracle_sql()[f"whole_{n}"] == catalog.oracle_sql()[n] for n in ("silhouette", "distance_correlation", "distance_distribution_gower"))
    got = {r.id: r.silhouette for r in q["silhouette"](spark, SF).collect()}
    assert got == pytest.approx(dict(zip(ids, cluster.mean_silhouette(d["euclidean"], labels), strict=True)), abs=2e-5)


def test_more_vectors_than_a_sample(spark, tmp_path):
    n = config.SETTINGS.sample_rows + 1
    made = spark.range(n).select(F.col("id").alias("vec_id"), (F.col("id") % 3).cast("int").alias("label"), F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.rand(1) + i).alias("embedding"))
    made.write.parquet(str(tmp_path / "embeddings.parquet"))
    q = catalog.queries()
    assert q["silhouette"](spark, str(tmp_path)).count() == n
    for m in distance.METHODS:
        assert q[f"distance_distribution_{m}"](spark, str(tmp_path)).select("n_pairs").first().n_pairs == n * (n - 1) // 2


def test_quartiles_and_ranks_by_bins(spark):
    rng = np.random.default_rng(3)
    of = {"far": np.append(rng.random(400), 1e9), "ties": rng.integers(0, 5, 301).astype(float), "one": np.array([2.5]), "same": np.full(7, 3.0), None: rng.random(10)}
    pairs = spark.createDataFrame([(k, float(x)) for k, v in of.items() for x in v], "k string, d double")
    got = {r.k: r for r in distance.distance_distribution(pairs, "k").collect()}
    assert set(got) == set(of)
    for k, v in of.items():
        r = got[k]
        assert (r.n_pairs, r.minimum, r.first_quartile, r.median, r.third_quartile, r.maximum) == (len(v), v.min(), *(pytest.approx(np.quantile(v, p), rel=1e-12) for p in (0.25, 0.5, 0.75)), v.max())
        assert (r.mean, r.standard_deviation) == ((pytest.approx(v.mean()), pytest.approx(v.std(ddof=1), rel=1e-9, abs=1e-12)) if len(v) > 1 else (2.5, None))
    for v in of.values():
        ranks = {r.d: r.rank for r in distance.middle_ranks(spark.createDataFrame([(float(x),) for x in v], "d double")).collect()}
        assert ranks == {x: (v < x).sum() + ((v == x).sum() + 1) / 2 for x in v}
    assert distance.distance_distribution(pairs.where("false"), "k").count() == 0
    none = distance.distance_distribution(pairs.where("false")).first()
    assert none.n_pairs == 0 and none.median is None
    assert distance.middle_ranks(pairs.where("false").select("d")).count() == 0
