import numpy as np
from pyspark.sql import functions as F

from cohortica import config
from cohortica.operators import cluster, features, units
from cohortica.plans import catalog

SF = "/root/testdata/sf0.001"


def test_units_are_spread_and_skipped(spark):
    def run(name, i):
        yield name, i, int(units.hashed(3, i)[0] % 1000)

    made = units.run_units(spark, [("a", i) for i in range(24)], "name string, i int", run, "name string, i int, value int")
    rows = made.withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in rows}) == 24 and len(rows) == 24  # a task for each, also where adaptive execution may merge
    finished = made.where("i < 20").select("name", "i")
    again = units.run_units(spark, [("a", i) for i in range(24)], "name string, i int", run, "name string, i int, value int", finished).collect()
    assert sorted(map(tuple, again)) == sorted((r.name, r.i, r.value) for r in rows if r.i >= 20)
    assert units.run_units(spark, [], "name string, i int", run, "name string, i int, value int").count() == 0


def test_hashes_draw_evenly():
    u = units.uniform(5, np.arange(40_000))
    assert abs(u.mean() - 0.5) < 0.01 and abs(u.std() - 12**-0.5) < 0.01 and len(set(u.tolist())) == len(u)
    assert abs(np.corrcoef(u[:-1], u[1:])[0, 1]) < 0.02 and (units.uniform(6, np.arange(9)) != u[:9]).all()
    at = units.resample(1, 50, 20_000, 7)
    assert at.min() == 0 and at.max() == 49 and (np.bincount(at) > 300).all()
    assert (units.resample(1, 50, 100, 7) == at[:100]).all() and (units.resample(1, 50, 100, 8) != at[:100]).any()


def test_models_and_resamples_are_tasks(spark):
    df = catalog.filled(spark, SF)
    grid = cluster.model_grid(df, "respondent_id", {"all": catalog.NUMERIC}, ks=(2, 3), starts=5)
    assert grid.withColumn("task", F.spark_partition_id()).select("task").distinct().count() == 2 * 2 + 2 + 2  # pam and k-means by k, one tree for each distance
    s = config.Settings(bootstrap_rounds=4, gap_rounds=3, kmeans_starts=5)
    models = grid.where("k = 3").drop("assignment")
    one = cluster.validate_models(df, "respondent_id", {"all": catalog.NUMERIC}, models, s)
    rows = sorted(map(tuple, one.collect()))
    assert len(rows) == 3 * 5 and len({r[0] for r in rows}) == 5
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(tuple, cluster.validate_models(df.repartition(3), "respondent_id", {"all": catalog.NUMERIC}, models, s).collect())) == rows
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_resumed_resamples_are_the_same(spark):
    df, sets, chosen = catalog.filled(spark, SF), {"all": catalog.NUMERIC}, [("m", "all", "pam", "manhattan", 2)]
    sent = spark.sparkContext.broadcast(cluster._sampled(df, "respondent_id", sets, 100, 1))
    labels = {"m": np.array(cluster.fit_models(spark, chosen, sets, sent).first()["labels"])}
    whole = cluster.resampled(spark, chosen, sets, sent, labels, 6)
    part = spark.createDataFrame(whole.where("round < 4").collect(), whole.schema)
    resumed = cluster.resampled(spark, chosen, sets, sent, labels, 6, finished=part)
    assert sorted(map(tuple, resumed.collect())) == sorted(map(tuple, whole.collect()))


def test_bootstrap_importance_does_not_depend_on_partitions(spark):
    z = catalog.scaled(spark, SF)
    a = features.bootstrap_importance(z, "respondent_id", catalog.NUMERIC, rounds=5)
    b = features.bootstrap_importance(z.repartition(7), "respondent_id", catalog.NUMERIC, rounds=5)
    assert a.shape == (5, len(catalog.NUMERIC)) and np.allclose(a, b, rtol=1e-9) and not np.allclose(a[0], a[1])
