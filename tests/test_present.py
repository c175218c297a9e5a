import numpy as np
import pytest

from cohortica.operators import features, present
from cohortica.streaming import behaviour

SF = "/root/testdata/sf0.001"


def test_presentation(spark):
    d = spark.createDataFrame([("a", 0.25, 0.9, 25.04)], "name string, share double, score double, share_pct double")
    assert tuple(present.percent_columns(d).first()) == ("a", 25.0, 0.9, 25.0)
    assert present.display_names(d).columns == ["Name", "Share", "Score", "Share Pct"]
    assert present.first_column(d, ["n", "share"]) == "share" and present.first_column(d, ["n"]) is None
    assert present.any_of(d, ["score", "x", "name"]).columns == ["score", "name"]
    assert present.unique_file_names(["A b!", "a-b", "?"]) == ["a_b", "a_b_2", "unnamed"]
    cells = spark.createDataFrame([("x", "p", 1.0), ("y", "q", 2.0)], "r string, c string, v double")
    assert sorted((x.r, x.c, x.v) for x in present.heat_map(cells, "r", "c", "v").collect() if x.v) == [("x", "p", 1.0), ("y", "q", 2.0)]


def test_scores_are_uncorrelated(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 3))
    d = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    s = features.pca_scores(d, "id", ["a", "b", "c"], 2).toPandas()
    assert abs(np.corrcoef(s["pc_1"], s["pc_2"])[0, 1]) < 1e-6
    variance = features.pca_variance(d, ["a", "b", "c"]).collect()
    assert s["pc_1"].var(ddof=1) == pytest.approx(variance[0].variance) and variance[2].cumulative == pytest.approx(1.0)


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = behaviour.behaviour_windows(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    q = stream.select("window", "user_id", "n_events").writeStream.format("memory").queryName("behaviour").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = behaviour.behaviour_windows(events)
    assert spark.table("behaviour").count() == batch.count()
    assert spark.table("behaviour").groupBy().sum("n_events").first()[0] == events.count()
