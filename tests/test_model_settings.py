from cohortica import config
from cohortica.operators import cluster
from cohortica.plans import catalog

SF = "/root/testdata/sf0.01"
S = config.SETTINGS


def test_models_run_with_the_settings(spark, monkeypatch):
    """1,500 respondents are fewer than the sample's bound, so all take part, and every unit of the settings is asked for."""
    n, asked = spark.read.parquet(f"{SF}/customer.parquet").count(), []
    assert 400 < n <= S.sample_rows
    sampled = cluster._sampled

    def seen(*a):
        asked.append(("rows", len(sampled(*a)[0])))
        return sampled(*a)

    def units(spark, of, names, run, schema, finished=None):
        asked.append((names.split(", ")[-1], of))
        return spark.createDataFrame([("model", [1] * n, 1.0, 1.0)] if "labels" in schema else [], schema)

    monkeypatch.setattr(cluster, "_sampled", seen)
    monkeypatch.setattr(cluster, "run_units", units)
    catalog.queries()["bootstrap_stability"](spark, SF)
    assert asked == [("rows", n), ("k int", [("model", "all", "pam", "manhattan", 3)]), ("round int", [("model", "all", "pam", "manhattan", 3, b) for b in range(S.bootstrap_rounds)])]
    asked.clear()
    catalog.queries()["gap_statistic"](spark, SF)
    assert asked == [("rows", n), ("round int", [("all", k, b) for k in S.k_values for b in range(-1, S.gap_rounds)])]
    asked.clear()
    catalog.queries()["model_grid"](spark, SF)
    assert asked[0] == ("rows", n)
    assert {k for *_, of in asked[1][1] for k in of} == set(S.k_values) and {u[2] for u in asked[1][1]} == {"pam", "hierarchical", "kmeans"}
