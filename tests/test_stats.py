import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortica.functions import stats
from cohortica.operators import audit, clean, cluster, distance, features, profile, rules, validity


def values(spark, xs, name="x"):
    return spark.createDataFrame([(x,) for x in xs], f"{name} double")


def test_summary_and_moments(spark):
    d = values(spark, [1.0, 2.0, 2.0, 3.0, 10.0, None])
    s = audit.numeric_summary(d, ["x"]).first()
    assert (s.first_quartile, s.median, s.third_quartile) == (2.0, 2.0, 3.0) and s.standard_deviation == pytest.approx(3.6469165)
    m = audit.distribution(d, ["x"]).first()
    assert m.skewness == pytest.approx(0.9737756, abs=1e-6) and m.kurtosis == pytest.approx(-1.0364566, abs=1e-6)


@pytest.mark.parametrize("xs, want", [(["a", "a", "b", "b"], 1.0), (["a", "a"], 0.0), ([None], None)])
def test_entropy(spark, xs, want):
    d = spark.createDataFrame([(x,) for x in xs], "x string")
    got = audit.entropy(d, ["x"]).collect()
    assert (got[0].entropy if got else None) == want


@pytest.mark.parametrize("xs, want", [([5.0, 5.0, 5.0], [1.0] * 3), ([None, None], [0.0, 0.0]), ([1.0, None, 3.0], [0.0, None, 1.0])])
def test_normalise(spark, xs, want):
    got = values(spark, xs).select(stats.normalise(F.col("x"), Window.partitionBy()).alias("n")).collect()
    expected = want if xs != [1.0, None, 3.0] else want
    assert sorted((r.n for r in got), key=str) == sorted(expected, key=str)


def test_middle_rank_and_bh(spark):
    d = values(spark, [1.0, 2.0, 2.0, 3.0, 10.0])
    got = d.select("x", stats.middle_rank(Window.orderBy("x"), Window.partitionBy("x")).alias("r")).orderBy("x").collect()
    assert [r.r for r in got] == [1.0, 2.5, 2.5, 4.0, 5.0]
    p = values(spark, [0.01, 0.04, 0.03, 0.005], "p").select("p", stats.benjamini_hochberg("p").alias("q")).collect()
    assert {r.p: round(r.q, 10) for r in p} == {0.01: 0.02, 0.04: 0.04, 0.03: 0.04, 0.005: 0.02}


def test_tails():
    assert stats.f_tail(4.0, 2, 20) == pytest.approx((1 + 2 * 4.0 / 20) ** -10)  # closed form for two degrees
    assert stats.f_tail(3.0984, 3, 20) == pytest.approx(0.05, abs=1e-4)
    assert stats.chi_square_tail(7.815, 3) == pytest.approx(0.05, abs=1e-4)
    assert stats.chi_square_tail(300.0, 5) < 1e-50 and stats.chi_square_tail(0.0, 5) == 1.0
    assert stats.chi_square_tail(2.0, 2) == pytest.approx(math.exp(-1))


@pytest.mark.parametrize("text, want", [("1-5", (1.0, 5.0)), (" -2 - 2 ", (-2.0, 2.0)), ("0.5-1.5", (0.5, 1.5)), ("agree", (None, None)), (None, (None, None))])
def test_scales(spark, text, want):
    low, high = clean.scale_bounds(F.col("s"))
    assert tuple(spark.createDataFrame([(text,)], "s string").select(low, high).first()) == want


def test_cleaning(spark):
    assert clean.clean_names(["Respondent ID", "monthlySpend", "x.y", "X y", "1st"]) == ["respondent_id", "monthly_spend", "x_y", "x_y_2", "x1st"]
    d = spark.createDataFrame([("  a  b ", "YES", "3.5"), ("N/A", "not selected", "abc"), ("", "maybe", None)], "t string, b string, n string")
    got = d.select(clean.missing_tokens(F.col("t")), clean.convert_binary(F.col("b")), clean.convert_numeric(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("a b", 1, 3.5), (None, 0, None), (None, None, None)]
    assert clean.drop_empty(spark.createDataFrame([(1, None), (None, None)], "a int, b int")).collect()[0].asDict() == {"a": 1}
    with pytest.raises(Exception, match="not a logical value"):
        d.select(clean.parse_logical(F.col("b"))).collect()


def test_metadata_errors_and_keys(spark):
    rows = [("a", "x", "segmentation", "g", "numeric", None, None, None, None, None), ("a", "x", "odd", "g", "shape", None, None, None, None, None)]
    m = spark.createDataFrame(rows, "variable string, label string, role string, group string, data_type string, scale string, include_segmentation string, include_profiling string, allow_missing string, description string")
    found = audit.validate_metadata(m, ["a", "b"])
    assert len(found) == 4 and "not declared: b" in found
    with pytest.raises(ValueError, match="1 null and 1 repeated"):
        audit.check_key(spark.createDataFrame([(1,), (1,), (None,)], "k int"), "k")


def test_silhouette_matches_matrix(spark):
    rng = random.Random(2)
    rows = [(i, float(rng.gauss(3 * (i % 3), 1)), float(rng.random()), i % 3 if i else 9) for i in range(40)]
    d = spark.createDataFrame(rows, "id long, a double, b double, cluster long")
    got = {r.id: r.silhouette for r in validity.silhouette(distance.pairwise(d, "id", ["a", "b"]), d).collect()}
    x = np.array([[r[1], r[2]] for r in rows])
    want = cluster.mean_silhouette(cluster.distance_matrix(x, "euclidean"), np.array([r[3] for r in rows]))
    assert got[0] == 0.0 and [got[i] for i in range(40)] == pytest.approx(list(want))


@pytest.mark.parametrize("method", distance.METHODS)
def test_pairwise_matches_matrix(spark, method):
    rng = np.random.default_rng(0)
    x = np.round(rng.random((25, 3)) * 9)
    x[:, 2] = 4
    d = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    got = {(r.id_a, r.id_b): r.d for r in distance.pairwise(d, "id", ["a", "b", "c"], method).collect()}
    m = cluster.distance_matrix(x, method)
    assert len(got) == 300 and all(got[i, j] == pytest.approx(m[i, j]) for i in range(25) for j in range(i + 1, 25))


def test_ari(spark):
    d = spark.createDataFrame([(i, i % 3, "abc"[i % 3], i % 2) for i in range(30)], "id int, a int, b string, c int")
    assert validity.adjusted_rand(d, "a", "b").first().adjusted_rand_index == 1.0
    assert abs(validity.adjusted_rand(d, "a", "c").first().adjusted_rand_index) < 0.1


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 4))
def test_clusterings_recover_blobs(seed, k):
    rng = np.random.default_rng(seed)
    truth = np.repeat(np.arange(k), 12)
    x = rng.normal(0, 0.4, (len(truth), 2)) + 8 * np.stack([truth, truth**2], axis=1)
    d = cluster.distance_matrix(x, "euclidean")
    for labels in (cluster.pam(d, k)[1], cluster.cut(cluster.average_linkage(d), len(x), k)):
        assert len({(a, b) for a, b in zip(truth, labels, strict=True)}) == k
        assert cluster.mean_silhouette(d, labels).mean() > 0.6


def test_bootstrap_and_gap(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 0.3, (30, 2)) for m in (0, 6, 12)])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double")
    rows = cluster.bootstrap_stability(df, "id", ["a", "b"], "pam", "manhattan", 3, rounds=10).collect()
    assert len(rows) == 3 and all(r.mean_jaccard > 0.95 and r.minimum_jaccard <= r.median_jaccard for r in rows)
    gaps = {r.k: r.gap for r in cluster.gap_statistic(df, "id", ["a", "b"], (1, 3), rounds=8).collect()}
    assert gaps[3] > gaps[1]


def test_redundancy_and_sets():
    q = {"a": {"pct_missing": 0, "entropy": 0.9, "standard_deviation": 1}, "b": {"pct_missing": 5, "entropy": 0.9, "standard_deviation": 1}, "c": {"pct_missing": 0, "entropy": 0.1, "standard_deviation": 1}}
    g = {"a": "x", "b": "x", "c": "y"}
    assert features.remove_redundant(q, g, [("a", "b", 0.9)]) == [("b", "a")]
    assert features.remove_redundant(q, g, [("a", "c", 0.9)]) == [("a", "c")]  # c is the last of its group
    assert features.restore_groups({"a"}, q, g) == {"a", "c"}
    scores = [{"variable": v, "group": h, "combined_score": s, "force_keep": v == "z", "force_exclude": v == "w"} for v, h, s in (("p", "1", 0.9), ("q", "1", 0.8), ("r", "2", 0.1), ("z", "1", 0.0), ("w", "2", 1.0))]
    assert features.build_feature_set(3, scores) == ["p", "r", "z"]


def test_stability_by_how_far_ranks_move():
    ref = np.array([3.0, 2.0, 1.0])
    assert list(features.stability(ref, np.array([ref, ref]))) == [0.0, 0.0, 0.0]  # all ranks move equally far, none: scaled to 1
    assert list(features.stability(ref, np.array([[3.0, 1.0, 2.0]]))) == [1.0, 0.0, 0.0]


def test_matching_is_greedy_by_reference():
    assert validity.match_clusters([(1, "x", 0.5), (1, "y", 0.2), (2, "x", 0.9)]) == {1: ("x", 0.5), 2: (None, 0.0)}


def test_difference_tests(spark):
    rng = random.Random(1)
    rows = [(s, rng.gauss(s, 0.5), rng.random(), "ab"[s % 2], rng.choice("xyz")) for s in (0, 1, 2) for _ in range(40)]
    d = spark.createDataFrame(rows, "segment int, strong double, noise double, tied string, loose string")
    t = {r.variable: r for r in profile.difference_tests(d, ["strong", "noise"], ["tied", "loose"]).collect()}
    assert t["strong"].significant and t["tied"].significant and not t["noise"].significant and t["tied"].effect_size == pytest.approx(1.0)


def test_priority(spark):
    one = spark.range(1).select(rules.priority_score(F.lit("very high"), F.lit("limited"), F.lit("strong"), F.lit(31.0)).alias("s"))
    assert one.first().s == 10


def test_advice_meets_each_rule(spark):
    positions = [("s1", "a", "High", "High", "Low", "High"), ("s2", "b", "Low", "Moderate", "High", "Moderate"), ("s3", "c", "Moderate", "Low", "High", "Low"), ("s4", "d", "Moderate", "Moderate", "Moderate", "Low"), ("s5", "d", "Moderate", "High", "Moderate", "High"), ("s6", "e", "High", "Low", "Low", "Moderate")]
    p = spark.createDataFrame(positions, "segment string, working_name string, readiness string, confidence string, barriers string, trust string")
    got = {r.segment: r for r in rules.interventions(p).collect()}
    assert [got[f"s{i}"].call_to_action for i in range(1, 7)] == ["Begin today", "See an easier way", "Try one step with help", "Find out more", "Find out more", "Begin today"]
    assert [got[f"s{i}"].support_intensity for i in range(1, 7)] == ["Low to moderate", "Moderate", "High", "Moderate", "Moderate", "Low to moderate"]
    assert [got[f"s{i}"].tone for i in range(1, 7)] == ["Decisive", "Even and informative", "Open, with evidence", "Open, with evidence", "Even and informative", "Encouraging, without blame"]
    assert [got[f"s{i}"].avoid for i in range(1, 7)] == ["The same words for everyone", "Pressing for action", "Hints at failing", "Claims without proof", "The same words for everyone", "Hints at failing"]
    said = [r.message for r in rules.message_hierarchy(p).orderBy("segment", "message_rank").collect()]
    assert len(said) == 18 and said[:3] == ["You are set to begin", "You know how to do this", "It fits in with what you do already"] and said[3] == "There is no hurry"


def test_sizes_are_named_only_where_names_are_known(spark):
    from cohortica.operators import summaries

    sizes = spark.createDataFrame([("a", 3), ("b", 4)], "segment string, n int")
    names = spark.createDataFrame([("a", "first"), ("a", "first"), ("c", "third")], "segment string, working_name string")
    assert sorted(map(tuple, summaries.named_sizes(sizes, names).collect())) == [("a", 3, "first"), ("b", 4, None)]
    named = sizes.withColumn("working_name", F.lit("own"))
    assert summaries.named_sizes(named, names) is named and summaries.named_sizes(sizes, None) is sizes and summaries.named_sizes(sizes, names.limit(0)) is sizes
    final = spark.createDataFrame([("m", 3, 0.5, True), ("n", 4, 0.1, False)], "model_id string, k int, balance double, selected boolean")
    assert [tuple(r) for r in summaries.final_model_summary(final).collect()] == [("Final model ID", "m"), ("Number of segments", "3"), ("Balance score", "0.500000")]
