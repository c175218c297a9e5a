"""Tables of figures, strategies by position, binding by position, names and defaults, on small cases."""

import itertools

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortica.functions import stats
from cohortica.operators import audit, clean, numbering, present, rules, summaries
from cohortica.sources import readers


def by_hand(r: str, c: str, b: str, digital: bool) -> dict[str, int]:
    """Which case of each column holds."""
    both, far = r == c == "High", r == "Low" and b == "High"
    return {
        "core_problem": 0 if far else 1 if r == "Moderate" and c == "Low" else 2 if both else 3 if b == "High" else 4,
        "objective": 0 if far else 1 if c == "Low" else 2 if both else 3,
        "approach": 0 if far else 1 if c == "Low" else 2 if both else 3,
        "service": 0 if b == "High" else 1 if c == "Low" else 2 if both else 3,
        "channel": 0 if b == "High" else 1 if c == "Low" else 2 if both else 3 if digital else 4,
    }


def test_strategy_by_position(spark):
    levels = {"High": "rather strong", "Low": "LIMITED", "Moderate": None}
    rows = [(i, levels[r], levels[c], levels[b], t) for i, (r, c, b, t) in enumerate(itertools.product(levels, levels, levels, ("Used digital tool daily (+0.4)", "online: low", None)))]
    segments = spark.createDataFrame(rows, "segment long, readiness string, confidence string, barriers string, traits string")
    got = {x.segment: x for x in rules.strategy_by_position(segments, "traits").collect()}
    for i, (r, c, b, t) in enumerate(itertools.product(levels, levels, levels, (True, False, False))):
        assert {n: got[i][n] for n in rules.BY_POSITION} == {n: rules.BY_POSITION[n][k][1] for n, k in by_hand(r, c, b, t).items()}, (r, c, b, t)
    plain = rules.strategy_by_position(segments.where("segment = 0").drop("traits")).first()
    assert plain.channel == rules.BY_POSITION["channel"][0][1]
    assert rules.strategy_by_position(segments.limit(0), "traits").count() == 0


def test_heat_map_has_every_cell(spark):
    cells = spark.createDataFrame([("x", "p", 1.0), ("y", "q`s.t", 2.0), (None, "p", 3.0), ("z", None, 4.0), ("y", "p", None)], "c string, r string, v double")
    got = {(x.c, x.r): x.v for x in present.heat_map(cells, "c", "r", "v").collect()}
    assert got == {("x", "p"): 1.0, ("x", "q`s.t"): None, ("y", "p"): None, ("y", "q`s.t"): 2.0, (None, "p"): 3.0, (None, "q`s.t"): None, ("z", "p"): None, ("z", "q`s.t"): None}
    assert present.heat_map(cells.limit(0), "c", "r", "v").count() == 0 and present.heat_map(cells.where("c = 'z'"), "c", "r", "v").columns == ["c", "r", "v"]
    plan = present.heat_map(cells, "c", "r", "v")._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_heat_map_refuses_too_many_columns(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        wide = spark.range(4).select(F.lit("x").alias("r"), F.col("id").cast("string").alias("c"), F.lit(1.0).alias("v"))
        assert present.heat_map(wide.where("id < 3"), "r", "c", "v").count() == 3
        with pytest.raises((PySparkException, ValueError)):
            present.heat_map(wide, "r", "c", "v").count()
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_level_order(spark):
    d = spark.createDataFrame([("b", 1.0), ("b", 3.0), ("a", 2.0), ("c", None), ("d", -1.0), (None, 9.0)], "level string, mean double")
    got = present.level_order(d, "level", "mean", "place").orderBy("place").collect()
    assert [(x.level, x.mean_value, x.place) for x in got] == [("d", -1.0, 1), ("a", 2.0, 2), ("b", 2.0, 3), ("c", None, 4)]
    assert present.level_order(d.limit(0), "level", "mean").count() == 0


def test_bar_labels(spark):
    d = spark.createDataFrame([("a", 2, 0.5), ("b", None, 0.9), ("c", 3, 0.5), ("d", 4, None)], "m string, k int, score double")
    got = present.bar_labels(d, ["m", "k"], "score", 3).orderBy(F.desc("bar_order")).collect()
    assert [(x.display_label, x.bar_order) for x in got] == [("b", 3), ("a | 2", 2), ("c | 3", 1)]
    assert present.bar_labels(d, ["m"], "score", 9).orderBy("bar_order").first().m == "d"


def test_bind_columns(spark):
    a, b = spark.range(100).repartition(7), spark.range(100).select((F.lit(200) - F.col("id")).alias("y")).repartition(3)
    assert [(x.id, x.y) for x in numbering.bind_columns(a, b, ["id"], ["y"]).orderBy("id").collect()] == [(i, 101 + i) for i in range(100)]
    with pytest.raises(ValueError, match="100 rows beside 99"):
        numbering.bind_columns(a, b.where("y > 101"), ["id"], ["y"])
    with pytest.raises(ValueError, match="id"):
        numbering.bind_columns(a, a, ["id"], ["id"])
    assert numbering.bind_columns(a.limit(0), b.limit(0), ["id"], ["y"]).count() == 0


def test_optional_logical(spark):
    d = spark.createDataFrame([("Yes",), ("0",), (" ",), (None,)], "given string")
    assert [x.given for x in clean.parse_optional_logical(d, "given", True).collect()] == [True, False, True, True]
    assert [x.absent for x in clean.parse_optional_logical(d, "absent", False).collect()] == [False] * 4
    with pytest.raises(PySparkException, match="not a logical value"):
        clean.parse_optional_logical(spark.createDataFrame([("maybe",)], "given string"), "given").collect()


def test_compare_names(spark):
    declared = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "variable string")
    got = {(x.variable, x.standing) for x in audit.compare_names(declared, ["b", "c"]).collect()}
    assert got == {("a", "only declared"), ("b", "in both"), ("c", "only in data")}
    assert audit.compare_names(declared, []).count() == 2


def test_duration_text(spark):
    d = spark.createDataFrame([(0.0,), (59.94,), (60.0,), (5400.0,), (None,)], "s double")
    assert [x[0] for x in d.select(stats.duration_text(F.col("s"))).collect()] == ["0.0 s", "59.9 s", "1.0 min", "1.5 h", None]


def test_excluded_variables(spark):
    quality = spark.createDataFrame([("a", "Missingness above threshold"), ("b", None), ("c", None)], "variable string, exclusion_reason string")
    removed = spark.createDataFrame([("a", "c"), ("b", "d"), ("b", "c")], "variable string, kept string")
    assert sorted(map(tuple, summaries.excluded_variables(quality, removed).collect())) == [("a", "Missingness above threshold"), ("b", "Correlated with c")]
    assert summaries.excluded_variables(quality.limit(0), removed.limit(0)).count() == 0


def test_relative_path():
    assert present.relative_path("/a/b/c.png", "/a/") == "b/c.png" and present.relative_path("/ab/c", "/a") == "/ab/c" and present.relative_path("a\\b\\c", "a") == "b/c"


def test_list_files(spark, tmp_path):
    for name in ("14_persona_one.png", "14_persona_two.v2.png", "other.txt"):
        (tmp_path / name).write_bytes(b"xyz")
    found = readers.list_files(spark, str(tmp_path), prefix="14_persona_")
    assert sorted((x.key, x.bytes) for x in found.collect()) == [("one", 3), ("two.v2", 3)]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()
    assert readers.list_files(spark, str(tmp_path / "none")).count() == 0
