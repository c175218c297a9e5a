import pytest

from cohortica.operators import rules
from cohortica.plans.runner import Options, Stage, read_log, run_stages, write_log


def texts(spark, path):
    return [r.line.partition(" | ")[2] for r in read_log(spark, path).collect()]


def test_lines_in_order(spark, tmp_path, capsys):
    path = str(tmp_path / "log")
    assert texts(spark, path) == []
    lines = [write_log(spark, path, "line ", i, " | ü\n2", echo=i == 1) for i in range(3)]
    assert [r.line for r in read_log(spark, path).collect()] == lines and capsys.readouterr().out == lines[1] + "\n"
    write_log(spark, path, "anew", echo=False, overwrite=True)
    assert texts(spark, path) == ["anew"]


def test_log_of_a_run(spark, tmp_path):
    import warnings

    def noisy(s, t):
        warnings.warn("look here", stacklevel=1)
        return {"a": s.range(1)}

    stages = [Stage(1, "first", noisy, ("a",)), Stage(2, "bad", lambda s, t: 1 / 0)]
    with pytest.raises(RuntimeError, match="bad"):
        run_stages(spark, stages, str(tmp_path))
    got = texts(spark, str(tmp_path / "run_log"))
    assert got[:2] == ["2 stages from 1 to 2", "stage 1 (first) begins"] and "stage 1 (first) warns: look here" in got and got[-1] == "the run failed"
    assert any(x.startswith("stage 2 (bad) FAILED after") and "division by zero" in x for x in got)
    run_stages(spark, stages[:1], str(tmp_path), Options(overwrite_log=False))
    assert texts(spark, str(tmp_path / "run_log"))[: len(got)] == got and texts(spark, str(tmp_path / "run_log"))[-1] == "the run has ended"


def test_sequence_and_rank(spark):
    rows = [("a", "High", "high", "strong", "High", 10.0), ("b", "Very high", "Low", "Low", "high barriers", 5.0), ("c", None, None, "weak", None, 50.0), ("d", "High", None, None, None, 10.0), ("e", "Medium", "High", "Moderate", None, None)]
    df = spark.createDataFrame(rows, "segment string, priority string, readiness string, confidence string, barriers string, share_pct double")
    got = {r.segment: (r.overall_rank, r.priority_level, [t for _, t in rules.SEQUENCE].index(r.recommended_sequence)) for r in rules.implementation_priorities(df).collect()}
    assert got == {"b": (1, 4, 1), "a": (2, 3, 0), "d": (3, 3, 3), "e": (4, 2, 3), "c": (5, 1, 2)}
    assert rules.implementation_priorities(df.limit(0)).count() == 0
