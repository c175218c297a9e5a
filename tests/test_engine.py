import math
import warnings

import duckdb
import pytest

import __spark_entry__
from cohortica.plans import catalog, segmentation
from cohortica.plans.runner import Options, Stage, duration, run_stages
from cohortica.sources import readers, writers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import os

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    return round(v, 4) + 0.0 if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rel = duck.sql(catalog.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    names = rel.columns
    want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert all(x == y or (isinstance(x, float) and x == pytest.approx(y, abs=2e-4)) for x, y in zip(a, b, strict=True)), (a, b)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_rows_only(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Variable,Label,Role\na,N/A,segmentation\nb,x,NA\n")
    m = readers.read_metadata(spark, str(tmp_path / "m.csv")).collect()
    assert [(r.variable, r.label, r.role, r.group) for r in m] == [("a", None, "segmentation", None), ("b", "x", None, None)]
    (tmp_path / "t.tsv").write_text("a\tb\n1\tx\n")
    assert readers.read_table(spark, str(tmp_path / "t.tsv")).first().asDict() == {"a": 1, "b": "x"}
    writers.write_table(spark.range(3), str(tmp_path / "out.csv"), "csv", single_file=True)
    assert readers.read_table(spark, str(tmp_path / "out.csv")).count() == 3
    assert readers.read_or_empty(spark, str(tmp_path / "none.parquet"), spark.range(1).schema).count() == 0
    assert readers.first_existing(spark, [str(tmp_path / "no"), str(tmp_path / "t.tsv")]).endswith("t.tsv")
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_table(spark, "x.rds")
    assert "<td>0</td>" in writers.render_html("t", {"a": spark.range(1)}) and "first" not in writers.render_html("t", {"a": spark.range(3)}, 3)
    page = writers.render_html("t", {"a": spark.range(9).coalesce(1)}, 3)
    assert "The first 3 rows." in page and page.count("<td>") == 3
    with pytest.raises(ValueError, match="too many rows"):
        writers.write_workbook({"a": spark.range(3)}, str(tmp_path / "b.xlsx"), 2)


def test_runner(spark, tmp_path):
    made = []
    ok = lambda n: Stage(n, f"s{n}", lambda s, t, n=n: made.append(n) or {f"t{n}": s.range(n)}, (f"t{n}",))
    bad = Stage(3, "bad", lambda s, t: 1 / 0, ("t3",), required=False)
    noisy = Stage(4, "noisy", lambda s, t: warnings.warn("hm") or {"t4": t["t2"]}, ("t4",))
    out = {r.stage: r for r in run_stages(spark, [ok(1), ok(2), bad, noisy], str(tmp_path)).collect()}
    assert [out[i].status for i in (1, 2, 3, 4)] == ["SUCCESS", "SUCCESS", "FAILED", "SUCCESS"] and out[4].n_warnings == 1 and "division" in out[3].error
    again = run_stages(spark, [ok(1), ok(2)], str(tmp_path), Options(force_rerun=False)).collect()
    assert {r.status for r in again} == {"SKIPPED_OUTPUTS_EXIST"} and made == [1, 2]
    resumed = run_stages(spark, [ok(1), ok(2), noisy], str(tmp_path), Options(resume_from=4)).collect()
    assert [r.stage for r in resumed] == [4]
    with pytest.raises(RuntimeError, match="stage 5"):
        run_stages(spark, [Stage(5, "worse", lambda s, t: 1 / 0)], str(tmp_path))
    assert duration(5) == "5.0 s" and duration(90) == "1.5 min" and duration(7200) == "2.0 h"


def test_workflow(spark, tmp_path):
    from cohortica.config import Settings

    s = Settings(bootstrap_rounds=5, gap_rounds=4, kmeans_starts=5, k_values=(3, 4), feature_counts=(3, 4))
    stages = segmentation.stages("respondent_id", catalog.NUMERIC, catalog.CATEGORICAL, catalog.GROUPS, s, sample=150)
    status = run_stages(spark, stages, str(tmp_path), Options(tables={"respondents": catalog.respondents(spark, SF)})).collect()
    assert [r.status for r in status] == ["SUCCESS"] * 11, [r.error for r in status]
    segments = spark.read.parquet(str(tmp_path / "segments.parquet"))
    assert segments.count() == 150 and 3 <= segments.select("segment").distinct().count() <= 4
    assert spark.read.parquet(str(tmp_path / "personas.parquet")).count() == segments.select("segment").distinct().count()
    table = lambda n: spark.read.parquet(str(tmp_path / f"{n}.parquet"))
    ranked, scored, final = table("model_ranks").collect(), table("validation").collect(), table("final_models").collect()
    assert {r.method for r in ranked} == {"pam", "hierarchical", "kmeans"}
    assert {r.model_id for r in scored} == {r.model_id for r in ranked if r.acceptable_size} and all(0 <= r.average_jaccard <= 1 for r in scored)
    chosen = [r for r in final if r.selected]
    best = max(r.validation_score for r in scored if r.shortlist_status == "Shortlist" or not any(x.shortlist_status == "Shortlist" for x in scored))
    assert len(chosen) == 1 and chosen[0].final_score == max(r.final_score for r in final) and all(r.validation_score >= best - s.candidate_tolerance for r in final)
    assert segments.select("segment").distinct().count() == chosen[0].k
    assert sum(r.models_validated for r in table("validation_summary").collect()) == len(scored)
