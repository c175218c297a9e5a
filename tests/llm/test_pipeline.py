import collections
import re

import pytest

import corpus_pipeline
from cohortica.llm import mixing, ordinal
from tests.llm.test_bagminhash import classes
from tests.llm.test_pii import base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        out.append((name, docs, made := f(spark, docs, SF)))
        made.write.parquet(path := str(tmp_path_factory.mktemp(name) / "out"))
        docs = spark.read.parquet(path)
        out[-1] = (name, out[-1][1], docs)
    return {n: (i, o) for n, i, o in out}


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        assert name == "encode" or after.columns == before.columns


def test_quality_keeps_clean_and_drops_bad(spark, stages):
    before, after = stages["quality"]
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [r.doc_id for r in labels if r.quality == 1 and not r.toxic]
    bad = [r.doc_id for r in labels if r.quality == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in bad) <= 0.1 * len(bad)
    model = ordinal.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept == {r.doc_id for r in before.collect() if model.tails([r.text or ""])[0][1] >= 0.5}


def test_one_of_each_class_stays(stages):
    before, after = (sorted(x.collect(), key=lambda r: r.doc_id) for x in stages["near_duplicates"])
    of = classes([r.text for r in before])
    assert [r.doc_id for r in after] == sorted({before[c].doc_id for c in of})


def test_no_personal_data_is_left(stages):
    before, after = ({r.doc_id: r for r in x.collect()} for x in stages["private_data"])
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not base(r.text) and r.n_chars == len(r.text)
        assert base(before[i].text) or re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", r.text) or r.text == before[i].text


def test_mix_repeats_by_rate(spark, stages):
    before, after = stages["mix"]
    times = collections.Counter(r.doc_id for r in after.collect())
    assert times == collections.Counter({r.doc_id: r.mix_copies for r in mixing.plan_mix(before).collect() if r.mix_copies})
    assert max(times.values()) <= 2


def test_encoding_round_trips(stages):
    before, after = stages["encode"]
    assert before.count() == after.count() and after.where("not round_trip").count() == 0


def test_run_is_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    last = stages["encode"][1]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, last.collect()))


@pytest.mark.parametrize("rows", [0, 1])
def test_stages_with_nulls_and_clashing_columns(spark, rows):
    """Every stage takes null ids, texts and sources, repeated rows, columns named like its own, and an empty table."""
    odd = [(1, "one two three four five six seven", "en", "s", 7, "k", 1), (1, "one two three four five six seven", "en", "s", 7, "k", 1), (None, None, None, None, None, None, None), (2, "", "de", None, 0, "x", 2), (3, "mail a@b.co " * 2000, "en", "s", 24000, None, 3)]
    columns = "doc_id long, text string, lang string, source string, n_chars long, key string, spans int"
    docs = spark.createDataFrame(odd if rows else [], columns)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        got = out.count()
        assert name == "encode" or out.columns == docs.columns, name
        assert got <= 2 * docs.count() and (rows or got == 0), name
        if name == "near_duplicates" and rows:
            assert sorted((r.doc_id or 0, r.text or "") for r in out.collect())[:2] == [(1, "one two three four five six seven"), (2, "")], name
