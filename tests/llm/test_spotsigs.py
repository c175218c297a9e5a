import hashlib
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortica.llm import queries, spotsigs

SF = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\W_]+", text.lower())


def spots(text):
    w, out = words_of(text), set()
    for i, x in enumerate(w):
        if x in spotsigs.ANCHORS:
            chain = [y for y in w[i + 1 :] if y not in spotsigs.ANCHORS][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add(" ".join([x, *chain]))
    return out or {" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 1)) if w[i : i + 2] and (len(w) > 1 or w)} - {""}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_brute_force(spark):
    rows = sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda r: -r["doc_id"])
    got = {r.doc_id: r for r in queries.op6_spotsigs(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        t, nxt = r["text"] or "", rows[(i + 1) % len(rows)]["text"] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        g = got[r["doc_id"]]
        assert g.n_chars == len(t) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, e, x = spots(t), spots(edited), spots(nxt)
        assert len(g.fingerprint) == 16 * len(a) and len(g.edited_fingerprint) == 16 * len(e)
        for other, value in ((e, g.near_edited), (x, g.near_next)):
            assert value == pytest.approx(jaccard(a, other))


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_next_in_blocks_and_odd_rows(spark, block):
    rows = [(1, "b"), (5, "the cat sat"), (5, "a"), (None, "n"), (900, None), (901, "x" * 100_000), (-7, "the " * 20_000), (None, "m"), (5, "a"), (-(2**63), "low"), (2**63 - 1, "high"), (10**15, "far")]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], "doc_id long, text string, next_text string, spots int").repartition(3)
    got = {(r.doc_id, r.text, r.next_text) for r in spotsigs.with_next(docs, block).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    assert got == {(i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order)}
    assert spotsigs.fingerprint_edits(docs).count() == len(rows)
    assert spotsigs.fingerprint_edits(docs.where("false")).count() == 0
    one = spotsigs.fingerprint_edits(docs.where("doc_id = 1")).collect()
    assert [r.edited_text for r in one] == ["b"] and one[0].near_next == 1.0


def test_near_pairs_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {r.f: set(r.s) for r in docs.select(spotsigs.spots(F.coalesce("text", F.lit(""))).alias("s")).where("size(s) > 0").select("s", spotsigs.as_text(F.col("s")).alias("f")).collect()}
    names = sorted(sets)
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if jaccard(sets[a], sets[b]) >= 0.8}
    assert want and {tuple(sorted((r.fingerprint_a, r.fingerprint_b))) for r in spotsigs.near_pairs(docs).collect()} == want


def test_likeness_of_unlike_sizes_is_exact(spark):
    row = spark.range(1).select(F.array(F.lit(1)).alias("a"), F.sequence(F.lit(1), F.lit(100)).alias("b"))
    assert row.select(spotsigs.pruned_jaccard(F.col("a"), F.col("b"))).first()[0] == pytest.approx(0.01)


@pytest.mark.parametrize("text", ["intro the of the of the of the of the of alpha beta", "the", "the cat", "the cat the", "a cat sat on the mat in the hat", "", "one", "one two", "eins zwei drei vier"])
def test_spots_of_runs_of_common_words(spark, text):
    got = spark.createDataFrame([(text,)], "text string").select(F.size(spotsigs.spots(F.col("text")))).first()[0]
    assert got == len(spots(text))


def test_one_far_id_leaves_blocks_even(spark):
    docs = spark.range(3000).select(F.when(F.col("id") == 0, 10**15).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    sizes = [r["count"] for r in spotsigs._blocks(docs, 100).groupBy("part", "sub").count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == 3000
