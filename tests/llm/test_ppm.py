import collections
import math
import zlib

import pyarrow.parquet as pq
import pytest

from cohortica.llm import ppm, queries

SF = "/root/testdata/sf0.001"


def brute(docs, train):
    model, words = ppm.Contexts(), collections.Counter()
    toks = lambda t: [*(w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r" else c for c in t or "").split(" ") if w), "\n"]
    coded = lambda t: "".join(w if w == "\n" else w + " " for w in toks(t)).encode()
    for t in train:
        words.update(toks(t))
        raw = b"\n" * ppm.ORDER + coded(t)
        for i in range(ppm.ORDER, len(raw)):
            model.learn(raw[i - ppm.ORDER : i], raw[i])
    n, v = sum(words.values()), len(words)
    for t in docs:
        raw = b"\n" * ppm.ORDER + coded(t)
        w = toks(t)
        yield len(w), sum(words[x] > 0 for x in w), n, sum(math.log10((words[x] + 1) / (n + v + 1)) for x in w), sum(model.log10(raw[i - ppm.ORDER : i], raw[i]) for i in range(ppm.ORDER, len(raw)))


def test_query_against_brute_force(spark):
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    want = dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows], [r["text"] for r in rows if not out(r["doc_id"])]), strict=True))
    got = queries.op2_ppm(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    size = {r["doc_id"]: len(r["text"].encode()) for r in rows}
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > -0.5 * math.log10(256) * sum(size[r.doc_id] for r in held)


@pytest.mark.parametrize("limit", [1 << 23, 400])
def test_slices_and_odd_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(ppm, "SLICE_ROWS", limit)
    monkeypatch.setattr(ppm, "PART_BYTES", 64)
    rows = [(1, "The cat sat on the mat. " * 9), (2, None), (3, ""), (None, "çà et là\tle Chat"), (4, "x" * 500), (4, "x" * 500), (5, "a b a b a b " * 30), (6, " \n\t ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(repr, ([r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)] for r in ppm.score(docs, docs.where("doc_id < 5")).collect())))
    texts = [t for _, t in rows]
    want = brute(texts, [t for i, t in rows if i and i < 5])
    assert got == sorted(repr([i, n, k, round(b, 6), round(s, 6)]) for (i, _), (n, k, _, b, s) in zip(rows, want, strict=True))


@pytest.mark.parametrize("texts", [["ab" + "".join(chr(97 + i * i % 23) for i in range(300)), "ab ab", None], [" ".join("ab"[i >> j & 1] for j in range(9)).replace(" ", "") + " " for i in range(512)]])
def test_passes_of_one_side_only(spark, monkeypatch, texts):
    words, found = len({w for t in texts for w in (t or "").split()}) + 1, set()
    for t in texts:
        raw = b"\n" * ppm.ORDER + b"".join(ppm._bytes_of(w) for w in ppm.parts(t or ""))
        found |= {raw[i - ppm.ORDER : i + 1] for i in range(ppm.ORDER, len(raw))}
    limit = (words + len(found)) // 2
    assert min(words, len(found)) <= limit < max(words, len(found))
    monkeypatch.setattr(ppm, "SLICE_ROWS", limit)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = sorted([r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score] for r in ppm.score(docs, docs).collect())
    for (i, (n, k, _, b, s)), row in zip(enumerate(brute(texts, texts)), got, strict=True):
        assert row[:3] == [i, n, k] and row[3] == pytest.approx(b) and row[4] == pytest.approx(s)


def test_empty_tables_and_adaptive(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    assert ppm.score(none, none).count() == 0
    assert ppm.score(one, none).first().score == pytest.approx(-4 * math.log10(256))
    assert ppm.score_adaptive(one).first().score < 0
    assert ppm.adaptive_log10("ab ab ab ab ab ab") > 6 * ppm.adaptive_log10("ab")


def test_a_pair_of_bytes_larger_than_a_slice(spark, monkeypatch):
    import random

    rng = random.Random(4)
    texts = ["".join(rng.choice("abc") for _ in range(400)) for _ in range(3)] + ["ab", None]
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    monkeypatch.setattr(ppm, "SLICE_ROWS", 60)
    tries = ppm.count(docs).where("kind = 0")
    made = ppm.slices_of(tries)
    assert any(x.thirds for x in made) and all(x.rows(tries).count() <= 60 for x in made)
    got = {r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in ppm.score(docs, docs).collect()}
    for i, (n, k, _, b, s) in enumerate(brute(texts, texts)):
        assert got[f"d{i}"][:2] == (n, k) and got[f"d{i}"][2:] == pytest.approx((b, s))
