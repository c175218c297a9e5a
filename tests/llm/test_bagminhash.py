import collections
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from cohortica.llm import bagminhash as bmh
from cohortica.llm import queries
from cohortica.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def bag(text):
    w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if x]
    return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def classes(texts, threshold=0.8):
    bags, parent = [bag(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    at = collections.defaultdict(list)
    for i, b in enumerate(bags):
        for s in b:
            at[s].append(i)
    for i, b in enumerate(bags):
        for j in {j for s in b for j in at[s] if j < i} | {j for j in range(i) if (texts[i] or "") == (texts[j] or "")}:
            if (texts[i] or "") == (texts[j] or "") or jaccard(b, bags[j]) >= threshold:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(texts))]


def test_query_against_brute_force(spark):
    rows = sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"])
    want = classes([r["text"] for r in rows])
    got = {r.doc_id: r.class_id for r in queries.op9_bagminhash(spark, SF).collect()}
    assert got == {r["doc_id"]: rows[c]["doc_id"] for r, c in zip(rows, want, strict=True)}
    assert len(set(got.values())) < len(rows)


def test_shingles_are_the_bag():
    texts = ["", "a b c d e f a b c d e f g", " \n", "one two", "x\ty  z\nw v", "a b c d e"]
    doc, h, w = bmh.shingles(texts)
    for i, t in enumerate(texts):
        assert sorted(w[doc == i]) == sorted(bag(t).values())
    assert set(h[doc == 5]) <= set(h[doc == 1]) and not set(h[doc == 4]) & set(h[doc == 1])


def test_registers_estimate_weighted_jaccard():
    rng = random.Random(3)
    a = collections.Counter({i: rng.randint(1, 9) for i in range(60)})
    b = collections.Counter({i: rng.randint(1, 9) for i in range(20, 80)})
    m = 6000
    doc = np.repeat([0, 1], [len(a), len(b)])
    keys = bmh._mix(np.array([*a, *b], np.uint64) + np.uint64(11))
    sig = bmh.signatures(doc, keys, np.array([*a.values(), *b.values()]), 2, m)
    assert np.mean(sig[0] == sig[1]) == pytest.approx(sum((a & b).values()) / sum((a | b).values()), abs=4 * 0.5 / m**0.5)


def test_likeness_is_exact():
    a, b = "the quick brown fox jumps over the lazy dog " * 4, "the quick brown fox jumps over the lazy cat " * 4
    assert bmh.likeness(a, b) == pytest.approx(jaccard(bag(a), bag(b)))


def test_odd_rows_and_one_of_each(spark):
    base = " ".join(f"w{i}" for i in range(200))
    near = base.replace("w100 ", "other ")
    far = " ".join(f"v{i}" for i in range(200))
    rows = [(5, base, "a"), (3, near, "b"), (9, far, "c"), (None, base, None), (1, None, "x"), (2, "", "y"), (7, " \n", "z"), (9, far, "c"), (8, "tiny", "k"), (6, "tiny", "k"), (4, "long " * 30_000, "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class string").repartition(4)
    got = {(r.doc_id, r.class_id) for r in bmh.near_duplicates(docs).collect()}
    assert got == {(5, 3), (3, 3), (9, 9), (None, 3), (1, 1), (2, 1), (7, 7), (8, 6), (6, 6), (4, 4)}
    kept = bmh.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 6, 7, 9]
    assert bmh.near_duplicates(docs.where("false")).count() == 0


def test_large_group_of_near_copies_and_chain(spark):
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*words[:i % 119], f"edit{i}", *words[i % 119 + 1 :]])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in bmh.near_duplicates(docs).collect()} == {0}
    chain = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(100, 101)], "a long, b long")
    with Scratch(spark) as scratch:
        assert {(r["key"], r["class"]) for r in bmh.components(chain, scratch).collect()} == {(i, 0) for i in range(71)} | {(100, 100), (101, 100)}


def edited(rng, words, edits):
    out = list(words)
    for at in rng.sample(range(len(words)), edits):
        out[at] = f"edit{rng.randrange(10**9)}"
    return " ".join(out)


def test_early_pairs_are_all_pairs_that_are_alike(spark):
    """All pairs of the threshold are among them, and copies that differ too much from each other hardly meet."""
    rng = random.Random(5)
    base = [f"w{i % 90}" for i in range(100)]
    texts = [" ".join(base)] + [edited(rng, base, 1 + i % 5) for i in range(170)] + [" ".join([*base, *(["again"] * (i % 40))]) for i in range(60)]
    texts += [" ".join(f"x{rng.randrange(6)}" for _ in range(30)) for _ in range(60)]
    texts = list(dict.fromkeys(texts))
    bags = [bag(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    uids = docs.select(bmh.text_key().alias("text_key"), bmh.F.col("doc_id").alias("uid"))
    opened = spark.createDataFrame([(i, i % 7, sum(b.values())) for i, b in enumerate(bags)], "uid long, class long, n_shingles long")
    want = {(i, j) for j in range(len(texts)) for i in range(j) if i % 7 != j % 7 and jaccard(bags[i], bags[j]) >= 0.8}
    with Scratch(spark) as scratch:
        pairs = scratch.save(bmh.early_pairs(opened, uids, docs, 0.8, scratch))
        got = {(r.a, r.b) for r in pairs.collect()}
        kept = {tuple(sorted((r.a, r.b))) for r in bmh.verify(pairs, uids, docs, 0.8, scratch).collect()}
    assert len(want) > 100 and want <= got and kept == want
    apart = {i for i in range(len(texts)) if 0 < i <= 170 and jaccard(bags[i], bags[0]) < 0.75}
    assert len(apart) > 80
    assert sum(i in apart and j in apart for i, j in got) < len(apart)


def test_a_long_text_in_pieces(monkeypatch):
    rng = random.Random(2)
    texts = ["a b", "", " ".join(f"w{rng.randrange(50)}" for _ in range(3000)), "c d e f g h", " ".join(f"v{rng.randrange(9)}" for _ in range(700))]
    whole = bmh.shingles(texts)
    sig = bmh.signatures(*whole, len(texts))
    monkeypatch.setattr(bmh, "PART_BYTES", 800)
    monkeypatch.setattr(bmh, "PART_SHINGLES", 100)
    parts = bmh.shingles(texts)
    assert all((x == y).all() for x, y in zip(whole, parts, strict=True)) and (bmh.signatures(*parts, len(texts)) == sig).all()


def test_clashing_columns_and_string_ids(spark):
    rows = [("b", "one two three four five six", "k", "n1"), ("a", "one two three four five six", "k", "n2"), ("a", "one two three four five six", None, "n2"), (None, None, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, key string, `__nth` string")
    kept = bmh.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == [("a", "one two three four five six", "k", "n2"), (None, None, "x", "y")]
