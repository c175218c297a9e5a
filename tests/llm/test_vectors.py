import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortica.llm import centroids, codes, queries
from cohortica.llm.common import join_by_weight

SCHEMA = "vec_id long, embedding array<float>, label int, code string, row long, part int"


def rows_of(rng, n, width, spread=3):
    """Few different values, so that parts repeat, distances tie and entries stay unused."""
    return [(i, [float(np.float32(rng.randrange(-spread, spread) / 8)) for _ in range(width)], rng.choice([1, 2, None]), "x", 7, 9) for i in range(n)]


def ints(v, scale):
    return [math.floor(scale * x) for x in v]


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def d2(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def nearest(v, entries):
    return min(range(len(entries)), key=lambda e: (d2(v, entries[e]), e))


def lloyd(values, entries, rounds):
    for _ in range(rounds):
        of = [nearest(v, entries) for v in values]
        entries = [[sum(c) // len(c) for c in zip(*[v for v, o in zip(values, of, strict=True) if o == e], strict=True)] if e in of else entries[e] for e in range(len(entries))]
    return entries


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = sorted(((r[0], ints(r[1], scale), r[2]) for r in rows if fine(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : (p + 1) * w] for _, v, _ in kept] for p in range(parts)]
    books = [lloyd(c, c[:entries], rounds) for c in cut]
    out = []
    for i, (key, _, label) in enumerate(kept):
        e = [nearest(cut[p][i], books[p]) for p in range(parts)]
        out.append((key, label, "".join(f"{x:02x}" for x in e), sum(d2(cut[p][i], books[p][x]) for p, x in enumerate(e))))
    by = {}
    for r in out:
        by[r[1]] = by.get(r[1], 0) + r[3]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((*r, by[r[1]]) for r in out), key=repr), sha


def plain_clusters(rows, k=16, rounds=3, width=64, scale=64):
    kept = [(r[0], ints(r[1], scale)) for r in rows if fine(r[1]) and len(r[1]) == width]
    drawn = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centres = lloyd([v for _, v in kept], [v for _, v in sorted(kept, key=drawn)[:k]], rounds)
    out = [(key, nearest(v, centres), d2(v, centres[nearest(v, centres)])) for key, v in kept]
    by = {c: sum(r[2] for r in out if r[1] == c) for c in range(k)}
    return sorted(((*r, by[r[1]], sum(by.values()), hashlib.sha256(",".join(map(str, centres[r[1]])).encode()).hexdigest()) for r in out), key=repr)


def odd(rng, width):
    rows = rows_of(rng, 60, width)
    rows += [(3, *rows[9][1:]), (None, *rows[5][1:]), (None, *rows[6][1:]), rows[11], rows[11]]
    rows += [(90, None, 1, "x", 7, 9), (91, [None] + rows[0][1][1:], 1, None, None, 9), (92, [float("nan")] + rows[0][1][1:], 1, "x", 7, 9), (93, [float("-inf")] + rows[0][1][1:], 2, "x", 7, 9)]
    return rows + [(100 + i, *rows[4][1:]) for i in range(60)]  # a vector that a third of the table has


@pytest.mark.parametrize("entries", [5, 256])
def test_codes_match_brute_force(spark, entries):
    rows = odd(random.Random(1), 8)
    want, sha = plain_codes(rows, entries=entries)
    coded, books = codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5), entries=entries)
    assert coded.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert sorted(map(tuple, coded.collect()), key=repr) == want and books.sha256 == sha


def test_codes_of_other_lengths_and_none(spark):
    rows = rows_of(random.Random(2), 20, 8)
    coded, _ = codes.compress(spark.createDataFrame([*rows, (50, [1.0], 1, "", 0, 0), (51, [], None, "", 0, 0)], SCHEMA))
    got = {r.vec_id: r for r in coded.collect()}
    assert len(got) == 22 and got[50].code is None and got[51].error is None and all(got[i].code for i in range(20))
    none = spark.createDataFrame([(1, None, 1, "", 0, 0)], SCHEMA)
    coded, books = codes.compress(none)
    assert coded.count() == 0 and books is None and centroids.cluster(none).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        codes.compress(spark.createDataFrame([(1, [1.0] * 6, 1, "", 0, 0)], SCHEMA))
    with pytest.raises(OverflowError):
        codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1, "", 0, 0)], SCHEMA))


def test_reconstruction_is_near(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 0.1, (300, 8)) + np.repeat(np.eye(8), 38, axis=0)[:300])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    coded, books = codes.compress(vectors, entries=64)
    back = {r.vec_id: r.vector for r in codes.reconstruct(coded, books).collect()}
    off = np.array([np.abs(np.array(back[i]) - v).max() for i, v in rows])
    assert len(back) == 300 and off.mean() < 0.15


def test_hot_keys_are_joined_whole(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") < 3000, F.lit(None)).otherwise(F.col("id") % 1500).alias("k"))
    keyed = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    got = join_by_weight(rows, keyed, ["k"], "n", 6000)
    assert got.count() == 6000 and got.columns == ["id", "k", "s"] and got.where("k is null").select("s").distinct().collect()[0].s == sum(range(3000))
    assert got.where("k is not null").agg(F.sum("s")).first()[0] == 2 * sum(range(3000, 6000))


@pytest.mark.parametrize("k", [4, 16])
def test_clusters_match_brute_force(spark, k):
    rng = random.Random(k)
    rows = odd(rng, 20) + rows_of(rng, 3, 19)
    got = centroids.cluster(spark.createDataFrame(rows, SCHEMA).repartition(4), k=k, width=20)
    assert sorted((tuple(r)[:6] for r in got.collect()), key=repr) == plain_clusters(rows, k, width=20)


def test_screening_prunes_and_changes_nothing():
    rng = np.random.default_rng(4)
    centres = rng.integers(-300, 300, (16, 64))
    x = centres[rng.integers(0, 16, 4000)] + rng.integers(-40, 40, (4000, 64))
    every = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    short = centroids.block_norms(x)
    assert (centroids.lower_bounds(short, centroids.block_norms(centres)) <= np.sqrt(every)).all()
    label, best, taken = centroids.nearest(x, short, centres)
    assert (label == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert taken.mean() < 3  # of 16
    same = np.zeros((5, 64), np.int64)
    assert (centroids.nearest(same, centroids.block_norms(same), np.zeros((3, 64), np.int64))[0] == 0).all()


def test_queries_match_brute_force(spark, tmp_path):
    rows = rows_of(random.Random(7), 290, 64, 30)
    spark.createDataFrame(rows, SCHEMA).select("vec_id", "embedding", "label").write.parquet(str(tmp_path / "embeddings.parquet"))
    want, sha = plain_codes(rows)
    got = queries.op11_vector_codes(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == sorted((a, c, d, e, sha) for a, _, c, d, e in want)
    assert sorted(map(tuple, queries.op12_screened_centroids(spark, str(tmp_path)).collect()), key=repr) == plain_clusters(rows)
