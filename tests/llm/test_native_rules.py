import collections
import math
import re
import zlib

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortica.llm import bpe, chat, hash_tree, mixing, queries, rules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    rel = duck.sql(queries.oracle_sql()[name])
    cols = sorted(df.columns)
    rows = lambda names, data: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in (dict(zip(names, r, strict=True))[c] for c in cols)) for r in data)
    assert cols == sorted(rel.columns) and rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())


# ---- hash tree ----


def test_shards(spark):
    got = queries.op3_hash_tree(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    slots = collections.defaultdict(list)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert len(got) == len(texts) and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_weights_and_movement(spark):
    keys = spark.range(60_000)
    place = lambda tree: [r[0] for r in keys.select(hash_tree.shard_of(tree, F.col("id"))).collect()]
    before, heavy, out, grown = (place(t) for t in (hash_tree.build_tree(24), hash_tree.build_tree(24, {3: 2.0}), hash_tree.build_tree(24, {9: 0.0}), hash_tree.build_tree(25)))
    n = collections.Counter(before)
    assert max(n.values()) < 1.1 * 2500 and min(n.values()) > 0.9 * 2500
    assert abs(collections.Counter(heavy)[3] - 60_000 * 2 / 25) < 400
    region = lambda s: s // 8
    # a heavier shard takes keys into its region only; other regions keep theirs where they are
    assert all(a == b or region(b) == 0 for a, b in zip(before, heavy, strict=True))
    assert 9 not in out and all(a == b or region(a) == 1 for a, b in zip(before, out, strict=True))
    assert all(b in (a, 24) for a, b in zip(before, grown, strict=True)) and abs(sum(b == 24 for b in grown) - 2400) < 250
    # the 26th shard shares the 25th's region: keys that come to the region go to either of them, and others stay
    more = place(hash_tree.build_tree(26))
    moved = [(a, b) for a, b in zip(grown, more, strict=True) if a != b]
    assert moved and all(b in (24, 25) for _, b in moved) and any(a != 24 and b == 24 for a, b in moved)


def test_shard_by_draws_made_by_hand(spark):
    """Every draw by itself, level by level, without the tree's expressions."""
    tree = hash_tree.build_tree(24, {3: 2.5, 9: 0.0})
    rows = [i for i in range(200)]
    names = sorted({n.name for n in _nodes(tree)})
    keys = spark.createDataFrame([(i,) for i in rows], "id long")
    drawn = {(r.id, r.name): (r.h % 2**64 >> 11) + 0.5 for r in keys.crossJoin(spark.createDataFrame([(n,) for n in names], "name string")).select("id", "name", F.xxhash64("name", "id").alias("h")).collect()}
    got = {r.id: r.shard for r in keys.select("id", hash_tree.shard_of(tree, F.col("id")).alias("shard")).collect()}
    for i in rows:
        node = tree
        while node.shard is None:
            node = min((x for x in node.children if x.total() > 0), key=lambda x: -math.log(drawn[i, x.name] / 2**53) / x.total())
        assert got[i] == node.shard


def _nodes(node):
    return [node, *(n for x in node.children for n in _nodes(x))]


def test_shards_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "s", 5), (None, "é", None, 6), (None, "é", None, 6), (1, "x" * 100_000, "q", 7)], "doc_id long, text string, shard string, slot int")
    got = hash_tree.assign(docs, 24).collect()
    assert sorted(r["size"] for r in got) == [8, 10, 10, 100_008] and all(r.grown_shard is None for r in got)
    assert len({(r.shard, r.slot) for r in got}) == 4
    assert hash_tree.assign(docs.where("false"), 24).count() == 0


# ---- mixing ----


def fill(sizes, weights, share, cap):
    """Deals by weight, again and again, what sources at their cap can't take."""
    total, target, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / w > cap * sizes[i]}
        if not over:
            for i in open_:
                target[i] = left * weights[i] / w
            break
        for i in over:
            target[i] = cap * sizes[i]
        left -= sum(target[i] for i in over)
        open_ -= over
    return target


def test_targets_and_copies(spark):
    texts = {"b": 30, "a": 500, "é": 7, None: 120, "z": 0, "c": 900, "A": 60}
    docs = spark.createDataFrame([(10_000 * k + i, "w " * 10, s, "x") for k, (s, n) in enumerate(texts.items()) for i in range(n)] + [(900_000, None, "z", "y"), (900_001, "", "b", "y"), (None, " \n", None, "y")], "doc_id long, text string, source string, mix_copies string")
    got = mixing.plan_mix(docs).collect()
    names = [*sorted(k for k in texts if k), None]
    sizes = [10 * texts[k] for k in names]
    want = dict(zip(names, fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2.0), strict=True))
    taken = collections.Counter()
    for r in got:
        assert r.mix_target == pytest.approx(want[r.source]) and r.mix_source_size == 10 * texts[r.source] and 0 <= r.mix_copies <= 2
        taken[r.source] += r.mix_size * r.mix_copies
    assert len(got) == docs.count() and all(abs(taken[k] - want[k]) <= max(150, 0.15 * want[k]) for k in names)
    assert [r.mix_copies for r in mixing.plan_mix(docs).orderBy("doc_id").collect()] == [r.mix_copies for r in mixing.plan_mix(docs.repartition(5)).orderBy("doc_id").collect()]
    assert mixing.emit(mixing.plan_mix(docs)).count() == sum(r.mix_copies for r in got)
    assert mixing.plan_mix(docs.where("false")).count() == 0


def test_many_sources_are_joined_without_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c", str(i % 50) if i % 3 else "hot") for i in range(600)], "doc_id long, text string, source string")
    small = {r.doc_id: r.mix_copies for r in mixing.plan_mix(docs).collect()}
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 3)
    assert {r.doc_id: r.mix_copies for r in mixing.plan_mix(docs).collect()} == small


# ---- rules ----


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    five = collections.defaultdict(list)
    for i in range(len(words) - 4):
        five[tuple(words[i : i + 5])].append(i)
    cover = {i + k for at in five.values() if len(at) > 1 for i in at for k in range(5)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover), n < 10 or 100 * len(cover) > 20 * n


ODD = [None, "", " \n\t", "a b c d e a b c d e", "x " * 5, "x " * 4, "é😀 ñ b c", "l\nl\n\nl\n \n", "a b c d e f " * 3 + "z", "w " * 20_000, "#*$%&|<> !", "one two three four five six seven eight nine ten"]


def test_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, 1.5) for i, t in enumerate(ODD)] + [(0, None, None)], "doc_id int, text string, quality double")
    for r in rules.judge(docs).collect():
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == brute_rules(ODD[r.doc_id]), r.doc_id
    assert rules.judge(docs.where("false")).count() == 0


def test_clean_documents_stay_and_bad_ones_go(spark):
    sf = "/root/testdata/sf0.1"
    kept = rules.judge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")).select("doc_id", F.col("quality.kept").alias("kept"), F.col("quality.base_failed").alias("failed"))
    got = kept.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept"), F.avg(F.col("failed").cast("double")).alias("failed")).collect()
    by = {r.quality: r for r in got}
    assert by[1].kept >= 0.998 * (1 - by[1].failed) and by[0].kept < 0.05


# ---- chat ----


def test_windows_keep_budget_and_turns(spark):
    rows = [(1, 0, "system", "s " * 6)] + [(1, i, "user" if i % 2 else "assistant", f"t{i} " * 20) for i in range(1, 40)]
    w = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=150, history_budget=50, history_turns=2).orderBy("window").collect()
    assert len(w) > 5
    for x in w:
        assert len(re.findall(r"\S+", x.formatted)) <= 150 and x.formatted.startswith("<|im_start|>system\n")
        assert x.repeated == 0 if x.window == 0 else 1 <= x.repeated <= 3
        for s in x.loss:
            assert x.formatted[: s.start].endswith("<|im_start|>assistant\n") and x.formatted[s.end :].startswith("<|im_end|>")
    targets = "".join(x.formatted[s.start : s.end] for x in w for s in x.loss)
    assert targets == "".join(r[3] for r in rows if r[2] == "assistant")


# ---- byte-level BPE ----


def reference_encoding():
    import base64

    import public_tokenizers as P
    import tiktoken

    path = P.path(queries.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, P.PATTERN, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [None, "", "Hello'll we're 123 ½ ٣٤", " \n\n  x\t\t", "é😀👨‍👩‍👧 日本語 Ünïcödé", "<|endoftext|></s>", "a" * 5000, " " * 3000, "word " * 40_000, "  　x", "\x00\x01\x7f", "Hello'll we're 123 ½ ٣٤"]


def test_ids_are_the_reference_encoders(spark):
    path, pattern, enc = reference_encoding()
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    for r in bpe.encode_documents(docs, path, pattern, offsets=True).collect():
        t = TEXTS[r.doc_id] or ""
        assert list(r.ids) == enc.encode_ordinary(t) and bytes(r.decoded) == t.encode()
        raw = t.encode()
        assert r.byte_offsets[-1] == len(raw) and [raw[a:b] for a, b in zip(r.byte_offsets, r.byte_offsets[1:], strict=False)] == [enc.decode_single_token_bytes(i) for i in r.ids]
        for (a, b), i, at in zip(r.char_offsets, r.ids, r.byte_offsets, strict=False):
            piece = enc.decode_single_token_bytes(i)
            assert a == len(raw[:at].decode("utf-8", "ignore")) and piece in t[a:b].encode()
    assert bpe.encode_documents(docs.where("false"), path, pattern).count() == 0


def test_query_against_reference(spark):
    import hashlib

    _, _, enc = reference_encoding()
    texts = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    got = queries.op10_byte_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_every_code_point_is_cut_as_by_the_reference_encoder():
    path, pattern, enc = reference_encoding()
    c = bpe.codec(path, pattern, bpe.classed_apart())
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for k in range(0, len(every), 1 << 15):
        texts = ["".join(f"x{e}5{e} {e}{e}\n" for e in every[j : j + 64]) for j in range(k, min(k + (1 << 15), len(every)), 64)]
        assert c.encode(texts) == enc.encode_ordinary_batch(texts, num_threads=1)


def test_stand_ins_take_the_class_that_is_asked_for():
    c = bpe.Codec({bytes([b]): b for b in range(256)}, r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+", ((ord("b"), ord("c"), bpe.STAND_INS["N"]), (0x3B1, 0x3B1, bpe.STAND_INS["N"]), (0x3B2, 0x3B2, bpe.STAND_INS[""])))
    assert c.pieces("abc1") == ["abc", "1"]  # texts in ASCII are never looked into
    assert c.pieces("aα1βγ-") == ["a", "α1", "β", "γ", "-"]


def test_split_characters(monkeypatch):
    path, pattern, _ = reference_encoding()
    c = bpe.codec(path, pattern)
    ids = c.encode(["😀🏿"])[0]
    assert c.decode(ids) == "😀🏿" and "�" in c.decode(ids[:1])
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 4)
    fresh = bpe.Codec({bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257}, pattern)
    assert fresh.encode(["abc ab", "abcab", "zz"]) == [[257, 32, 256], [257, 256], [122, 122]]


def test_mix_with_columns_named_like_its_own(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", "k", 1, 5.0), (2, "d", None, "k", 2, 6.0), (2, "d", None, "k", 2, 6.0), (3, None, "y", None, 3, None)], "doc_id long, text string, source string, mix_for string, MIX_COPY int, mix_rate double")
    planned = mixing.plan_mix(docs)
    assert planned.count() == 4 and set(docs.columns) < set(planned.columns)
    out = mixing.emit(planned)
    assert out.columns == docs.columns and out.count() == sum(r.mix_copies for r in planned.collect())
    assert mixing.emit(mixing.plan_mix(docs.where("false"))).count() == 0
