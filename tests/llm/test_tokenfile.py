import random
import zlib
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortica.llm import queries, tokenfile
from cohortica.llm.tokenfile import EliasFano, Encoder, Reader

PATH = public_tokenizers.path(queries.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def ids_of(encoder, texts):
    return [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)]


@given(st.lists(st.integers(0, 2**40), max_size=700), st.integers(0, 2**63 - 1))
@settings(max_examples=60, deadline=None)
def test_elias_fano_is_exact(numbers, offset):
    v = np.sort(np.array([*numbers, *([offset] if offset % 3 == 0 else [])], np.uint64))
    packed = EliasFano.pack(v)
    ef = EliasFano(packed)
    assert (ef.select(0, len(v)) == v).all()
    for i in range(0, len(v), 37):
        assert ef.select(i) == v[i] and (ef.select(i, min(len(v), i + 300)) == v[i : i + 300]).all()
        assert ef.rank_of(int(v[i])) == int(np.searchsorted(v, v[i]))


def test_elias_fano_is_near_minimal():
    rng = np.random.default_rng(1)
    for n, gap in ((100_000, 400), (70_000, 1), (5000, 10**9)):
        v = np.cumsum(rng.integers(0, 2 * gap + 1, n).astype(np.uint64), dtype=np.uint64)
        assert 8 * len(EliasFano.pack(v)) <= n * (2 + max(0, np.log2(int(v[-1]) / n)) + 32 / tokenfile.SAMPLE + 1) + 400
    with pytest.raises(IndexError):
        EliasFano(EliasFano.pack(v)).select(5, 5001)
    assert len(EliasFano(EliasFano.pack(v[:0])).select(0, 0)) == 0


def test_encoder_is_the_library(library, encoder):
    rng = random.Random(5)
    bits = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\x0b", "\x1c", "\x85", "᠎", "​", "don't", "'s", "x's.", "ab", "A1", "12", ".", "...", ",", "!?", "\"x\".", "é", "naïve.", "漢字", "é", "😀", "<|endoftext|>", "²", "_", "a.b", "(", "x,'s"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["", " ", "\n", "<|endoftext|>", "w " * 5000, "long" * 3000]
    assert ids_of(encoder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(encoder, texts[:50]) == [library.encode(t, add_special_tokens=False).ids for t in texts[:50]]


def test_every_code_point_beside_a_cut(library, encoder):
    """A text is cut in front of white space and after an ASCII letter's stop: no character beside may change that."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    some = [c for c in points if ord(c) < 0x3100] + random.Random(6).sample(points, 4000)
    for make in ("a{c}\n\nb {c} ", "!{c} {c}.\t x.{c}", "{c}\n \n{c}a. 's{c}"):
        texts = [make.format(c=c) for c in some]
        assert ids_of(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_other_tokenizers_go_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Hello,  world.\n", "", "a b"]
    assert ids_of(Encoder(path), texts) == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def expected(library, rows):
    made = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows]
    starts = [0, *accumulate(len(i) for _, i in made)]
    return [(d, s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for (d, i), s in zip(made, starts, strict=False)]


def test_query_matches_brute_force(spark, library, tmp_path):
    rng = random.Random(7)
    rows = [(i * 7 - 50, None if i % 11 == 0 else " ".join(f"w{rng.randrange(50)}," for _ in range(rng.randrange(60)))) for i in range(400)]
    rows += [(9000, "x " * 200_000), (2**62, " odd\n\n"), (-(2**61), "")]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_elias_fano_ids(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == expected(library, sorted(rows, key=lambda r: r[0]))


def test_files_hold_everything(spark, library, tmp_path):
    texts = {1: ["b"], 2: ["same", "same", "other"], None: ["n", None]}
    rows = [(d, t, 5, "x") for d, ts in texts.items() for t in ts]
    docs = spark.createDataFrame(rows, "doc_id int, text string, k int, ids string").repartition(3)
    files = tokenfile.write_files(docs, PATH, 2, str(tmp_path / "out"), files=4)
    back = tokenfile.read_files(spark, files).orderBy("start").collect()
    assert [r.doc_id for r in back] == [1, 2, 2, 2, None, None]
    assert sorted((repr(r.doc_id), library.decode([i for i in r.ids[:-1]])) for r in back) == sorted((repr(d), t or "") for d, t, *_ in rows)
    assert all(r.ids[-1] == 2 for r in back) and [r.start for r in back] == [0, *accumulate(len(r.ids) for r in back)][:-1]
    listed = files.orderBy("file").collect()
    assert sum(r.n_docs for r in listed) == 6 and sum(r.n_ids for r in listed) == sum(len(r.ids) for r in back)
    found = [(reader, reader.find(2)) for reader in (Reader(r.path) for r in listed) if reader.find(2) is not None]
    assert found and all(reader.document(at)[-1] == 2 for reader, at in found) and all(Reader(r.path).find(77) is None for r in listed)
    assert tokenfile.write_files(docs.limit(0), PATH, 2, str(tmp_path / "none")).count() == 0
    assert tokenfile.digests(spark, tokenfile.write_files(docs.limit(0), PATH, 2)).count() == 0
    (tmp_path / "bad").write_bytes(b"0" * 40)
    with pytest.raises(ValueError, match="no file of token ids"):
        Reader(str(tmp_path / "bad"))
