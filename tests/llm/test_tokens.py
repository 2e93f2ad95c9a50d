"""Operators 3 and 7 against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shockline.llm import bpe, tokenfile

from ..conftest import SF

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")
MULTI, BYTE = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", "a\n\nb", " a", "a ", "a\n b", "don't we'll", "x" * 3000, "ß é ñ 中文 𝄞", "\x1c\x85\x01", "1 22 333,4.5!?", "<|endoftext|>", "word.\nNext", None]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(MULTI), special_tokens={})


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE)
    t.encode_special_tokens = True
    return t


def ids(data: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def some_texts(n=2000):
    r = random.Random(3)
    alphabet = "abcdeth  \n\t'sS,.1é中𝄞\x1c\x85!?"
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 20))) for _ in range(n)]


def test_encoder_equals_tiktoken(reference):
    cache, decoder = bpe.worker(MULTI, P.PATTERN)
    texts = [*some_texts(), *ODD]
    for t, got in zip(texts, cache.ids(pa.array(texts), 100), strict=True):
        assert got.tolist() == reference.encode_ordinary(t or ""), repr(t)
        assert decoder.decode(got) == (t or "").encode()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeghinorst", min_size=1, max_size=60), st.text(alphabet="abcst", max_size=20), st.integers(0, 59), st.integers(0, 9))
def test_appends_and_edits_are_exact(a, b, at, removed):
    enc = _encoder()
    piece = bpe.LongPiece(enc, a.encode())
    assert piece.ids() == enc.merged(a.encode())
    piece.append(b.encode())
    assert piece.ids() == enc.merged((a + b).encode())
    at = min(at, len(piece.bytes))
    piece.edit(at, removed, b.encode())
    assert piece.ids() == enc.merged(bytes(piece.bytes))
    assert bytes(piece.bytes) == ((a + b)[:at] + b + (a + b)[at + removed :]).encode()


_made = []


def _encoder():
    if not _made:
        _made.append(bpe.PrefixEncoder(bpe.read_ranks(MULTI)))
    return _made[0]


def test_edits_stop_where_the_old_tokens_resume():
    r = random.Random(8)
    text = "".join(r.choice("abcdeghinorst") for _ in range(5000)).encode()
    piece, appended = bpe.LongPiece(_encoder(), text), []
    append = piece.append
    piece.append = lambda more: (appended.append(len(more)), append(more))
    piece.edit(100, 3, b"xyz")
    assert sum(appended) < 1000 and piece.ids() == bpe.LongPiece(_encoder(), bytes(piece.bytes)).ids()


def test_query_3_equals_tiktoken_over_the_table(spark, reference):
    texts = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = bpe.op3_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        e = reference.encode_ordinary(texts[r.doc_id])
        want = len(e), hashlib.sha256(struct.pack(f"<{len(e)}I", *e)).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want


def test_small_caches_change_nothing(reference):
    e = bpe.PrefixEncoder(bpe.read_ranks(MULTI), cache=5)
    for t in some_texts(200):
        for piece in bpe.regex.findall(P.PATTERN, t):
            assert e.encode(piece.encode()) == reference.encode_ordinary(piece)


def test_query_3(spark, reference):
    docs = spark.createDataFrame([*enumerate(ODD), (0, "again"), (None, "no id")], "doc_id long, text string").selectExpr("*", "'x' as ids_sha256", "1 as n_tokens")
    rows = bpe.tokenize(docs, MULTI, P.PATTERN).collect()
    assert len(rows) == len(ODD) + 2
    want = {(i, t) for i, t in [*enumerate(ODD), (0, "again"), (None, "no id")]}
    for i, t in want:
        e = reference.encode_ordinary(t or "")
        b = struct.pack(f"<{len(e)}I", *e)
        assert any((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) == (i, len(e), hashlib.sha256(b).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for r in rows)
    assert bpe.tokenize(docs.where("false"), MULTI, P.PATTERN).count() == 0
    assert bpe.tokenize(docs.where("doc_id = 8"), MULTI, P.PATTERN, keep_ids=True).first().ids == reference.encode_ordinary(ODD[8])


def test_library_cache_equals_the_library(library):
    c = tokenfile.library(BYTE)
    texts = [*some_texts(), *(x for x in ODD if x)]
    for t, got in zip(texts, c.ids(pa.array(texts)), strict=True):
        assert got.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300))
def test_words_round_trip(values):
    a = np.array(values, np.uint64)
    assert (tokenfile.unpack(tokenfile.pack(a), len(a)) == a).all()


def test_runs_of_small_ids_are_dense():
    assert len(tokenfile.pack(np.zeros(6000, np.uint64))) == 100


def test_files_of_many_blocks():
    g = np.random.default_rng(1)
    docs = [(None if i == 2 else i, g.integers(0, 60_000, int(n), dtype=np.uint32)) for i, n in enumerate([0, 5, 70_000, 1, 200_000, 0])]
    w = tokenfile.Writer()
    for d in docs:
        w.add(*d)
    got = list(tokenfile.read_file(w.file()))
    assert [g[0] for g in got] == [d[0] for d in docs]
    assert all((a[1] == b[2]).all() and len(a[1]) == len(b[2]) for a, b in zip(docs, got, strict=True))
    with pytest.raises(ValueError):
        list(tokenfile.read_file(b"no token file at all........................................"))


def expected(rows, library):
    out, at = [], 0
    for i, t in rows:
        e = library.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, at, len(e), zlib.crc32(struct.pack(f"<{len(e)}I", *e))))
        at += len(e)
    return out


def test_query_7(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = tokenfile.op7_token_files(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected([tuple(r) for r in rows], library)


def test_token_files_edge_cases(spark, library, tmp_path):
    rows = [*enumerate(ODD), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as start")
    m = tokenfile.write_token_files(docs, BYTE, f"file://{tmp_path}/t", file_ids=50)
    assert m.count() > 1
    got = sorted((tuple(r) for r in tokenfile.read_token_files(m).collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == expected([(None, "no id"), *enumerate(ODD)], library)
    empty = tokenfile.write_token_files(docs.where("false"), BYTE, f"file://{tmp_path}/e")
    assert tokenfile.read_token_files(empty).count() == 0
    twice = tokenfile.write_token_files(spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "doc_id long, text string"), BYTE, f"file://{tmp_path}/w")
    assert sorted(r.start for r in tokenfile.read_token_files(twice).collect()) == [0, 2, 4]
