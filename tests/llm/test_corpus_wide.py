"""Operators 11 to 13 against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from shockline.llm import packing, phrases, whitening

from ..conftest import SF
from ..test_oracle import plain


def some_docs(n=400, seed=1):
    r = random.Random(seed)
    vocabulary = ["New", "york", "city", "Hall", "of", "the", "Éa", "中文", "x\x0by", "a\tb", "  z "]
    made = [" ".join(r.choice(vocabulary) + r.choice(["", "", "", ".", ", ", "\n"]) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return [(i, r.choice(["en", "en", "de", None, "und", ""]), t) for i, t in enumerate(made)] + [(None, None, None), (7, "en", ""), (7, "en", "new york " * 5000), (8, None, " \t ")]


def brute_collocations(rows, least, kept, cover):
    f, n = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    covered = {(g[0], *g[i:j]) for g, a in found.items() for i in range(1, len(g)) for j in range(i + 2, len(g) + 1) if j - i < len(g) - 1 and (g[0], *g[i:j]) in found and 100 * a >= cover * found[(g[0], *g[i:j])]}
    out = []
    for g, a in found.items():
        if g not in covered:
            cuts = [(2_000_000 * a // (f[g[:j]] + f[(g[0], *g[j:])]), j, f[g[:j]], f[(g[0], *g[j:])]) for j in range(2, len(g))]
            score, _, left, right = min(cuts)
            out.append((g[0], -score, -a, " ".join(g[1:]).encode(), left, right))
    out.sort()
    rank = Counter()
    for lang, score, a, phrase, left, right in out:
        rank[lang] += 1
        if rank[lang] <= kept:
            yield (lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score)


@pytest.mark.parametrize("bits", [phrases.BITS, 64])
def test_collocations_equal_brute_force(spark, bits):
    rows = some_docs()
    docs = spark.createDataFrame([(i, lang, t, 1) for i, lang, t in rows], "doc_id long, lang string, text string, `rank` int").repartition(3)
    got = [tuple(r) for r in phrases.collocations(docs, least=5, kept=40, bits=bits).collect()]
    want = list(brute_collocations(rows, 5, 40, 80))
    assert len(want) > 60 and sorted(got) == sorted(want)


def test_collocations_of_nothing(spark):
    schema = "lang string, text string"
    for rows in ([], [(None, None), ("en", ""), ("en", " ,\t")], [("en", "one two three")]):
        out = phrases.collocations(spark.createDataFrame(rows, schema))
        assert out.count() == 0 and [c for c, _ in out.dtypes] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_query_13_equals_sql(spark, duck):
    got, want = plain(phrases.op13_phrases(spark, SF).toPandas()), plain(duck.sql(phrases.ORACLE).df())
    assert len(got) and got.equals(want)


P = pytest.importorskip("public_tokenizers")
WORD_BPE = P.path("word_bpe_49k.json")
ODD = ["", " ", "a  b\n\n c\td", "don't WE'LL 1 22", "x" * 3000, "e\u0301 \u0301e\n\u0301", "ß é ñ 中文 𝄞 İ Σ", "\x1c\x85\u2003\u00a0a\u00a0b", "<|endoftext|> <|startoftext|>", None, "word.\nNext", "\r\n\x0b"]


@pytest.fixture(scope="module")
def word_bpe():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_BPE)
    t.encode_special_tokens = True
    return t


def test_words_are_encoded_as_by_the_library(word_bpe):
    r = random.Random(5)
    texts = [*ODD, *("".join(r.choice("abS't \n\t,.1é中\u0301\x1c\xa0!<|>") for _ in range(r.randint(0, 25))) for _ in range(2000))]
    every, ends = packing.WordIds(WORD_BPE, 50).ids(pa.array(texts))
    for k, t in enumerate(texts):
        assert every[ends[k] : ends[k + 1]].tolist() == word_bpe.encode(t or "", add_special_tokens=False).ids, repr(t)


def check_packing(rows, docs, word_bpe, capacity=4096):
    """rows: of pack(keep_ids); docs: (doc_id, text). Each id once, sequences gapless, padding as stated."""
    want, got, sequences = Counter(), Counter(), defaultdict(list)
    for doc_id, text in docs:
        want[doc_id, tuple([*word_bpe.encode(text or "", add_special_tokens=False).ids, 2])] += 1
    pieces = defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) >= 1 and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for (doc_id, total), own in pieces.items():
        starts = defaultdict(list)
        for r in own:
            starts[r["start"]].append(tuple(r["ids"]))
        assert all(len(set(v)) == 1 for v in starts.values()) or doc_id is None
        whole = tuple(i for s in sorted(starts) for i in starts[s][0])
        assert len(whole) == total
        got[doc_id, whole] += len(starts[0])
    assert got == want
    padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padded += 0 if at & (at - 1) == 0 else capacity - at
    return len(sequences), padded


def test_packing_is_whole_and_tight(spark, word_bpe):
    r = random.Random(9)
    docs = [(i, " ".join(r.choice(["a", "stormy", "Xqzjk", "."]) for _ in range(int(r.paretovariate(0.7)) % 9000))) for i in range(300)]
    docs += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "null id")] + [(5000, "same text")] * 3
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, `length` int, ids int").repartition(3)
    out = packing.pack(frame, WORD_BPE, keep_ids=True)
    n, padded = check_packing(out.collect(), docs, word_bpe)
    assert padded <= n
    total = packing.padding(out).first()
    assert (total["sequences"], total["padded"]) == (n, padded)
    small = packing.pack(frame, WORD_BPE, capacity=64, slack=2, keep_ids=True)
    n, padded = check_packing(small.collect(), docs, word_bpe, 64)
    assert padded <= 2 * n


def test_full_bins_have_their_class_s_number_of_pieces():
    of = packing.classes(4096, 1)
    assert list(of.values())[:12] == [1, 2, 3, 4, 5, 7, 8, 9, 13, 15, 16, 21] and all(4095 <= s * k <= 4096 for s, k in of.items())
    bins = packing.Bins(4096, 1, 0)
    r = random.Random(2)
    for i in range(500):
        bins.add(i, np.zeros(r.randint(1, 9000), np.uint32))
    by = defaultdict(list)
    for row in bins.rows:
        by[row[5]].append(row[2])
    assert all(len(set(sizes)) == 1 and len(sizes) == of[sizes[0]] for sizes in by.values())


def test_packing_of_nothing(spark):
    out = packing.pack(spark.createDataFrame([], "doc_id long, text string"), WORD_BPE)
    assert out.count() == 0 and packing.padding(out).first()["sequences"] == 0


def test_query_12_is_whole(spark, word_bpe):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    kept = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), WORD_BPE, keep_ids=True)
    n, padded = check_packing(kept.collect(), docs, word_bpe)
    assert padded <= n
    assert sorted(packing.op12_packing(spark, SF).collect()) == sorted(kept.drop("ids").collect())


def brute_whitening(rows, scale=1024, offset=100_000):
    """Exact n, S and n * x - S of the clean rows of one length, and the covariance in doubles."""
    clean = [(i, [math.floor(Fraction(c) * scale) + offset for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(clean), len(clean[0][1])
    s = [sum(x[j] for _, x in clean) for j in range(d)]
    z = [(i, [n * x[j] - s[j] for j in range(d)]) for i, x in clean]
    cov = np.array([[float(Fraction(sum(a[j] * a[k] for _, a in z), n**3)) for k in range(d)] for j in range(d)])
    return n, z, cov


def check_whitening(out, rows, components=8):
    n, z, cov = brute_whitening(rows)
    e = np.linalg.eigvalsh(cov)[::-1]
    by = defaultdict(dict)
    assert len(out) == len(z) * components
    for r in out:
        assert r["n"] == n and abs(r["explained"] / (e[r["component"] - 1] / e.sum()) - 1) < 1e-9
        by[r["vec_id"]][r["component"]] = r
    want = {i: sum(x * x for x in a) for i, a in z}
    assert {i: int(r[1]["deviation"]) for i, r in by.items()} == want
    y = np.array([[by[i][c]["whitened"] for c in range(1, components + 1)] for i, _ in z])
    x = np.array([[v / n for v in a] for _, a in z])
    # a component is an eigenvector: x whitened along it has covariance e * u with x
    for c in range(components):
        u = (x * y[:, [c]]).mean(axis=0) / math.sqrt(e[c])
        assert abs(np.linalg.norm(u) - 1) < 1e-9 and np.abs(cov @ u - e[c] * u).max() < 1e-9 * e[0]
        assert np.abs(x @ u / math.sqrt(e[c]) - y[:, c]).max() < 1e-9
    centred = y - y.mean(axis=0)
    worst = np.abs(centred.T @ centred / n - np.eye(components)).max()
    assert worst < 1e-9 and len({r["identity_error"] for r in out}) == 1 and abs(out[0]["identity_error"] - worst) < 1e-12


def some_vectors(n=300, d=12):
    r = np.random.default_rng(4)
    v = (r.normal(size=(n, d)) * np.linspace(0.2, 5, d) @ r.normal(size=(d, d)) + 3).tolist()
    return [(i, x) for i, x in enumerate(v)]


SCHEMA_11 = "vec_id long, embedding array<double>, n int, d int, v string, component int"


def frame_11(spark, rows):
    return spark.createDataFrame([(i, x, 1, 2, "x", 3) for i, x in rows], SCHEMA_11).repartition(3)


@pytest.mark.parametrize("model_bytes", [whitening.MODEL_BYTES, -1])
def test_whitening_equals_fractions(spark, monkeypatch, model_bytes):
    monkeypatch.setattr(whitening, "MODEL_BYTES", model_bytes)
    bad = [(900, None), (901, []), (902, [None] * 12), (903, [1.0] * 11 + [math.inf]), (904, [math.nan] + [0.0] * 11)]
    rows = some_vectors() + bad
    check_whitening(whitening.whiten(frame_11(spark, rows)).collect(), rows)


def test_whitening_is_exact_for_huge_entries_and_any_shift(spark, monkeypatch):
    rows = some_vectors(60, 9)
    huge = [(i, [x * 10.0 ** (8 * (j % 5)) for j, x in enumerate(v)]) for i, v in rows]
    n, z, _ = brute_whitening(huge)
    want = {i: sum(x * x for x in a) for i, a in z}
    monkeypatch.setattr(whitening, "BLOCKS", 1)
    out = whitening.whiten(frame_11(spark, huge), components=3, shift=-(10**30)).collect()
    assert {r["vec_id"]: int(r["deviation"]) for r in out} == want and max(want.values()) > 2**63
    check_whitening(whitening.whiten(frame_11(spark, rows), shift=12345).collect(), rows)


def test_whitening_of_repeats_lengths_and_constants(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.0]), (4, [7.0]), (5, [1.0, 1.0, 1.0]), (6, [1.0, 1.0, 1.0])]
    out = whitening.whiten(frame_11(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], r["explained"], round(abs(r["whitened"]), 6)) for r in out) == [(0, 1, 3, 1.0, 1.414214), (1, 1, 3, 1.0, 0.707107), (1, 1, 3, 1.0, 0.707107)]
    assert whitening.whiten(frame_11(spark, [])).count() == 0


def test_products_and_squares_are_exact():
    r = random.Random(8)
    for size in (10, 1 << 19, 1 << 45, 1 << 90):
        a = np.array([[r.randint(-size, size) for _ in range(5)] for _ in range(40)], object)
        whole = sum(m.astype(object) << bits for bits, m in whitening.products(a))
        assert (whole == a.T.dot(a)).all() and (whitening.squares(a) == (a * a).sum(axis=1)).all()


def test_query_11_equals_fractions(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    out = whitening.op11_whitening(spark, SF)
    assert dict(out.dtypes)["deviation"] == "bigint" and dict(out.dtypes)["n"] == "bigint" and dict(out.dtypes)["component"] == "int"
    check_whitening(out.collect(), rows)
