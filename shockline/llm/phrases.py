"""Phrase collocations by Apriori level-wise passes (operator 13).

Pass k counts phrases of k words. From the second pass on a phrase is only counted where both phrases of k - 1
words in it are frequent: pass k - 1 gives a bitmap with a bit for the hash of each of its frequent phrases, which
is broadcast. The bitmap has the same number of bits at every size of the input. Phrases that share
a bit by chance are counted too and go by their counts, so the bitmap decides the work and never the result.
Counts, cuts and scores come from the level tables by joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_input, dropped, slices, table, written

#: Bytes of text that are counted at a time in a task: the arrays of a step take some 25 times as many.
STEP = 3 << 20
#: Bits of the bitmap of a level (8 MB), a power of two.
BITS = 1 << 26
#: Bits in a row of Spark's bitmap functions.
ROW_BITS = 32768
WORDS, LEAST, KEPT, SCALE, COVER = 4, 30, 2000, 2_000_000, 80
#: What ends a piece of text, and what else ends a word.
ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)] = 1
KIND[list(ENDS)] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ODD = np.uint64(0x9E3779B97F4A7C15)


def fold(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The hash of a sequence from that of all but its last part and that of the last."""
    return ((h ^ (h >> np.uint64(29))) * ODD) + more


def hashes(strings: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, strings.to_pylist()), np.uint64, len(strings))


class Words:
    """The words of some texts in order, as numbers: `word` into `vocabulary`, `lang` into `langs`."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]  # positions are 32-bit numbers: 2 GB, the most a string can have
        kind = KIND[raw]
        begins = np.zeros(len(raw) + 1, bool)
        begins[offsets] = True
        letter = kind == 0
        starts = np.flatnonzero(letter & (begins[:-1] | ~np.r_[False, letter[:-1]]))
        at = (np.cumsum(letter, dtype=np.int32) - letter)[starts]
        kept = LOWER[raw[letter]]
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(at, len(kept)).astype(np.int64)), pa.py_buffer(kept)).dictionary_encode()
        self.vocabulary, self.word = coded.dictionary, coded.indices.to_numpy()
        #: Equal for words of one piece.
        self.piece = np.cumsum(begins[:-1] | (kind == 2), dtype=np.int32)[starts]
        named = langs.dictionary_encode()
        self.langs, self.lang = named.dictionary, named.indices.to_numpy()[np.searchsorted(offsets, starts, "right") - 1]

    def hashed(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each word, and of the language and the word."""
        own = hashes(self.vocabulary)[self.word]
        return own, fold(hashes(self.langs)[self.lang], own)


def bits_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def candidates(w: Words, k: int, bitmap: np.ndarray | None, bits: int) -> np.ndarray:
    """Positions of words at which a phrase of k words begins that both its phrases of k - 1 words allow."""
    n = len(w.word) - k + 1
    if k == 1 or n < 1:
        return np.arange(max(n, 0))
    own, h = w.hashed()
    for j in range(1, k - 1):
        h = fold(h[:-1], own[j:])
    bit = bits_of(h, bits)
    frequent = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 != 0
    return np.flatnonzero(frequent[:-1] & frequent[1:] & (w.piece[:n] == w.piece[k - 1 :]))


def counted(w: Words, at: np.ndarray, k: int) -> pa.RecordBatch:
    """lang, phrase, f of the phrases of k words that begin at the positions."""
    ids = w.lang[at].astype(np.int64)
    for j in range(k):
        ids, _ = pd.factorize(ids * len(w.vocabulary) + w.word[at + j])
    f = np.bincount(ids)
    where = np.empty(len(f), np.int64)
    where[ids] = at
    words = [w.vocabulary.take(pa.array(w.word[where + j])) for j in range(k)]
    phrase = words[0] if k == 1 else pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))
    return pa.RecordBatch.from_arrays([w.langs.take(pa.array(w.lang[where])).cast(pa.string()), phrase.cast(pa.string()), pa.array(f, pa.int64())], names=["lang", "phrase", "f"])


def level(docs: DataFrame, k: int, least: int, bitmap: bytes | None, bits: int) -> DataFrame:
    """lang, phrase, f of the phrases of k words with f >= least; for k = 1 also a row of null phrase with all words of the language."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if shared.value is None else np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for a, b in slices(batch["text"], STEP):
                w = Words(batch["text"].slice(a, b - a), batch["lang"].slice(a, b - a))
                if len(at := candidates(w, k, known, bits)):
                    yield counted(w, at, k)
                    del at
                if k == 1:
                    all_words = np.bincount(w.lang, minlength=len(w.langs))
                    yield pa.RecordBatch.from_arrays([w.langs.cast(pa.string()), pa.nulls(len(w.langs), pa.string()), pa.array(all_words, pa.int64())], names=["lang", "phrase", "f"])

    made = docs.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return written(made.where(F.col("phrase").isNull() | (F.col("f") >= least)), f"level{k}")


def bitmap_of(frequent: DataFrame, k: int, bits: int) -> bytes:
    """The bitmap of a level's phrases: bits / 8 bytes, put together from rows that Spark's bitmap functions aggregate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.split_pattern(batch["phrase"], " ").flatten().dictionary_encode()
            own = hashes(words.dictionary)[words.indices.to_numpy()].reshape(-1, k) if len(batch) else np.empty((0, k), np.uint64)
            langs = batch["lang"].dictionary_encode()
            h = reduce(fold, own.T, hashes(langs.dictionary)[langs.indices.to_numpy()])
            yield pa.RecordBatch.from_arrays([pa.array(bits_of(h, bits) + 1)], names=["bit"])

    numbers = frequent.where("phrase is not null").select("lang", "phrase").mapInArrow(run, "bit long")
    rows = numbers.groupBy(F.bitmap_bucket_number("bit").alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    out = bytearray(max(bits, ROW_BITS) // 8)
    for row, part in rows.collect():  # bits / 32768 rows of 4 KB at most
        at = (row - 1) * ROW_BITS // 8
        out[at : at + ROW_BITS // 8] = part
    return bytes(out)


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, kept: int = KEPT, cover: int = COVER, scale: int = SCALE, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `kept` best phrases of 2 to `words` words of each language.

    docs: lang and text; further columns are ignored. A null lang is `und`; null, empty and blank texts have no words. Rows
    that repeat count as often as they occur. Texts of any length are counted whole, `STEP` bytes and at least one
    text at a time. Ties go as the contract says: cuts to the fewest first words, ranks by a, then by the phrase's bytes.
    No text or no frequent phrase: no rows. Sums of counts are longs; products are decimals of 38 digits.
    """
    rows = as_input(docs, {"lang": "string", "text": "string"}).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    levels, bitmap = [], None
    for k in range(1, words + 1):
        levels.append(level(rows, k, least, bitmap, bits))
        if k < words:
            bitmap = bitmap_of(levels[-1], k, bits)
    one, *more = levels
    n = one.where("phrase is null").select("lang", F.col("f").alias("n"))
    phrases = reduce(DataFrame.unionByName, (t.withColumn("k", F.lit(k)) for k, t in enumerate(levels, 1))).where("phrase is not null")
    found = phrases.where("k > 1").withColumnRenamed("f", "a")

    inner = found.where("k > 2").withColumn("w", F.split("phrase", " ")).select("lang", "a", "w", "k", F.explode(F.expr("sequence(2, k - 1)")).alias("size"))
    inner = inner.select("lang", "a", F.expr("explode(transform(sequence(1, k - size + 1), i -> array_join(slice(w, i, size), ' ')))").alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    whole = found.join(inner, ["lang", "phrase"], "left").where(F.expr(f"not coalesce(cast(100 as decimal(3,0)) * cast(longer as decimal(19,0)) >= cast({int(cover)} as decimal(10,0)) * cast(a as decimal(19,0)), false)"))

    cuts = whole.select("lang", "phrase", "a", "k", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', cut)")).withColumn("rest", F.expr("substring_index(phrase, ' ', cut - k)"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(phrases.where(f"k < {words}").select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    score = F.expr(f"cast({int(scale)} as decimal(10,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "cut", "l", "r").alias("c")).groupBy("lang", "phrase", "a").agg(F.min("c").alias("c"))

    # Scores are at most scale / 2, so a histogram of a language has few bins; what is below the bin of the last kept phrase isn't sorted.
    best = written(best, "scored_phrases")
    scored = best.withColumn("bin", F.expr(f"cast(c.score div {max(1, int(scale) // 2000)} as int)"))
    down = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1))
    bins = scored.groupBy("lang", "bin").agg(F.count("*").alias("n")).withColumn("above", F.coalesce(down, F.lit(0))).where(F.col("above") < kept)
    last = written(bins.groupBy("lang").agg(F.min("bin").alias("last")), "last_bins")  # a row a language: its size is known before the join
    order = [F.desc("c.score"), F.desc("a"), F.asc("phrase")]
    top = scored.join(last, "lang").where("bin >= last")
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= kept)
    out = top.join(n, "lang").select("lang", "rank", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
    out = written(out.withColumn("rank", F.col("rank").cast("long")), "collocations")
    dropped(best, last, *levels)
    return out


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM worded, (SELECT unnest([1, 2, 3, 4]) AS k) ks WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 30
), inside AS (
  SELECT lang, max(a) AS longer, phrase FROM (
    SELECT lang, a, unnest([array_to_string(w[i : i + s - 1], ' ') FOR i IN range(1, k - s + 2)]) AS phrase
    FROM cand, (SELECT unnest([2, 3]) AS s) ss WHERE s < k
  ) GROUP BY lang, phrase
), stay AS (
  SELECT c.* FROM cand c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE NOT coalesce(100 * CAST(i.longer AS HUGEINT) >= 80 * CAST(c.a AS HUGEINT), false)
), cut AS (
  SELECT s.lang, s.phrase, s.a, j, l.f AS l, r.f AS r, (2000000 * CAST(s.a AS HUGEINT)) // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM stay) s
  JOIN f l ON l.lang = s.lang AND l.phrase = array_to_string(s.w[1 : j], ' ')
  JOIN f r ON r.lang = s.lang AND r.phrase = array_to_string(s.w[j + 1 : s.k], ' ')
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best b JOIN n ON n.lang = b.lang
QUALIFY rank <= 2000
"""
