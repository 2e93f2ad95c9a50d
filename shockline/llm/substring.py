"""Substring dedup by paragraph MinHash banding (operator 1).

Paragraphs are cut in two ways, and all of them are compared over all documents.

Lines of at least 40 words get a MinHash of their five-word shingles in 8 bands of 3 rows: at a Jaccard
similarity of 0.8 a pair collides in some band with a probability of 0.997. Lines that collide are verified
by their exact Jaccard similarity, and the components of the verified links are classes.

Passages that stand within other text, whatever lines they are part of, are found by content-defined
paragraphs of 20 words: of the 31 windows that begin at any 31 words in a row the one of the smallest hash is
taken, so any 50 words in a row that two documents share hold a common one. One changed word takes such a
paragraph far below 0.8 (11 of 21 shingles), so its tuned banding is a single band over all rows: equality.
Paragraphs that follow one another as they do at their class's first occurrence are a run, which is extended
word by word to both sides, as far as the first occurrence goes on equally.

A run of repeated paragraphs of at least 50 words is a repeated passage; each class keeps its first occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, as_input, block_pairs, connected_components, runs, table, written

SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 8, 3
LEAST_WORDS, PARAGRAPH_WORDS = 50, 40
BLOCK = 256
#: Words of a content-defined paragraph, windows of which one is taken (20 + 31 - 1 words hold one), different words it needs.
SEED, WINNOW, VARIED = 20, 31, 10
#: Words to which a run is extended on a side, and words that may lie between two parts of a run.
SIDE, GAP = WINNOW - 1, WINNOW - SEED
#: Bytes of text that are worked on at a time. A longer word has a hash of its own kind.
STEP = 1 << 20
MAX = np.uint64(2**64 - 1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_VALUE = np.array([xxhash.xxh64_intdigest(f"byte {i}") for i in range(256)], np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWER = np.cumprod(np.r_[np.uint64(1), np.full(STEP, _BASE, np.uint64)], dtype=np.uint64)
_INVERSE = np.cumprod(np.r_[np.uint64(1), np.full(STEP, pow(_BASE, -1, 2**64), np.uint64)], dtype=np.uint64)
_SEEDS = np.array([xxhash.xxh64_intdigest(f"minhash {i}") | 1 for i in range(2 * BANDS * ROWS)], np.uint64).reshape(2, -1)
UNITS = pa.schema([
    ("doc_id", pa.int64()), ("h", pa.int64()), ("words16", pa.binary()), ("s_at", pa.list_(pa.int32())), ("s_uid", pa.list_(pa.int64())),
    ("p_at", pa.list_(pa.int32())), ("p_words", pa.list_(pa.int32())), ("p_uid", pa.list_(pa.int64())), ("p_bands", pa.list_(pa.int64())),
])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's bytes: a 64-bit hash and the place of each word, and the number of the line it is in."""
    solid = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.r_[False, solid, False].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    h = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + STEP, "right")))
        if ends[at] - base > STEP:
            h[at] = xxhash.xxh64_intdigest(data[base : ends[at]].tobytes())
        else:
            a, b = starts[at:to] - base, ends[at:to] - base
            total = np.zeros(b[-1] + 1, np.uint64)
            np.cumsum(_VALUE[data[base : base + b[-1]]] * _POWER[: b[-1]], out=total[1:])
            h[at:to] = mixed((total[b] - total[a]) * _INVERSE[a])
        at = to
    return h, starts, np.searchsorted(np.flatnonzero(data == 10), starts)


def windowed(x: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """The best of each `size` values in a row, at the first one's place; the last size - 1 places are left out."""
    width = 1
    while 2 * width <= size:
        x, width = best(x[:-width], x[width:]), 2 * width
    return best(x[: len(x) - (size - width)], x[size - width :]) if width < size else x


def sums(values: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each run of words from its words' hashes, in order."""
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    power = _POWER[at & 4095] ^ (at >> 12).astype(np.uint64)
    cut = np.cumsum(length) - length
    return mixed(np.add.reduceat(mixed(values[np.repeat(starts, length) + at]) * power, cut) + length.astype(np.uint64)) if len(starts) else np.empty(0, np.uint64)


def shingles(h: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles of a run of words."""
    n, m = len(h) - SHINGLE + 1, mixed(h)
    return mixed(sum((m[k : k + n] * _POWER[k + 1] for k in range(SHINGLE)), np.zeros(max(n, 0), np.uint64))) if n > 0 else np.empty(0, np.uint64)


def bands(s: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The band keys of paragraphs, whose shingles are those at starts, length of them."""
    if not len(starts):
        return np.empty((0, BANDS), np.uint64)
    cut = np.cumsum(length) - length
    s = s[np.arange(int(length.sum())) + np.repeat(starts - cut, length)]
    least = np.stack([np.minimum.reduceat(s * a + b, cut) for a, b in zip(*_SEEDS, strict=True)], axis=1).reshape(len(starts), BANDS, ROWS)
    return mixed((mixed(least) * _POWER[1 : ROWS + 1]).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def found_in(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Words, content-defined paragraphs (seeds) and long lines of texts, as flat arrays with counts for each text."""
    n = len(texts)
    h, place, line = word_hashes(np.frombuffer(b"\n".join(texts), np.uint8))
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(place, begin)
    size = np.diff(first)
    own = np.repeat(np.arange(n), size)
    # the texts' words one after the other, with gaps between the texts that no window reaches over
    pos, edge = np.arange(len(h)) + WINNOW * own, first[:-1] + WINNOW * np.arange(n)
    stop = edge + size
    padded = np.zeros(len(h) + WINNOW * n + SEED + 2 * WINNOW, np.uint64)
    padded[pos] = h
    s = g = shingles(padded)
    for step in (SHINGLE, 2 * SHINGLE):
        g = mixed(g[:-step] * _POWER[1] + mixed(g[step:]))
    whole = pos[pos + SEED <= stop[own]]
    value = np.full(len(padded), MAX, np.uint64)
    value[whole] = g[whole]
    least = np.zeros(len(padded), np.uint64)
    asked = np.union1d(pos[pos + SEED + WINNOW - 1 <= stop[own]], edge[size >= SEED])
    least[asked] = windowed(value, WINNOW, np.minimum)[asked]
    chosen = windowed(np.r_[np.zeros(WINNOW - 1, np.uint64), least], WINNOW, np.maximum) == value
    at = np.flatnonzero(chosen & (value != MAX))
    different = np.sort(padded[at[:, None] + np.arange(SEED)], axis=1)
    at = at[(different[:, 1:] != different[:, :-1]).sum(axis=1) + 1 >= VARIED]
    s_own = np.searchsorted(edge, at, "right") - 1
    # long lines
    p = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(h) else np.empty(0, np.int64)
    p_size = np.diff(np.r_[p, len(h)]) if len(p) else p
    p, p_size = p[p_size >= PARAGRAPH_WORDS], p_size[p_size >= PARAGRAPH_WORDS]
    return {
        "size": size, "words": (mixed(h) >> np.uint64(48)).astype("<u2"),
        "s_count": np.bincount(s_own, minlength=n), "s_at": at - edge[s_own], "s_uid": g[at],
        "p_count": np.bincount(own[p], minlength=n), "p_at": p - first[own[p]], "p_words": p_size, "p_uid": sums(h, p, p_size), "p_bands": bands(s, pos[p], p_size - SHINGLE + 1),
    }


def all_units(docs: DataFrame) -> DataFrame:
    """For each row with words: its key (doc_id, h), 16 bits of each word, its seeds, its long lines and their bands."""

    def rows(ids: list, hashes: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        x = found_in(texts)

        def lists(values: np.ndarray, kind: pa.DataType, count: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), pa.array(values.ravel().view(np.int64) if kind == pa.int64() else values, kind))

        ends = pa.array(2 * np.r_[0, np.cumsum(x["size"])], pa.int32())
        words = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, ends.buffers()[1], pa.py_buffer(x["words"].tobytes())])
        cut = pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), words, lists(x["s_at"], pa.int32(), x["s_count"]), lists(x["s_uid"], pa.int64(), x["s_count"]),
            lists(x["p_at"], pa.int32(), x["p_count"]), lists(x["p_words"], pa.int32(), x["p_count"]), lists(x["p_uid"], pa.int64(), x["p_count"]), lists(x["p_bands"], pa.int64(), BANDS * x["p_count"]),
        ], schema=UNITS)
        yield cut.filter(pa.array(x["size"] > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts, at, held = batch["doc_id"].to_pylist(), batch["h"].to_pylist(), pc.ascii_lower(batch["text"]).cast(pa.binary()), 0, 0
            size = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for k, n in enumerate(size):
                held += n
                if held >= STEP or k == len(size) - 1:
                    yield from rows(ids[at : k + 1], hashes[at : k + 1], [t or b"" for t in texts.slice(at, k + 1 - at).to_pylist()])
                    at, held = k + 1, 0

    rows_in = as_input(docs, {"doc_id": "long", "text": "string"}).where("doc_id is not null and text <> ''")
    schema = "doc_id long, h long, words16 binary, s_at array<int>, s_uid array<long>, p_at array<int>, p_words array<int>, p_uid array<long>, p_bands array<long>"
    return rows_in.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, schema)


def jaccard_links(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all sets connected by similarities of at least `least`; fewer links than sets."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    common = np.zeros((n, n), np.float32)
    if n <= 16:
        each = [frozenset(s.tolist()) for s in sets]
        for i in range(n):
            for j in range(i, n):
                common[i, j] = common[j, i] = len(each[i] & each[j])
    else:
        owner = np.repeat(np.arange(n), size)
        _, place = np.unique(np.concatenate(sets), return_inverse=True)
        for at in range(0, int(place.max(initial=-1)) + 1, 4096):
            own = (place >= at) & (place < at + 4096)
            m = np.zeros((n, 4096), np.float32)
            m[owner[own], place[own] - at] = 1
            common += m @ m.T
    near = common >= least * (size[:, None] + size - common) - 1e-6
    free, a, b = np.ones(n, bool), [], []
    for i in range(n):
        if free[i]:
            free[i], todo = False, [i]
            while todo:
                got = np.flatnonzero(near[todo.pop()] & free)
                free[got] = False
                a += [i] * len(got)
                b += got.tolist()
                todo += got.tolist()
    return np.array(a, int), np.array(b, int)


def band_members(paragraphs: DataFrame) -> DataFrame:
    """uid, key: the distinct lines that share a band with another one."""
    keys = paragraphs.select("uid", F.explode("bands").alias("key"))
    crowded = written(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "crowded_bands")
    return written(keys.join(crowded, "key"), "band_members")


def paragraph_links(members: DataFrame, words: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """src, dst: verified links between the uids of different lines that collide in a band. words: uid, words16."""
    dealt = block_pairs(members, ["key"], "uid", block).join(words, "uid").select("key", "lo", "hi", "uid", "words16")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bounds, rows in runs(batches, ["key", "lo", "hi"]):
            uid, raw, out = rows["uid"].to_numpy(), rows["words16"].to_list(), []
            size = np.array([len(x) // 2 for x in raw])
            every = shingles(np.frombuffer(b"".join(raw), "<u2").astype(np.uint64))  # those over two lines are left out below
            start = np.cumsum(size) - size
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a > 1:
                    i, j = jaccard_links([np.unique(every[start[k] : start[k] + size[k] - SHINGLE + 1]) for k in range(a, b)], similarity)
                    out.append(pd.DataFrame({"src": uid[a + i], "dst": uid[a + j]}))
            if out:
                yield pd.concat(out)

    return dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInPandas(verify, "src long, dst long")


def seed_runs(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs of seeds of classes that span several documents, and the classes' first occurrences.

    Runs: doc_id, h, lo, hi (words), class_id, f_doc, f_h, shift (from a place in the first occurrence to the one here).
    """
    seeds = every.select("doc_id", "h", F.explode(F.arrays_zip(F.col("s_at").alias("start"), F.col("s_uid").alias("uid"))).alias("x")).select("doc_id", "h", "x.start", "x.uid")
    classes = seeds.groupBy("uid").agg(F.min("doc_id").alias("f_doc"), F.max("doc_id").alias("top")).where("f_doc < top").select("uid", "f_doc")
    # each step is written, so that a join has exchanges of its own and a uid that very many documents share is split
    shared = written(seeds.join(written(classes, "seed_classes"), "uid"), "seeds_shared")
    firsts = shared.where("doc_id = f_doc").groupBy("uid").agg(F.min(F.struct("h", "start")).alias("f"), F.first("f_doc").alias("f_doc"))
    firsts = written(firsts.select("uid", "f_doc", F.col("f.h").alias("f_h"), F.col("f.start").alias("f_start")), "seed_firsts")
    others = shared.drop("f_doc").join(firsts, "uid").where("doc_id <> f_doc or h <> f_h or start <> f_start").withColumn("shift", F.col("start") - F.col("f_start"))
    by_doc = Window.partitionBy("doc_id", "h").orderBy("start")
    before = F.lag(F.struct("f_doc", "f_h", "shift", (F.col("start") + SEED + GAP).alias("reach"))).over(by_doc)
    others = others.withColumn("_b", before)
    on = (F.col("_b.f_doc") == F.col("f_doc")) & (F.col("_b.f_h") == F.col("f_h")) & (F.col("_b.shift") == F.col("shift")) & (F.col("start") <= F.col("_b.reach"))
    others = others.withColumn("run", F.sum(F.when(on, 0).otherwise(1)).over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    found = others.groupBy("doc_id", "h", "run", "f_doc", "f_h", "shift").agg(F.min("start").alias("lo"), (F.max("start") + SEED).alias("hi"), F.min("uid").alias("class_id")).drop("run")
    return written(found, "seed_runs"), firsts


def words_at(start: Column, stop: Column) -> Column:
    """The 16-bit words [start, stop) of a document, as far as it has them."""
    start = F.greatest(start, F.lit(0))
    return F.substring("words16", 2 * start + 1, F.greatest(2 * (stop - start), F.lit(0)))


def equal_words(a: str, b: str, at_the_end: bool) -> Column:
    """How many words two sides of a run have in common, from the run outwards."""
    cut = (lambda c, k: F.right(F.hex(c), 4 * k)) if at_the_end else (lambda c, k: F.left(F.hex(c), 4 * k))
    least = F.least(F.length(a), F.length(b)) / 2
    return F.coalesce(F.size(F.filter(F.sequence(F.lit(1), F.lit(SIDE)), lambda k: (k <= least) & (cut(a, k) == cut(b, k)))), F.lit(0))


def repeated_units(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, h, start, words, class_id, first_doc_id, first: parts of documents that repeat a part of another."""
    every = written(all_units(docs), "units")
    found, firsts = seed_runs(every)
    zipped = F.arrays_zip(F.col("p_at").alias("start"), F.col("p_words").alias("words"), F.col("p_uid").alias("uid"))
    lines = every.select("doc_id", "h", "p_bands", F.posexplode(zipped).alias("n", "x"))
    lines = lines.select("doc_id", "h", "x.start", "x.words", "x.uid", F.slice("p_bands", F.col("n") * BANDS + 1, BANDS).alias("bands"))
    place = F.struct("doc_id", "h", "start")
    distinct = lines.groupBy("uid").agg(F.min(place).alias("first"), F.max("doc_id").alias("highest"), F.first("bands").alias("bands"), F.first("words").alias("words"))
    distinct = written(distinct, "paragraphs")
    members = band_members(distinct)
    # what runs and verifications need of the documents' words is fetched by one join
    one = members.select("uid").distinct().join(distinct, "uid").select(F.col("first.doc_id").alias("doc_id"), F.col("first.h").alias("h"), F.struct(F.lit("line").alias("kind"), "uid", F.col("first.start").alias("lo"), (F.col("first.start") + F.col("words")).alias("hi"), F.lit(None).cast("long").alias("of_doc"), F.lit(None).cast("long").alias("of_h"), F.lit(None).cast("int").alias("of_lo")).alias("r"))
    of = [F.col("doc_id").alias("of_doc"), F.col("h").alias("of_h"), F.col("lo").alias("of_lo")]
    here = found.select("doc_id", "h", F.struct(F.lit("run").alias("kind"), F.lit(None).cast("long").alias("uid"), "lo", "hi", *of).alias("r"))
    there = found.select(F.col("f_doc").alias("doc_id"), F.col("f_h").alias("h"), F.struct(F.lit("first").alias("kind"), F.lit(None).cast("long").alias("uid"), (F.col("lo") - F.col("shift")).alias("lo"), (F.col("hi") - F.col("shift")).alias("hi"), *of).alias("r"))
    asked = written(one.unionByName(here).unionByName(there), "words_asked")
    texts = every.select("doc_id", "h", "words16")
    got = asked.join(texts, ["doc_id", "h"]).select(
        "r.*", F.when(F.col("r.kind") == "line", words_at(F.col("r.lo"), F.col("r.hi"))).alias("words16"),
        F.when(F.col("r.kind") != "line", words_at(F.col("r.lo") - SIDE, F.col("r.lo"))).alias("left"), F.when(F.col("r.kind") != "line", words_at(F.col("r.hi"), F.col("r.hi") + SIDE)).alias("right"),
    )
    got = written(got, "words_found")
    words = got.where("kind = 'line'").groupBy("uid").agg(F.first("words16").alias("words16"))
    component = connected_components(paragraph_links(members, words, similarity)).withColumnRenamed("node", "uid")
    named = distinct.select("uid", "first", "highest").join(component, "uid", "left").withColumn("class_id", F.coalesce("component", "uid"))
    near = named.groupBy("class_id").agg(F.min("first").alias("first"), F.max("highest").alias("highest")).where("first.doc_id <> highest").select("class_id", "first")
    near = written(named.select("uid", "class_id").join(near, "class_id"), "paragraph_classes")
    by_line = lines.drop("bands").join(near, "uid").select("doc_id", "h", "start", "words", "class_id", F.col("first.doc_id").alias("first_doc_id"), (F.col("first") == place).alias("first"))

    sides = [F.first(F.when(F.col("kind") == k, F.col(s)), ignorenulls=True).alias(f"{k}_{s}") for k in ("run", "first") for s in ("left", "right")]
    both = got.where("kind <> 'line'").groupBy("of_doc", "of_h", "of_lo").agg(*sides)
    longer = both.select(F.col("of_doc").alias("doc_id"), F.col("of_h").alias("h"), F.col("of_lo").alias("lo"), equal_words("run_left", "first_left", True).alias("left"), equal_words("run_right", "first_right", False).alias("right"))
    longer = written(found.join(longer, ["doc_id", "h", "lo"]), "runs_extended")
    columns = ["doc_id", "h", "start", "words", "class_id", "first_doc_id", "first"]
    others = longer.select("doc_id", "h", (F.col("lo") - F.col("left")).alias("start"), (F.col("hi") + F.col("right") - F.col("lo") + F.col("left")).alias("words"), "class_id", F.col("f_doc").alias("first_doc_id"), F.lit(False).alias("first"))

    def of_first(at: Column, size: Column) -> DataFrame:
        ends = longer.select(F.col("f_doc").alias("doc_id"), F.col("f_h").alias("h"), at.alias("start"), size.alias("words"), "class_id")
        return ends.groupBy("doc_id", "h", "start", "words").agg(F.min("class_id").alias("class_id")).withColumn("first_doc_id", F.col("doc_id")).withColumn("first", F.lit(True)).select(*columns)

    inner = firsts.select(F.col("f_doc").alias("doc_id"), F.col("f_h").alias("h"), F.col("f_start").alias("start"), F.lit(SEED).alias("words"), F.col("uid").alias("class_id"), F.col("f_doc").alias("first_doc_id"), F.lit(True).alias("first"))
    heads = of_first(F.col("lo") - F.col("shift") - F.col("left"), F.col("left") + SEED)
    tails = of_first(F.col("hi") - F.col("shift") - SEED, F.col("right") + SEED)
    return by_line.select(*columns).unionByName(others.select(*columns)).unionByName(inner).unionByName(heads).unionByName(tails)


def passages(shared: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Repeated parts with the run of parts each belongs to, of runs of at least least_words words."""
    by_doc = Window.partitionBy("doc_id", "h").orderBy("start", "words")
    before = F.max(F.col("start") + F.col("words")).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    rows = shared.withColumn("new", F.coalesce((F.col("start") > before + GAP).cast("int"), F.lit(1)))
    rows = rows.withColumn("run", F.sum("new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("doc_id", "h", "run")
    rows = rows.withColumn("run_start", F.min("start").over(whole)).withColumn("run_words", F.max(F.col("start") + F.col("words")).over(whole) - F.col("run_start"))
    return rows.where(F.col("run_words") >= least_words).drop("new")


def repeats(docs: DataFrame, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """A row for each repeated passage of a document: doc_id, start_word, n_words, class_id (smallest of its
    parts' classes), first_doc_id (smallest document that holds one of its parts), removable (whether an
    earlier occurrence of some part stays elsewhere).

    Rows with a null doc_id and null or empty texts take no part. Rows that repeat an id are one
    document: what only they share isn't a repeat. Of equal places the first in order of doc_id, text hash and
    word is a class's first occurrence. Words are compared in lower case (A-Z), by 64 bits of their hash within
    paragraphs and 16 bits at a run's borders; up to 11 words that differ may lie between two parts of a passage.
    Texts that repeat few words over and over have no content-defined paragraphs. Whole texts of any length are
    compared. Further columns are ignored; an empty table gives an empty result.
    """
    rows = passages(repeated_units(docs, similarity), least_words)
    return rows.groupBy("doc_id", F.col("run_start").alias("start_word"), F.col("run_words").alias("n_words")).agg(
        F.min("class_id").alias("class_id"), F.min("first_doc_id").alias("first_doc_id"), F.max(~F.col("first")).alias("removable")
    )


def drop_repeats(docs: DataFrame, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """docs with all but the first occurrence of each repeated passage cut out of the texts.

    n_chars, where docs has it, follows the text. A document of which nothing is left goes; all others
    stay, those without an id as they are; rows that repeat an id lose the passages of their own text. Columns
    of docs may have any names. Only texts that lose something are sent to Python.
    """
    cut = passages(repeated_units(docs, similarity), least_words).where("not first").groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "words")).alias("cuts"))
    cut = written(cut, "cuts")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at : at + 256]
                yield pd.DataFrame({"doc_id": part["doc_id"], "h": part["h"], "left": [without(t, c) for t, c in zip(part["text"], part["cuts"], strict=True)]})

    key = as_input(docs, {"doc_id": "long", "text": "string"}).where("doc_id is not null").withColumn("h", F.xxhash64("text"))
    changed = key.join(cut, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).mapInPandas(keep, "doc_id long, h long, left string")
    changed = written(changed, "texts_cut").select(F.struct("doc_id", "h", "left").alias("_cut"))
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same = (F.col("row.doc_id").cast("long") == F.col("_cut.doc_id")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("_cut.h"))
    joined = own.join(changed, same, "left")
    text = F.when(F.col("_cut").isNull(), F.col("row.text")).otherwise(F.col("_cut.left"))
    joined = joined.where(F.col("_cut").isNull() | (F.trim("_cut.left") != ""))
    new = {"text": text, "n_chars": F.when(F.col("_cut").isNull(), F.col("row.n_chars")).otherwise(F.length("_cut.left")) if "n_chars" in docs.columns else None}
    return joined.select(*((new[c].cast(t) if c in new else F.col(f"row.`{c}`")).alias(c) for c, t in docs.dtypes))


def without(text: str, cuts: list) -> str:
    """The text without the words of the cuts, and without the white space after them."""
    if text is None or not len(cuts):
        return text
    places = [m.span() for m in WORD.finditer(text)]
    gone = np.zeros(len(places) + 1, bool)
    for c in cuts:
        gone[c["start"] : c["start"] + c["words"]] = True
    out, at = [], 0
    edges = np.flatnonzero(np.diff(np.r_[False, gone[:-1], False].astype(np.int8)))
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        out.append(text[at : places[a][0]])
        at = places[b][0] if b < len(places) else len(text)
    return "".join([*out, text[at:]])


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"))
