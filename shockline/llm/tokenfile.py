"""Token files in simple-8b words (operator 7).

A 64-bit word holds a 4-bit selector and as many ids as fit at the width the selector names; an id
that no width holds follows an escape word as it is. A file (all little-endian):

    magic 8 bytes, then u64: documents D, ids N, ids per block B, blocks K, words W
    D bytes: 1 where the document has an id; D i64 document ids; D u64 ends (ids up to and with it)
    K u64: the word each block starts at; W u64: the words

Blocks start at a multiple of B ids, so any can be found and decoded alone, whole arrays at a time.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import STEP, ChunkCache
from .common import as_input, scratch_path, slices, table, use_cache, written
from .files import make_folder, put, read_range

MAGIC = b"S8BTOKN1"
#: (ids, bits) of selectors 1 to 14, widest count first. Selector 0 is the escape.
FORMS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
BLOCK_IDS, FILE_IDS = 1 << 16, 1 << 24
#: Chunks of text that a Python worker remembers, in each half of its cache.
CACHE = 600_000
LIMITS = np.array([1 << b for _, b in FORMS], np.uint64)
COUNT = np.array([1] + [c for c, _ in FORMS] + [0], np.int64)


def pack(ids: np.ndarray) -> np.ndarray:
    """Ids (unsigned 64-bit) to words, at each place the selector that takes the most ids."""
    n = len(ids)
    padded = np.concatenate([ids.astype(np.uint64), np.zeros(60, np.uint64)])
    # the first selector whose width holds an id, then the last one that any of its count needs
    need = (np.searchsorted(LIMITS, padded, "right") + 1).astype(np.uint8)
    form, most, width = np.full(n, len(FORMS), np.uint8), need, 1
    for s in range(len(FORMS) - 1, 0, -1):
        count = FORMS[s - 1][0]
        most = np.maximum(most[: n + 60 - count + 1], most[count - width :][: n + 60 - count + 1])
        width = count
        form[most[:n] <= s] = s
    form[need[:n] > len(FORMS)] = 0
    step, at, places = COUNT[form].tolist(), 0, []
    while at < n:
        places.append(at)
        at += step[at]
    where = np.array(places, np.int64)
    chosen = form[where]
    size = 1 + (chosen == 0)
    slot = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s, (count, bits) in enumerate(FORMS, 1):
        if len(own := np.flatnonzero(chosen == s)):
            values = padded[where[own][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(bits))
            words[slot[own]] = np.bitwise_or.reduce(values, axis=1) | np.uint64(s << 60)
    raw = np.flatnonzero(chosen == 0)
    words[slot[raw] + 1] = padded[where[raw]]
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first n ids of the words of a block."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    slot = np.arange(len(words))
    if (chosen == 0).any():  # the word after an escape has no selector
        at, keep = 0, []
        for s in chosen.tolist():
            at = 0 if at == 2 else 2 if s == 0 else 1
            keep.append(at != 0)
        slot = slot[keep]
        chosen = chosen[keep]
    counts = COUNT[chosen]
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s, (count, bits) in enumerate(FORMS, 1):
        if len(own := np.flatnonzero(chosen == s)):
            mask = np.uint64((1 << bits) - 1)
            out[start[own][:, None] + np.arange(count)] = (words[slot[own]][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(bits))) & mask
    raw = np.flatnonzero(chosen == 0)
    out[start[raw]] = words[slot[raw] + 1]
    return out[:n]


class Writer:
    """Gathers documents and gives a file's bytes; only packed words are held."""

    def __init__(self):
        self.ids, self.has, self.ends, self.n = [], [], [], 0
        self.open, self.held, self.blocks = [], 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.has.append(doc_id is not None)
        self.ids.append(0 if doc_id is None else doc_id)
        self.n += len(ids)
        self.ends.append(self.n)
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            self.flush(False)

    def flush(self, end: bool) -> None:
        ids = np.concatenate(self.open) if self.open else np.empty(0, np.uint64)
        whole = len(ids) if end else len(ids) // BLOCK_IDS * BLOCK_IDS
        self.blocks += [pack(ids[k : min(k + BLOCK_IDS, whole)].astype(np.uint64)) for k in range(0, whole, BLOCK_IDS)]
        self.open, self.held = [ids[whole:]], len(ids) - whole

    def file(self) -> bytes:
        self.flush(True)
        sizes = np.array([len(b) for b in self.blocks], np.uint64)
        head = MAGIC + struct.pack("<5Q", len(self.ids), self.n, BLOCK_IDS, len(sizes), int(sizes.sum()))
        starts = np.cumsum(sizes, dtype=np.uint64) - sizes
        return b"".join([head, np.array(self.has, np.uint8).tobytes(), np.array(self.ids, "<i8").tobytes(), np.array(self.ends, "<u8").tobytes(), starts.astype("<u8").tobytes(), *(b.astype("<u8").tobytes() for b in self.blocks)])


def read_file(data: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """Documents of a file in order: id, start within the file, token ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, n, block, blocks, words = struct.unpack_from("<5Q", data, 8)
    at = 48
    has = np.frombuffer(data, np.uint8, docs, at)
    ids = np.frombuffer(data, "<i8", docs, at := at + docs)
    ends = np.frombuffer(data, "<u8", docs, at := at + 8 * docs).astype(np.int64)
    starts = np.frombuffer(data, "<u8", blocks, at := at + 8 * docs).astype(np.int64)
    all_words = np.frombuffer(data, "<u8", words, at + 8 * blocks)
    stops = np.append(starts[1:], words)
    have, first, k = np.empty(0, np.uint64), 0, 0
    for d in range(docs):
        a, b = int(ends[d - 1]) if d else 0, int(ends[d])
        if b > first + len(have):
            parts = [have[a - first :]]
            first = a
            while b > first + sum(map(len, parts)):
                parts.append(unpack(all_words[starts[k] : stops[k]], min(block, n - k * block)))
                k += 1
            have = np.concatenate(parts)
        yield int(ids[d]) if has[d] else None, a, have[a - first : b - first]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


def library(path: str) -> ChunkCache:
    """Ids by the tokenizers library. Strings of special tokens are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t, letters = Tokenizer.from_file(path), byte_letters()
    t.encode_special_tokens = True
    merge = t.model.tokenize
    space = letters[32]

    def piece(s: str) -> list[int]:  # what the library's splitter leaves whole: letters or signs, a space before them or not
        s = s.replace(" ", space) if s.isascii() and "\n" not in s else s.encode().decode("latin-1").translate(letters)
        return [x.id for x in merge(s)]

    return ChunkCache(piece, lambda s: t.encode(s, add_special_tokens=False).ids, CACHE)


_workers: dict[str, ChunkCache] = {}


def write_token_files(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, file_ids: int = FILE_IDS) -> DataFrame:
    """Write ids of all documents in ascending doc_id order; returns the manifest (path, file, n_docs, n_ids).

    Each document's ids are followed by end_id. Null doc_ids come first; rows of equal doc_id follow
    the order of their texts' hash; null and empty texts have only the end id. Empty input: no files.
    Texts of any length are encoded whole. A file's name has its task's attempt, so a task that runs again
    writes files of its own; the manifest names those of the attempt that counts.
    """
    make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("tokens", _workers.clear)
        if vocabulary not in _workers:
            _workers[vocabulary] = library(vocabulary)
        context = TaskContext.get()
        cache, part, attempt, number, w = _workers[vocabulary], context.partitionId(), context.taskAttemptId(), 0, Writer()
        end = np.array([end_id], np.uint32)

        def close() -> pa.RecordBatch:
            path = f"{folder}/part-{part:06d}-{number:04d}-{attempt}.s8b"
            put(path, w.file())
            return pa.RecordBatch.from_pydict({"path": [path], "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "n_docs": [len(w.ids)], "n_ids": [w.n]})

        for batch in batches:
            for a, b in slices(batch["text"], STEP):
                for doc_id, ids in zip(batch["doc_id"].slice(a, b - a).to_pylist(), cache.ids(batch["text"].slice(a, b - a)), strict=True):
                    w.add(doc_id, np.concatenate([ids, end]))
                    if w.n >= file_ids:
                        yield close()
                        number, w = number + 1, Writer()
        if w.ids:
            yield close()

    ordered = as_input(docs, {"doc_id": "long", "text": "string"}).withColumn("h", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    return written(ordered.mapInArrow(run, "path string, part int, number int, n_docs long, n_ids long"), "token_manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files; start counts over all files.

    The running total goes over one row per file (of up to FILE_IDS ids), not over documents.
    """
    base = F.sum("n_ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(base, F.lit(0)).alias("base"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, at in zip(b["path"], b["base"], strict=True):
                rows = [(d, at + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, start, ids in read_file(read_range(path))]
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    files = files.repartition(max(1, manifest.count()), "path")
    return files.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as p

    manifest = write_token_files(table(spark, sf_dir, "documents"), p.path("byte_bpe_50k.json"), scratch_path(spark, "tokens"))
    return read_token_files(manifest)
