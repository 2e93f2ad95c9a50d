"""Harmonic packing of token sequences (operator 12).

The capacity C has reciprocal classes: class k takes pieces of floor(C / k) tokens, and k of them fill a bin. Only
the k are used whose full bins leave at most `slack` tokens free, so for 4096 and one token: 1, 2, 3, 4, 5, 7, 8, 9,
13, 15, 16, 21 and so on. A document is cut into the largest class sizes that fit, from its start on. Each worker
holds one open bin a class, fills it with that class's fixed number of pieces and closes it; workers share nothing,
so there is no shuffle and no order between them. What is left in open bins when a worker's rows end is cut
into powers of two, which fill bins without a gap, largest first; the last ones are sequences that are themselves
a power of two long, which need no padding. So a worker pads by at most `slack` tokens a full bin and else nothing.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_input, slices, table, use_cache
from .tokenfile import byte_letters

CAPACITY, SLACK = 4096, 1
#: Bytes of text that are encoded at a time; rows of a result batch; words that a Python worker remembers, in each half of its cache.
STEP, ROWS, CACHE = 8 << 20, 4096, 600_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordIds(dict):
    """Ids by the tokenizers library, word by word.

    The vocabulary's rules never join what white space parts, and white space has no ids; so a text is
    split at blanks and line ends, and each distinct word is encoded once. A letter or digit is never joined with a sign
    behind it, so these are looked up apart. Words of plain letters are one piece, which goes to the library's merges
    directly, in the letters that stand for its bytes. Strings of special tokens are ordinary text.
    """

    SIGNS = ".,;:!?)"

    def __init__(self, path: str, size: int = CACHE):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.size, self.older = Tokenizer.from_file(path), size, {}
        self.library.encode_special_tokens = True
        self.merges, self.letters = self.library.model.tokenize, byte_letters()

    def made(self, word: str) -> bytes:
        if word.isalpha():
            lower = word.lower()
            if word.isascii():
                return array("I", [t.id for t in self.merges(lower)]).tobytes()
            if lower.isalpha() and max(word) <= "\u024f":
                return array("I", [t.id for t in self.merges(lower.encode().decode("latin-1").translate(self.letters))]).tobytes()
        body = word.rstrip(self.SIGNS)
        if len(body) < len(word) and body[-1:].isalnum():
            return self[body] + self[word[len(body) :]]
        return array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if (out := self.older.get(word)) is None:
            out = self.made(word)
        if len(word) <= 64:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[word] = out
        return out

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row, and where each text's begin and end."""
        blank = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        words = pc.split_pattern(blank, " ")
        coded = words.flatten().dictionary_encode()
        place, got = coded.indices.to_numpy(), list(map(self.__getitem__, coded.dictionary.to_pylist()))
        size, flat = np.fromiter(map(len, got), np.int64, len(got)) // 4, np.frombuffer(b"".join(got), "<u4")
        begin, n = np.cumsum(size) - size, size[place]
        ends = np.r_[0, np.cumsum(n)]
        every = flat[np.arange(ends[-1]) + np.repeat(begin[place] - ends[:-1], n)]
        return every, ends[words.offsets.to_numpy() - words.offsets[0].as_py()]


def classes(capacity: int, slack: int) -> dict[int, int]:
    """Piece size -> pieces a bin, largest size first."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    fits = {}
    for k in range(capacity, 0, -1):
        size = capacity // k
        if capacity % k <= slack and capacity // size == k:
            fits[size] = k
    return dict(sorted(fits.items(), reverse=True))


def cut(length: int, sizes: list[int]) -> list[int]:
    """Sizes of the pieces, largest first; they sum up to the length, as 1 is a size."""
    out = []
    for size in sizes:
        out += [size] * (length // size)
        length %= size
    return out


class Bins:
    """The open bins of one worker. A piece is (document's number, doc_id, doc_tokens, start, ids)."""

    def __init__(self, capacity: int, slack: int, first: int):
        self.capacity, self.of = capacity, classes(capacity, slack)
        self.sizes, self.open, self.sequence = list(self.of), {s: [] for s in self.of}, first
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        for size in cut(len(ids), self.sizes):
            # the ids are copied while a bin is open, so that no whole batch is held for a few of its pieces
            (bin_ := self.open[size]).append((doc_id, len(ids), start, ids[start : start + size].copy()))
            start += size
            if len(bin_) == self.of[size]:
                self.close(bin_)
                self.open[size] = []

    def close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, total, start, ids in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, at, ids))
            at += len(ids)
        self.sequence += 1

    def end(self) -> None:
        """Cut what is left into powers of two. Sorted, any power of two up to their sum that the largest fits is a sum of the first ones."""
        powers = [1 << b for b in range(self.capacity.bit_length() - 1, -1, -1)]
        rest = []
        for pieces in self.open.values():
            for doc_id, total, start, ids in pieces:
                for size in cut(len(ids), powers):
                    rest.append((doc_id, total, start, ids[:size]))
                    start, ids = start + size, ids[size:]
        rest.sort(key=lambda p: -len(p[3]))
        left, k = sum(len(p[3]) for p in rest), 0
        while left:
            full = min(self.capacity, 1 << (left.bit_length() - 1))
            a, held = k, 0
            while held < full:
                held, k = held + len(rest[k][3]), k + 1
            self.close(rest[a:k])
            left -= full
        self.open = {s: [] for s in self.of}

    def taken(self, keep_ids: bool) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        *plain, ids = zip(*rows, strict=True) if rows else [()] * 8
        made, names = [pa.array(c, pa.int64()) for c in plain], [c.split()[0] for c in SCHEMA.split(", ")]
        if keep_ids:
            made, names = [*made, pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], [*names, "ids"]
        return pa.RecordBatch.from_arrays(made, names=names)


_workers: dict[str, WordIds] = {}


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY, slack: int = SLACK, keep_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with keep_ids also ids as array<int>.

    Each document's ids are followed by end_id, so null and empty texts have one token. Null ids pass through; rows that
    repeat are documents of their own, each packed whole; further columns are ignored. Texts of any length are
    encoded whole. An empty table gives no rows. A sequence's id is its worker's number, shifted by 33 bits, and a
    running number; both depend on the rows of the worker's split only, so a task that runs again gives the same rows.
    capacity: tokens of a sequence, a power of two; sequences are to be padded to it unless they are a power of two long.
    """
    classes(capacity, slack)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_cache("packing", _workers.clear)
        if vocabulary not in _workers:
            _workers[vocabulary] = WordIds(vocabulary)
        words, bins = _workers[vocabulary], Bins(capacity, slack, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for a, b in slices(batch["text"], STEP):
                every, ends = words.ids(batch["text"].slice(a, b - a))
                for k, doc_id in enumerate(batch["doc_id"].slice(a, b - a).to_pylist()):
                    bins.add(doc_id, np.concatenate([every[ends[k] : ends[k + 1]], end]))
                    if len(bins.rows) >= ROWS:
                        yield bins.taken(keep_ids)
        bins.end()
        if bins.rows:
            yield bins.taken(keep_ids)

    return as_input(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, SCHEMA + (", ids array<int>" if keep_ids else ""))


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequences, tokens and padded (tokens of padding) over all sequences of pack()."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.bit_count("n") == 1, 0).otherwise(capacity - F.col("n"))
    return used.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(pad).alias("padded"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as p

    return pack(table(spark, sf_dir, "documents"), p.path("word_bpe_49k.json"))
