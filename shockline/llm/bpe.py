"""Byte-level BPE encoding and decoding by prefix dynamic programming (operator 3).

For every byte prefix of a piece there is exactly one token that ends its encoding. It is the one
token t that is a suffix of the prefix and compatible with the last token of what stands before t.
Storing that token for each prefix gives the whole encoding by walking back, makes appending bytes
exact (old entries never change), and lets an edit re-encode from the edited byte on only.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import as_input, slices, table, use_cache

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Cached pieces and prefixes of a Python worker: a cache holds up to twice as many, the newer half and the older
#: one. When the newer half is full it becomes the older one, whose entries come back as they are met again.
CACHE = 250_000
#: Bytes for which the tokens that end them are remembered.
TAIL = 4
#: Bytes of text that are cut into chunks at a time.
STEP = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PrefixEncoder:
    """Encodes pieces (bytes) by the ranks; `last` maps each prefix met so far to its last token."""

    def __init__(self, ranks: dict[bytes, int], cache: int = CACHE):
        self.ranks = ranks
        #: All ends of tokens that are longer than TAIL bytes: their rank, or -1 where an end is no token itself.
        self.ends = {b[k:]: -1 for b in ranks for k in range(1, len(b) - TAIL)} | {b: t for b, t in ranks.items() if len(b) > TAIL}
        #: For up to TAIL bytes: length and rank of the tokens that end them, longest first.
        self.tails: dict[bytes, list[tuple[int, int]]] = {}
        self.token = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.cache = cache
        self.last: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}
        self.pair: dict[int, bool] = {}
        self.half: dict[int, tuple[int, int] | None] = {}

    def merged(self, s: bytes) -> list[int]:
        """Plain merging, lowest rank first, leftmost among equals: defines which tokens fit together."""
        parts, ranks = [s[i : i + 1] for i in range(len(s))], self.ranks
        while len(parts) > 1:
            found = [(ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            best = min((x for x in found if x[0] is not None), default=None)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    def stands(self, t: int) -> bool:
        """Whether merging a token's own bytes gives that token."""
        return self.halves(t) is not None

    def halves(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge made t last: (-1, -1) for a byte, None if merging doesn't give t."""
        if t not in self.half:
            s = self.token[t]
            cuts = [i for i in range(1, len(s)) if s[:i] in self.ranks and s[i:] in self.ranks]
            self.half[t] = (-1, -1) if len(s) == 1 else None
            if len(s) > 1 and self.merged(s) == [t]:
                pairs = ((self.ranks[s[:i]], self.ranks[s[i:]]) for i in cuts)
                self.half[t] = next(p for p in pairs if self.merged(s[: len(self.token[p[0]])]) == [p[0]] and self.merged(s[len(self.token[p[0]]) :]) == [p[1]] and self.joined(s, p))
        return self.half[t]

    def joined(self, s: bytes, pair: tuple[int, int]) -> bool:
        """Whether merging s passes through this pair just before the whole."""
        parts = [s[i : i + 1] for i in range(len(s))]
        while len(parts) > 2:
            found = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            i = min(x for x in found if x[0] is not None)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return tuple(self.ranks[p] for p in parts) == pair

    def fits(self, a: int, b: int) -> bool:
        """Whether a followed by b stays apart: undo the later of the two edge merges step by step; no
        merge over the border may have been due before the one undone."""
        ranks, token, due = self.ranks, self.token, 1 << 40
        while True:
            c = ranks.get(token[a] + token[b])
            if c is not None and c < due:
                return False
            left, right = self.halves(a), self.halves(b)
            if left[0] >= 0 and (a > b or right[0] < 0):
                due, a = a, left[1]
            elif right[0] >= 0:
                due, b = b + 1, right[0]
            else:
                return True

    def encode(self, piece: bytes) -> list[int]:
        """As tiktoken: a piece that is itself a token is that token, otherwise the merges decide."""
        if (t := self.ranks.get(piece)) is not None:
            return [t]
        if len(piece) > 512:  # storing all prefixes of a long piece takes quadratic memory
            return LongPiece(self, piece).ids()
        if len(self.last) > self.cache:
            self.last, self.older = {}, self.last
        if len(self.pair) > self.cache:
            self.pair.clear()
        last, older, pair, tails, ends = self.last, self.older, self.pair, self.tails, self.ends
        known = total = len(piece)
        while known and (prefix := piece[:known]) not in last:
            if prefix in older:  # and with it all of its own prefixes
                for k in range(1, known + 1):
                    last[piece[:k]] = older[piece[:k]]
                break
            known -= 1
        for n in range(known + 1, total + 1):
            tail = piece[n - TAIL if n > TAIL else 0 : n]
            if (found := tails.get(tail)) is None:
                found = tails[tail] = [(len(tail) - k, t) for k in range(len(tail)) if (t := self.ranks.get(tail[k:])) is not None]
            if n > TAIL and (t := ends.get(piece[n - TAIL - 1 : n])) is not None:
                found, size = found[:], TAIL + 1
                while t is not None:
                    if t >= 0:
                        found.insert(0, (size, t))
                    size += 1
                    t = ends.get(piece[n - size : n]) if size <= n else None
            for size, t in found:
                if size < n:
                    both = last[piece[: n - size]] << 20 | t
                    if (ok := pair.get(both)) is None:
                        ok = pair[both] = self.stands(t) and self.fits(both >> 20, t)
                else:
                    ok = self.stands(t)
                if ok:
                    last[piece[:n]] = t
                    break
            else:
                raise ValueError("the ranks have no token for a byte")
        n = total
        out, length = [], self.length
        while n:
            out.append(t := last[piece[:n]])
            n -= length[t]
        out.reverse()
        return out


class LongPiece:
    """One piece with the last token of each of its prefixes by position: appendable and editable."""

    def __init__(self, encoder: PrefixEncoder, piece: bytes = b""):
        self.encoder, self.bytes, self.last = encoder, bytearray(), []
        self.append(piece)

    def append(self, more: bytes) -> None:
        e, at = self.encoder, len(self.bytes)
        self.bytes += more
        for n in range(at + 1, len(self.bytes) + 1):
            for k in range(max(0, n - e.longest), n):
                t = e.ranks.get(bytes(self.bytes[k:n]))
                if t is not None and e.stands(t) and (k == 0 or e.fits(self.last[k - 1], t)):
                    self.last.append(t)
                    break
            else:
                raise ValueError("the ranks have no token for a byte")

    def edit(self, at: int, removed: int, inserted: bytes) -> None:
        """Replace `removed` bytes at `at`. Prefixes before the edit keep their entries, and so do those behind it
        from where as many in a row as the longest token has bytes came out as before: an entry depends on no others."""
        tail, old = bytes(self.bytes[at + removed :]), self.last[at + removed :]
        del self.bytes[at:], self.last[at:]
        self.append(inserted)
        same, done = 0, 0
        while done < len(tail) and same < self.encoder.longest:
            self.append(tail[done : done + 1])
            same = same + 1 if self.last[-1] == old[done] else 0
            done += 1
        self.bytes += tail[done:]
        self.last += old[done:]

    def ids(self) -> list[int]:
        out, n = [], len(self.bytes)
        while n:
            out.append(t := self.last[n - 1])
            n -= len(self.encoder.token[t])
        return out[::-1]


class ChunkCache(dict):
    """Encodes texts chunk by chunk and remembers the chunks' ids, as little-endian 32-bit bytes.

    The pattern always splits before a space that a non-space follows and at a line feed between
    non-spaces. So a text whose white space is single spaces and line feeds is split there by str
    methods. A key is a chunk without its leading space; after NONE it has none, after BREAK a line
    feed stands before it. Other texts take the general way as a whole.

    piece(s): ids of a string that the pattern leaves in one piece; anything(s): ids of any string.
    """

    NONE, BREAK = "\x01", "\n\x01"
    ODD = r"\A[ \n]|[ \n]\z|[ \n][ \n]|[\x01\t\r\v\f\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    SIGNS = ".,!?;:*%$#&|"

    def __init__(self, piece: Callable[[str], list[int]], anything: Callable[[str], list[int]], size: int = CACHE):
        super().__init__()
        self.piece, self.anything, self.size, self.older = piece, anything, size, {}

    def clear(self) -> None:
        super().clear()
        self.older = {}

    def __missing__(self, key: str) -> bytes:
        if (out := self.older.get(key)) is None:
            out = self.made(key)
        if len(key) <= 64:
            if len(self) >= self.size:
                self.older = dict(self)
                super().clear()
            self[key] = out
        return out

    def made(self, key: str) -> bytes:
        first = key[:1]
        if first.isalpha() and key.isalpha() and (key.isascii() or max(key) <= "\u024f"):
            return array("I", self.piece(" " + key)).tobytes()
        if key.startswith(self.BREAK):
            return self["\x01\n"] + self[self.NONE + key[2:]]
        s = key[1:] if first == self.NONE else " " + key
        word = s.lstrip(" ")
        body = word.rstrip(self.SIGNS)
        if s.count(" ") > 1 or not body.isalpha() or max(body) > "\u024f":
            ids = self.anything(s)
        elif len(body) == len(word):
            ids = self.piece(s)
        else:  # letters, then signs: two pieces
            return self[key[: len(key) - len(word) + len(body)]] + self[self.NONE + word[len(body) :]]
        return array("I", ids).tobytes()

    def ids(self, texts: pa.Array, step: int = 1 << 19) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers; none for a null. Each distinct chunk is looked up once."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.ODD)
        marked = pc.replace_substring(pc.binary_join_element_wise(self.NONE, pc.if_else(odd, "", texts), ""), "\n", " " + self.BREAK)
        parts = pc.split_pattern(marked, " ")
        coded = parts.flatten().dictionary_encode()
        place, got = coded.indices.to_numpy(), list(map(self.__getitem__, coded.dictionary.to_pylist()))
        size, flat = np.fromiter(map(len, got), np.int64, len(got)) // 4, np.frombuffer(b"".join(got), np.uint32)
        start, ends = np.cumsum(size) - size, np.r_[0, np.cumsum(size[place])]
        out = np.empty(ends[-1], np.uint32)
        for at in range(0, len(place), step):
            own = place[at : at + step]
            first, n = ends[at], size[own]
            out[first : first + n.sum()] = flat[np.arange(n.sum()) + np.repeat(start[own] - ends[at : at + len(own)] + first, n)]
        ends = ends[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
        made = [out[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for k in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            made[k] = np.array(self.anything(texts[k].as_py()), np.uint32)
        return made


class Decoder:
    """Bytes of ids, looked up in one flat table of all tokens' bytes."""

    def __init__(self, token: dict[int, bytes], step: int = 1 << 20):
        rows = [token.get(i, b"") for i in range(max(token, default=-1) + 1)]
        self.flat, self.step = np.frombuffer(b"".join(rows), np.uint8), step
        self.size = np.array([len(b) for b in rows], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def decode(self, every: np.ndarray) -> bytes:
        out = []
        for at in range(0, len(every), self.step):
            own = every[at : at + self.step]
            size = self.size[own]
            ends = np.cumsum(size)
            out.append(self.flat[np.arange(ends[-1]) + np.repeat(self.start[own] - ends + size, size)].tobytes())
        return b"".join(out)


_workers: dict[tuple[str, str], tuple[ChunkCache, Decoder]] = {}


def worker(path: str, pattern: str) -> tuple[ChunkCache, Decoder]:
    """One encoder for each Python worker and vocabulary, kept from task to task."""
    use_cache("bpe", _workers.clear)
    if (path, pattern) not in _workers:
        e, split = PrefixEncoder(read_ranks(path)), regex.compile(pattern)
        pieces = lambda s: [i for p in split.findall(s) for i in e.encode(p.encode("utf-8", "surrogatepass"))]
        _workers[path, pattern] = (ChunkCache(lambda s: e.encode(s.encode()), pieces), Decoder(e.token))
    return _workers[path, pattern]


def tokenize(docs: DataFrame, vocabulary: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Encode each whole text and decode it again: counts, digests and, with keep_ids, ids as array<int>.

    A null or empty text has no tokens. Nulls in doc_id pass through; repeated rows give a row each;
    further columns of docs are ignored. Texts of any length are processed whole. An empty table gives an
    empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, decoder = worker(vocabulary, pattern)
        for batch in batches:
            for a, b in slices(batch["text"], STEP):
                ids = cache.ids(batch["text"].slice(a, b - a))
                made = [batch["doc_id"].slice(a, b - a), pa.array([len(x) for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(decoder.decode(x)).hexdigest() for x in ids])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    made, names = [*made, pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(made, names=names)

    return as_input(docs, {"doc_id": "long", "text": "string"}).mapInArrow(run, SCHEMA + (", ids array<int>" if keep_ids else ""))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as p

    return tokenize(table(spark, sf_dir, "documents"), p.path("byte_bpe_multi_50k.tiktoken"), p.PATTERN)
