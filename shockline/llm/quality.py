"""Quality classifier: random-indexing vectors, pooled, and a two-layer network (operator 9).

Every document has a sparse random index vector, drawn by the hash of its text. A word's vector is the
sum of the index vectors of all documents that have it, so words of similar documents are similar. A
text is the mean of its words' vectors; a two-layer numpy network scores it, and a temperature fitted
on rows that the network didn't see makes its scores probabilities.

Words are the letters of a chunk between white space in a bucket each, with a mark for their case, for
the run of signs beside them and for standing twice in a row; marks are words like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_input, table, use_cache
from .labelled import held_out, labelled_rows

#: Buckets of words (the first ones are marks), dimensions, non-zeros of an index vector.
BUCKETS, MARKS, DIM, NONZERO = 4096, 64, 64, 6
ROWS_PER_PART, PARTS = 64, 64
#: Bound of the fit: labelled rows. The vectors are from all documents.
MOST_ROWS, HIDDEN, EPOCHS = 20_000, 32, 60
SHRINK = 8
_CACHE = 100_000
RUNS = re.compile(r"\w+|[^\w\s]+")
AGAIN, UPPER, TITLE, LOWER, DIGITS, MIXED, LONG = range(7)


def bucket(piece: str) -> int:
    return MARKS + xxhash.xxh32_intdigest(piece.encode("utf-8", "replace")) % (BUCKETS - MARKS)


class Words:
    """Buckets of a text's words and marks, in order; chunks between white space are remembered."""

    def __init__(self):
        self.seen: dict[str, tuple[int, ...]] = {}

    def chunk(self, c: str) -> tuple[int, ...]:
        out: list[int] = []
        for piece in RUNS.findall(c):
            if piece[0].isalnum() or piece[0] == "_":
                case = DIGITS if piece.isdigit() else LOWER if piece.islower() else UPPER if piece.isupper() and len(piece) > 1 else TITLE if piece.istitle() else MIXED
                out += (case, bucket(piece.lower()))
                if len(piece) > 20:
                    out.append(LONG)
            else:
                out.append(8 + xxhash.xxh32_intdigest(piece[:8].encode("utf-8", "replace")) % (MARKS - 8))
        return tuple(out)

    def of(self, text: str | None) -> np.ndarray:
        use_cache("quality", self.seen.clear)
        chunks, out, before, seen = (text or "").split(), [], None, self.seen
        for c in chunks:
            if (got := seen.get(c)) is None:
                if len(seen) > _CACHE:
                    seen.clear()
                got = self.chunk(c)
                if len(c) <= 64:
                    seen[c] = got
            out += got
            if c == before:
                out.append(AGAIN)
            before = c
        return np.array(out, np.int64)


_words = Words()


def index_vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of a text's index vector."""
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
    g = np.random.Generator(np.random.PCG64(h))
    return g.choice(DIM, NONZERO, replace=False), g.integers(0, 2, NONZERO) * 2 - 1


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS unit vectors from all documents. What reaches the driver is of fixed size.

    Each task adds up its documents; the sums meet in two steps, so no task gets those of all tasks.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BUCKETS, DIM), np.int64)
        for b in batches:
            for text in b["text"]:
                own = np.unique(_words.of(text))
                if len(own):
                    at, sign = index_vector(text)
                    total[own[:, None], at] += sign
        rows = [total[k : k + ROWS_PER_PART].tobytes() for k in range(0, BUCKETS, ROWS_PER_PART)]
        yield pd.DataFrame({"part": np.arange(len(rows), dtype=np.int32), "salt": np.int32(TaskContext.get().partitionId() % PARTS), "sums": rows})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(ROWS_PER_PART * DIM, np.int64)
        for x in pdf["sums"]:
            total += np.frombuffer(x, np.int64)
        return pdf.iloc[:1].assign(sums=[total.tobytes()])

    schema = "part int, salt int, sums binary"
    sums = as_input(docs, {"text": "string"}).mapInPandas(run, schema).groupBy("part", "salt").applyInPandas(add, schema)
    rows = sums.groupBy("part").applyInPandas(add, schema).toPandas().sort_values("part")
    v = np.zeros((BUCKETS, DIM)) if not len(rows) else np.frombuffer(b"".join(rows["sums"]), np.int64).reshape(BUCKETS, DIM).astype(float)
    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    v = v - v.mean(axis=0)
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Mean of the words' vectors with SHRINK words of zero, so that few words say little."""
    own = _words.of(text)
    if not len(own):
        return np.zeros(DIM)
    n = np.bincount(own, minlength=BUCKETS)
    has = np.flatnonzero(n)
    return n[has] @ vectors[has] / (len(own) + SHRINK)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Two layers by Adam on four fifths of the rows; the temperature that fits the rest best."""
    g = np.random.Generator(np.random.PCG64(7))
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - centre) / spread
    rest = np.arange(len(x)) % 5 == 4
    a, ya = z[~rest], y[~rest]
    p = [g.normal(0, DIM**-0.5, (DIM, HIDDEN)), np.zeros(HIDDEN), g.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    for _ in range(EPOCHS):
        order = g.permutation(len(a))
        for k in range(0, len(a), 256):
            b = order[k : k + 256]
            h = np.tanh(a[b] @ p[0] + p[1])
            e = (sigmoid(h @ p[2] + p[3][0]) - ya[b]) / len(b)
            back = e[:, None] * p[2] * (1 - h * h)
            grads, t = [a[b].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ e + 1e-4 * p[2], np.array([e.sum()])], t + 1
            for i, d in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * d
                v[i] = 0.999 * v[i] + 0.001 * d * d
                p[i] = p[i] - 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    model = {"centre": centre, "spread": spread, "p": p, "temperature": 1.0}
    if rest.any():
        logit = logits(x[rest], model)
        grid = np.geomspace(0.25, 8, 61)
        loss = [np.logaddexp(0, np.where(y[rest] == 1, -logit, logit) / s).mean() for s in grid]
        model["temperature"] = float(grid[int(np.argmin(loss))])
    return model


def logits(x: np.ndarray, model: dict) -> np.ndarray:
    p = model["p"]
    return (np.tanh((x - model["centre"]) / model["spread"] @ p[0] + p[1]) @ p[2] + p[3][0]) / model["temperature"]


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, fold: int = 1, most: int = MOST_ROWS) -> dict:
    """Vectors from all documents, the network from at most `most` labelled rows outside the fold.

    Without labelled rows of both classes every text scores the rows' mean, 0.5 if there are none.
    """
    vectors = word_vectors(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"label": b["label"], "h": b["h"], "x": [pooled(t, vectors).tolist() for t in b["text"]]})

    rows = labelled_rows(docs, labels, "quality", modulus, fold, most).mapInPandas(run, "label int, h long, x array<double>").toPandas()
    rows = rows.sort_values(["h", "label"], kind="stable")
    y = rows["label"].to_numpy(np.float64)
    if len(set(y)) < 2:
        return {"vectors": vectors, "constant": float(y.mean()) if len(y) else 0.5}
    return fit(np.stack(rows["x"].to_numpy()), y) | {"vectors": vectors}


def score(docs: DataFrame, model: dict, modulus: int = 3, fold: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs, from the whole text alone.

    Null and empty texts are scored as the zero vector; texts of any length are scored whole. A null doc_id
    is not held out. Repeated rows give a row each; further columns are ignored; an empty table gives an
    empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for b in batches:
            if "constant" in model:
                s = np.full(len(b), model["constant"])
            else:
                x = [pooled(t, model["vectors"]) for t in b["text"]]
                s = sigmoid(logits(np.stack(x), model)) if x else np.empty(0)
            yield pd.DataFrame({"doc_id": b["doc_id"].array, "held_out": b["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})

    rows = as_input(docs, {"doc_id": "long", "text": "string"}).withColumn("held_out", held_out("doc_id", modulus, fold))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs whose whole text scores at least `least`; columns as they are, whatever their names.

    Null and empty texts are scored as the zero vector. Rows without an id and repeated rows are decided by their
    text alone. Without labels of both classes all rows have one score. An empty table gives an empty result.
    """
    model = train(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def good(texts: pd.Series) -> pd.Series:
        model = sent.value
        if "constant" in model:
            return pd.Series(np.full(len(texts), model["constant"] >= least))
        return pd.Series(sigmoid(logits(np.stack([pooled(t, model["vectors"]) for t in texts]), model)) >= least if len(texts) else np.empty(0, bool))

    return docs.where(F.pandas_udf(good, "boolean")(F.col("text").cast("string")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
