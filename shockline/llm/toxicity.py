"""Toxicity by a counterfactual-regularised classifier (operator 4).

A logistic model over the words and word beginnings a text contains. Its loss adds, for each labelled
text that mentions an identity term, the square of the change of its score when the terms are swapped
for others of their group: naming a group moves the score as little as the labels allow.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_input, table, use_cache, written
from .labelled import held_out, labelled_rows

#: Terms that name people; the terms of a line stand for one another.
IDENTITY = """
women men girls boys females males
woman man girl boy female male
muslims christians jews hindus buddhists atheists sikhs catholics protestants
muslim christian jewish hindu buddhist atheist sikh catholic protestant
blacks whites asians latinos arabs
black white asian latino arab african european american indian chinese mexican
gay straight lesbian bisexual transgender queer heterosexual homosexual
gays lesbians
immigrants refugees foreigners natives citizens migrants
immigrant refugee foreigner native citizen migrant
disabled deaf blind autistic
elderly young old
mujeres hombres frauen männer femmes hommes
""".split("\n")
BUCKETS, PREFIXES = 1 << 20, (4, 5)
#: Bounds of the fit: labelled rows, and evidence a feature needs (texts that have it; deviations from chance).
MOST_ROWS, LEAST_TEXTS, LEAST_Z = 20_000, 4, 4.0
PENALTY, RIDGE, STEPS = 4.0, 1e-4, 300
LETTERS = re.compile(r"\w+")
SWAP = {w: line[(i + 1) % len(line)] for g in IDENTITY if (line := g.split()) for i, w in enumerate(line)}
_CACHE = 200_000


def word_features(word: str) -> tuple[int, ...]:
    keys = [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) > n)]
    return tuple(xxhash.xxh32_intdigest(k.encode("utf-8", "replace")) % BUCKETS for k in keys)


class Features:
    """Buckets of a text's words, or only those of `wanted`. Chunks between white space are remembered."""

    def __init__(self, wanted: set[int] | None = None):
        self.wanted, self.seen = wanted, {}

    def chunk(self, chunk: str) -> tuple[int, ...]:
        got = self.seen.get(chunk)
        if got is None:
            got = tuple(f for w in LETTERS.findall(chunk) for f in word_features(w) if self.wanted is None or f in self.wanted)
            if len(self.seen) > _CACHE:
                self.seen.clear()
            if len(chunk) <= 64:
                self.seen[chunk] = got
        return got

    def of(self, text: str | None) -> np.ndarray:
        out: set[int] = set()
        for c in set((text or "").lower().split()):
            out.update(self.chunk(c))
        return np.array(sorted(out), np.uint32)


def swapped(text: str | None) -> str | None:
    """The text with each identity term replaced; None if it has none."""
    low = (text or "").lower()
    if not any(w in SWAP for w in LETTERS.findall(low)):
        return None
    return LETTERS.sub(lambda m: SWAP.get(m[0], m[0]), low)


def fit(labels: np.ndarray, texts: list[np.ndarray], twins: list[np.ndarray | None], penalty: float = PENALTY) -> dict:
    """Weights of the features that the labels speak for or against, and of the identity terms."""
    n, toxic = len(labels), labels.sum()
    have, bad = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for y, t in zip(labels, texts, strict=True):
        have[t] += 1
        bad[t] += int(y)
    rate = (toxic + 0.5) / (n + 1)
    z = (bad - have * rate) / np.sqrt(np.maximum(have, 1) * rate * (1 - rate))
    terms = [f for w in SWAP for f in word_features(w)]
    chosen = np.union1d(np.flatnonzero((have >= LEAST_TEXTS) & (np.abs(z) >= LEAST_Z)), np.array(terms, np.int64))
    place = np.full(BUCKETS, -1, np.int64)
    place[chosen] = np.arange(len(chosen))

    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        own = [place[r][place[r] >= 0] for r in rows]
        return np.repeat(np.arange(len(own)), [len(r) for r in own]), np.concatenate(own) if own else np.empty(0, np.int64)

    r, c = flat(texts)
    pairs = [i for i, t in enumerate(twins) if t is not None]
    ra, ca = flat([texts[i] for i in pairs])
    rb, cb = flat([twins[i] for i in pairs])
    h, x, k = have[chosen], bad[chosen], len(chosen)
    w = (np.log((x + 0.5) / (toxic + 1)) - np.log((h - x + 0.5) / (n - toxic + 1))) / 2  # start: half the log odds, as a word and its beginnings overlap
    w[h == 0] = 0
    b = float(np.log(rate / (1 - rate)))
    m, v, mb, vb = np.zeros(k), np.zeros(k), 0.0, 0.0
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-(b + np.bincount(r, w[c], n))))
        e = (p - labels) / max(n, 1)
        g, gb = np.bincount(c, e[r], k) + RIDGE * w, e.sum()
        if pairs:
            change = (np.bincount(ra, w[ca], len(pairs)) - np.bincount(rb, w[cb], len(pairs))) * (2 * penalty / len(pairs))
            g += np.bincount(ca, change[ra], k) - np.bincount(cb, change[rb], k)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, q = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.05 * (m / a) / (np.sqrt(v / q) + 1e-8)
        b -= 0.05 * (mb / a) / (np.sqrt(vb / q) + 1e-8)
    return {"bias": float(b), "weights": {int(f): float(x) for f, x in zip(chosen, w, strict=True) if x}}


_workers: dict[int, Features] = {}


def score_text(text: str | None, model: dict, features: Features) -> float:
    z = model["bias"] + sum(model["weights"][f] for f in features.of(text).tolist())
    return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, fold: int = 0, most: int = MOST_ROWS) -> dict:
    """Fit on at most `most` labelled rows outside the fold; without any, a score of 0.5 for all.

    The features' counts are taken on the executors; the driver gets those features that the labels speak
    for or against, and of each row those features alone.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = Features()
        for b in batches:
            own, twin = [], []
            for text in b["text"]:
                own.append(f.of(text).tolist())
                other = swapped(text)
                twin.append(None if other is None else f.of(other).tolist())
            yield pd.DataFrame({"label": b["label"], "h": b["h"], "own": own, "twin": twin})

    rows = labelled_rows(docs, labels, "toxic", modulus, fold, most).mapInPandas(run, "label int, h long, own array<int>, twin array<int>")
    rows = written(rows, "toxicity_rows")
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n:
        return {"bias": 0.0, "weights": {}}
    counts = rows.select("label", F.explode("own").alias("f")).groupBy("f").agg(F.count("*").alias("have"), F.sum("label").alias("bad"))
    rate = (toxic + 0.5) / (n + 1)
    z = (F.col("bad") - F.col("have") * rate) / F.sqrt(F.col("have") * (rate * (1 - rate)))
    chosen = counts.where((F.col("have") >= LEAST_TEXTS) & (F.abs(z) >= LEAST_Z - 1e-6)).select("f").toPandas()["f"].to_numpy(np.int64)
    wanted = docs.sparkSession.sparkContext.broadcast(np.union1d(chosen, np.array([f for w in SWAP for f in word_features(w)], np.int64)))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def cut(x: object) -> bytes | None:
            return None if x is None else np.intersect1d(np.asarray(x, np.int64), wanted.value, True).astype(np.uint32).tobytes()

        for b in batches:
            yield pd.DataFrame({"label": b["label"], "h": b["h"], "own": [cut(x) for x in b["own"]], "twin": [cut(x) for x in b["twin"]]})

    few = rows.mapInPandas(keep, "label int, h long, own binary, twin binary").toPandas().sort_values(["h", "label"], kind="stable")
    own = [np.frombuffer(x, np.uint32) for x in few["own"]]
    twin = [None if x is None else np.frombuffer(x, np.uint32) for x in few["twin"]]
    return fit(few["label"].to_numpy(np.float64), own, twin)


def score(docs: DataFrame, model: dict, modulus: int = 5, fold: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs, from the whole text alone.

    Null and empty texts get the score of a text without words; texts of any length are scored whole. A null
    doc_id is not held out. Repeated rows give a row each; further columns are ignored; an empty table gives
    an empty result.
    """
    key = xxhash.xxh64_intdigest(repr(sorted(model["weights"].items())) + repr(model["bias"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use_cache("toxicity", _workers.clear)
        if key not in _workers:
            _workers.clear()
            _workers[key] = Features(set(model["weights"]))
        f = _workers[key]
        for b in batches:
            s = np.array([score_text(t, model, f) for t in b["text"]], np.float64)
            yield pd.DataFrame({"doc_id": b["doc_id"].array, "held_out": b["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})

    rows = as_input(docs, {"doc_id": "long", "text": "string"}).withColumn("held_out", held_out("doc_id", modulus, fold))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
