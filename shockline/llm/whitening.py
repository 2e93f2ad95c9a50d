"""Embedding whitening from an exact integer scatter (operator 11).

Entries become integers. Each task subtracts a fixed shift and multiplies blocks of rows: the numbers are split into
limbs of so few bits that a product of limb matrices has no rounding in doubles. Sums and cross-products leave
a task as limbs too and are added up as integers of any size. n X'X - SS' is formed from them exactly; only
then come doubles and the decomposition. A task sends d + 1 rows of d + 1 sums, for any number of vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_input, dropped, table, written

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Bits of a limb in products of matrices, and rows of a block: a sum of a block stays below 2 ** (2 * LIMB) * BLOCK = 2 ** 53.
LIMB, BLOCK = 20, 8192
#: Bits of a limb of sums that travel; so many of them add up to less than 2 ** 63.
SUM_LIMB, FLUSH = 40, 1 << 22
#: Blocks that a task adds up, and cells of matrices that it holds, before it sends its sums.
BLOCKS, CELLS = 256, 1 << 24
#: A model of at most so many bytes is broadcast to the Python workers; vectors join a larger one.
MODEL_BYTES = 64 << 20


def split(a: np.ndarray, bits: int) -> list[np.ndarray]:
    """Integers (int64, or Python's of any size) as sum of out[k] << (bits * k); all limbs but the last are 0 to 2**bits - 1, the last is signed and as small."""
    out, mask = [], (1 << bits) - 1
    while a.size and max(int(a.max()), -int(a.min())) > mask:
        out.append((a & mask).astype(np.int64))
        a = a >> bits
    return [*out, a.astype(np.int64)]


def products(a: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """a' a of up to BLOCK rows as a sum of exact int64 matrices, each shifted left by so many bits."""
    limbs = [x.astype(np.float64) for x in split(a, LIMB)]
    for i, x in enumerate(limbs):
        for j, y in enumerate(limbs):
            yield LIMB * (i + j), (x.T @ y).astype(np.int64)


def squares(z: np.ndarray) -> np.ndarray:
    """Exact sum of squares of each row, as Python integers."""
    limbs, total = split(z, LIMB), np.zeros(len(z), object)
    for i, x in enumerate(limbs):
        for j in range(i, len(limbs)):
            total += ((x * limbs[j]).sum(axis=1) * (1 if i == j else 2)).astype(object) << (LIMB * (i + j))
    return total


def integers(values: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """floor(scale * c) + offset of finite doubles, exact at any size: int64 where all fit, else Python's integers. scale: a power of two."""
    if np.abs(values).max(initial=0) < 2.0**51 / scale:
        return np.floor(values * scale).astype(np.int64) + offset
    # from 2 ** 53 on a double is an integer itself
    return np.array([(int(c) * scale if abs(c) >= 2.0**53 else math.floor(c * scale)) + offset for c in values.ravel().tolist()], object).reshape(values.shape)


def blocks(batch: pa.RecordBatch, scale: int, offset: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of a batch with a column v of finite doubles, for each length: the length, its rows' numbers, their integers."""
    v = batch["v"]
    sizes = pc.list_value_length(v).to_numpy()
    for d in np.unique(sizes):
        own = np.flatnonzero(sizes == d)
        yield int(d), own, integers(v.take(pa.array(own)).flatten().to_numpy().reshape(-1, d), scale, offset)


def clean(vectors: DataFrame) -> DataFrame:
    """vec_id and v: vectors without null or non-finite entries; empty ones have no components and go too."""
    v = as_input(vectors, {"vec_id": "long", "embedding": "array<double>"}).withColumnRenamed("embedding", "v")
    return v.where("size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")


def scatter(v: DataFrame, scale: int, offset: int, shift: int) -> DataFrame:
    """For each length d the d + 1 rows i of Y'Y, whose integers are exact, as text: Y has x - shift of each vector and a 1, so row d has the sums and n."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[int, np.ndarray]] = {}
        done = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for d, by_shift in held.items():
                for bits, total in by_shift.items():
                    for k, limb in enumerate(split(total, SUM_LIMB)):
                        head = [pa.array(np.full(d + 1, x, np.int32)) for x in (d, bits + SUM_LIMB * k)]
                        yield pa.RecordBatch.from_arrays([head[0], pa.array(np.arange(d + 1, dtype=np.int32)), head[1], pa.array(list(limb), pa.list_(pa.int64()))], names=["d", "i", "bits", "sums"])
            held.clear()

        for batch in batches:
            for d, _, x in blocks(batch, scale, offset):
                y = np.concatenate([x - shift, np.ones((len(x), 1), x.dtype)], axis=1)
                for at in range(0, len(y), BLOCK):
                    own = held.setdefault(d, {})
                    for bits, more in products(y[at : at + BLOCK]):
                        own[bits] = own[bits] + more if bits in own else more
                    done += 1
                    if done % BLOCKS == 0 or sum(m.size for o in held.values() for m in o.values()) > CELLS:
                        yield from sent()
        yield from sent()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Totals of this task's matrix rows: it holds these rows only, whatever the number of tasks that sent sums."""
        low: dict[tuple[int, int, int], np.ndarray] = {}
        total: dict[tuple[int, int], np.ndarray] = {}
        seen = 0

        def flush() -> None:
            for (d, i, bits), sums in low.items():
                total[d, i] = total.get((d, i), 0) + (sums.astype(object) << bits)
            low.clear()

        for batch in batches:
            for row, key in enumerate(zip(*(batch[c].to_pylist() for c in ("d", "i", "bits")), strict=True)):
                sums = batch["sums"][row].values.to_numpy()
                low[key] = low[key] + sums if key in low else sums
                seen += 1
                if seen % FLUSH == 0:
                    flush()
        flush()
        for (d, i), row in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([i], pa.int32()), pa.array([[str(x) for x in row]], pa.list_(pa.string()))], names=["d", "i", "row"])

    parts = v.mapInArrow(tasks, "d int, i int, bits int, sums array<long>")
    return written(parts.repartition("d", "i").mapInArrow(add, "d int, i int, row array<string>"), "scatter")


def model(sums: DataFrame, components: int) -> DataFrame:
    """A row for each length d: n, the sums S of shifted integers as text, e, explained, and w: components over sqrt(e), one after the other.

    The rows of the covariance are made in parallel; one task decomposes the d x d doubles of a length. Components without
    variance, those with e not above d * 2**-52 of the largest, can't be whitened and are left out.
    """
    s = sums.where("i = d").select("d", F.col("row").alias("s"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for i, row, s_ in zip(b["i"], b["row"], b["s"], strict=True):
                t, own = [int(x) for x in row], [int(x) for x in s_]
                n = own[-1]
                made.append([(n * x - own[i] * y) / (n * n) for x, y in zip(t[:-1], own[:-1], strict=True)])  # of two integers: correctly rounded
            yield pd.DataFrame({"d": b["d"], "i": b["i"], "v": made})

    def decompose(v: pd.DataFrame) -> pd.DataFrame:
        d = int(v["d"].iloc[0])
        cov = np.stack(v.sort_values("i")["v"].to_numpy())
        e, u = np.linalg.eigh(cov)
        e, u = e[::-1], u[:, ::-1]
        keep = int((e[:components] > max(d * 2.0**-52 * e[0], 0)).sum())
        total = float(np.trace(cov))
        return pd.DataFrame({"d": [d], "e": [e[:keep]], "explained": [e[:keep] / total if keep else []], "w": [(u[:, :keep] / np.sqrt(e[:keep])).T.ravel()]})

    cov = sums.where("i < d").join(s, "d").select("d", "i", "row", "s").mapInPandas(rows, "d int, i int, v array<double>")
    found = cov.groupBy("d").applyInPandas(decompose, "d int, e array<double>, explained array<double>, w array<double>")
    return written(found.join(s, "d"), "whitening_model")


def projected(v: DataFrame, fitted: DataFrame, scale: int, offset: int, shift: int) -> DataFrame:
    """vec_id, d, deviation (text of an integer of any size) and y, the whitened components."""
    size = fitted.agg(F.sum(F.size("w") * 8 + F.size("s") * 64)).first()[0] or 0
    known = {r["d"]: (r["s"], r["w"]) for r in fitted.collect()} if size <= MODEL_BYTES else None
    shared = v.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, own, x in blocks(batch, scale, offset):
                at = int(own[0])
                s, w = shared.value[d] if shared.value is not None else (batch["s"][at].as_py(), batch["w"][at].as_py())
                s, w = [int(t) for t in s], np.array(w).reshape(-1, d)
                n, most = s[-1], max(abs(int(x.max())), abs(int(x.min()))) + abs(shift)
                plain = x.dtype == np.int64 and n * most < 1 << 61 and max(map(abs, s)) < 1 << 61
                kind = np.int64 if plain else object
                z = n * (x.astype(kind) - shift) - np.array(s[:-1], kind)
                y = np.asarray(z / n, np.float64) @ w.T
                yield pa.RecordBatch.from_arrays([batch["vec_id"].take(pa.array(own)), pa.array(np.full(len(own), d, np.int32)), pa.array([str(t) for t in squares(z)]), pa.array(list(y), pa.list_(pa.float64()))], names=["vec_id", "d", "deviation", "y"])

    rows = v if known is not None else v.withColumn("d", F.size("v")).join(fitted.select("d", "s", "w"), "d").drop("d")
    return rows.mapInArrow(run, "vec_id long, d int, deviation string, y array<double>")


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, shift: int = OFFSET) -> DataFrame:
    """A row for each clean vector and component: vec_id, component, n, deviation (text), whitened, explained, identity_error.

    vectors: vec_id and embedding; further columns are ignored. Vectors that are null, empty or hold null or non-finite
    entries go. Vectors of different lengths have no common covariance: each length is fitted by itself, with n and
    identity_error of its own. Rows that repeat count, and are returned, as often as they occur; null ids pass through. Components
    without variance have no rows, so a single vector, or equal ones alone, give none. Equal eigenvalues: any order of theirs.
    An empty table gives no rows. Entries of any finite size are exact.
    An entry c is the integer floor(scale * c) + offset. The shift changes no result: it keeps the integers that are multiplied small.
    identity_error is measured over the whitened rows themselves, centred before they are multiplied.
    """
    v = clean(vectors)
    sums = scatter(v, scale, offset, shift)
    fitted = model(sums, components)
    dropped(sums)
    made = written(projected(v, fitted, scale, offset, shift), "whitened")
    means = made.select("d", F.posexplode("y")).groupBy("d", "pos").agg(F.avg("col").alias("m"))
    mean = means.groupBy("d").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("mean"))  # `components` values at most
    centred = made.join(mean, "d").select("d", F.zip_with("y", "mean", lambda a, b: a - b).alias("c"))
    pairs = centred.select("d", F.expr("posexplode(c) as (i, a)"), "c").select("d", "i", "a", F.expr("posexplode(slice(c, 1, i + 1)) as (j, b)"))
    cov = pairs.groupBy("d", "i", "j").agg(F.avg(F.col("a") * F.col("b")).alias("v"))
    error = cov.groupBy("d").agg(F.max(F.abs(F.col("v") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))).alias("identity_error"))
    about = written(fitted.select("d", F.element_at("s", -1).cast("long").alias("n"), "explained").join(error, "d"), "whitening_about")
    out = made.join(about, "d").select("vec_id", F.posexplode("y").alias("at", "whitened"), "n", "deviation", "explained", "identity_error")
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.expr("explained[at]").alias("explained"), "identity_error")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As whiten(); deviation as a long, null where it passes 63 bits; deviation_digits has all digits."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("deviation", "deviation_digits").withColumn("deviation", F.expr("try_cast(deviation_digits as long)"))
