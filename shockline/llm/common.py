"""Helpers that several corpus operators share: scratch tables, word splitting, connected components."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII letters to lower case; other characters stay.
LOWER = {c: c + 32 for c in range(65, 91)}
#: Words of the fingerprint and shingle operators.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_made: list[tuple[SparkSession, str]] = []


_caches: dict[str, Callable[[], object]] = {}


def use_cache(owner: str, clear: Callable[[], object]) -> None:
    """A Python worker runs tasks of many operators; it keeps the caches of the one it runs now only."""
    if owner not in _caches:
        for other in list(_caches):
            _caches.pop(other)()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _caches[owner] = clear


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one where that is unset, in local mode only."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if root:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
        return root
    set_dir = spark.sparkContext.getCheckpointDir()
    if not set_dir:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='shockline-')}")
        set_dir = spark.sparkContext.getCheckpointDir()
    return set_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. It goes when the driver ends, or earlier by drop_scratch()."""
    path = f"{scratch_root(spark)}/shockline-{uuid.uuid4().hex}/{name}"
    if not _made:
        atexit.register(drop_scratch)
    _made.append((spark, path))
    return path


def drop_scratch() -> None:
    """Delete all scratch tables. Frames that read them can't be evaluated any more."""
    while _made:
        spark, path = _made.pop()
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001  the session has ended: the cluster's retention of the folder applies
            return


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors, evaluates df once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing reads any more."""
    for t in tables:
        delete(t.sparkSession, t.scratch)
        _made.remove((t.sparkSession, t.scratch))


def as_input(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Only the named columns, cast; others, whatever their names, go."""
    return df.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in wanted.items()))


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Nodes of an undirected graph with the smallest node that each can reach.

    edges: two long columns src, dst. Returns node, component for all nodes of edges between
    different nodes. Alternates large-star and small-star steps until the edge set stays the same.
    A step is grouped minima, which combine before their shuffle, and a join with them. Both sides of the
    join are written tables, so it has exchanges of its own, and adaptive execution splits the edges of a
    node that has very many. Each round is written to the shared folder; the one before then goes.
    """
    e = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct()
    e, seen = written(e, "edges0"), None
    for k in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"lowest{k + 1}")
        large = written(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), f"large{k + 1}")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), f"least{k + 1}")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        new = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"edges{k + 1}")
        dropped(e, low, large, least)
        e = new
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).cast("string")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.groupBy("u").agg(F.min("v").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.select(F.col("u").alias("node"), "component").unionByName(roots)


def block_pairs(members: DataFrame, key: list[str], order: str, block: int) -> DataFrame:
    """Deal the members of each key out to tasks of about two blocks, so that any two of them meet in one.

    Adds lo and hi, the numbers of the blocks that meet, and part, the member's own. A key with at
    most `block` members is one task (0, 0); a member that is alone in its key meets nobody and goes.
    A member's block is a hash of `order`, so no window gathers a key. The counts are a written table, so
    the join with them has exchanges of its own, or none, and a key with very many members is split.
    """
    counts = written(members.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1"), "members_of_keys")
    n = members.join(counts, key).withColumn("_b", F.ceil(F.col("_n") / F.lit(block)).cast("int"))
    n = n.withColumn("part", F.pmod(F.xxhash64(order), F.col("_b")).cast("int"))
    n = n.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
    return n.withColumn("lo", F.least("part", "_j")).withColumn("hi", F.greatest("part", "_j")).drop("_n", "_b", "_j")


def slices(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of a string column of about so many bytes each; a longer text is a range of its own."""
    at, held = 0, 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if held and held + n > most_bytes:
            yield at, k
            at, held = k, 0
        held += n
    if at < len(texts):
        yield at, len(texts)


def runs(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[tuple[np.ndarray, pd.DataFrame]]:
    """From batches sorted by the columns: whole runs of equal values, as bounds and the rows they cut."""
    carry: pd.DataFrame | None = None
    for b in batches:
        if carry is not None:
            b = pd.concat([carry, b], ignore_index=True)
        if not len(b):
            continue
        v = b[by].to_numpy()
        cut = np.flatnonzero((v[1:] != v[:-1]).any(axis=1)) + 1
        if not len(cut):
            carry = b
            continue
        yield np.r_[0, cut], b.iloc[: cut[-1]]
        carry = b.iloc[cut[-1] :].reset_index(drop=True)
    if carry is not None and len(carry):
        yield np.array([0, len(carry)]), carry
