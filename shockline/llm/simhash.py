"""SimHash near-duplicates by vantage-point partitioning (operator 2).

Hamming distance over some of the bits never exceeds the whole distance, so it bounds it from below
and obeys the triangle inequality. Two fingerprints at k or fewer differing bits agree on at least
one of k+1 segments; there, their distances to any vantage point are equal. Each segment is one tree
whose shards are the shells around vantage points: with radius 0 no query crosses a shell border, so
a fingerprint is in k+1 shards. Inside a shard a vantage-point tree over all bits answers queries of
radius k: a branch is entered only if the triangle bounds allow it, and both are where the ball
overlaps the border. Shards that are too large are split once more by the bits that the segment
leaves, and then dealt out in pairs of blocks; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_input, block_pairs, connected_components, runs, table, written

BITS, SEED = 64, 42
#: Members of a block, of a shard that is split once more, and of a tree's leaf.
BLOCK, REFINE, LEAF = 4096, 65_536, 32
VANTAGE_POINTS = 8


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """0 where there is no word; with fewer words than a shingle has, their whole sequence is one."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - k + 1].tolist()
    h, total, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(starts)
    stops = ends[k - 1 :].tolist()
    for at in range(0, n, 65_536):
        values = np.array([h(joined[a:b], SEED) for a, b in zip(starts[at : at + 65_536], stops[at : at + 65_536], strict=True)], np.uint64)
        total += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


class VantageTree:
    """Fingerprints in a tree of balls; near() finds and removes those within a radius."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.alive, self.visited = points, np.ones(len(points), bool), 0
        self.root, self.leaf = None, leaf
        self.root = self.build(np.arange(len(points)))

    def build(self, own: np.ndarray):
        if len(own) <= self.leaf:
            return own
        centre = self.points[own[len(own) // 2]]
        d = np.bitwise_count(self.points[own] ^ centre).astype(np.int64)
        edge = int(np.median(d))
        inside = d <= edge
        if inside.all():
            inside, edge = d < edge, edge - 1
            if not inside.any():
                return own
        return centre, edge, self.build(own[inside]), self.build(own[~inside])

    def near(self, point: np.uint64, radius: int) -> np.ndarray:
        found, todo = [], [self.root]
        while todo:
            node = todo.pop()
            self.visited += 1
            if isinstance(node, tuple):
                d = int(np.bitwise_count(point ^ node[0]))
                if d - radius <= node[1]:
                    todo.append(node[2])
                if d + radius > node[1]:
                    todo.append(node[3])
            else:
                own = node[self.alive[node]]
                found.append(own[np.bitwise_count(self.points[own] ^ point) <= radius])
        out = np.concatenate(found)
        self.alive[out] = False
        return out


def stars(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what chains of distances up to the radius connect; fewer links than points."""
    tree, a, b = VantageTree(points), [], []
    for i in range(len(points)):
        if tree.alive[i]:
            tree.alive[i] = False
            todo = [i]
            while todo:
                got = tree.near(points[todo.pop()], radius)
                if len(got):
                    a.append(np.full(len(got), i))
                    b.append(got)
                    todo += got.tolist()
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, int), np.empty(0, int))


def shells(value: Column, bits: int) -> Column:
    """Distances of a segment's bits to the vantage points, as one number."""
    out = F.lit(0).cast("long")
    for i in range(VANTAGE_POINTS):
        centre = xxhash.xxh64_intdigest(f"vantage {i}") & ((1 << bits) - 1)
        out = F.shiftleft(out, 5).bitwiseOR(F.bit_count(value.bitwiseXOR(F.lit(centre))).cast("long"))
    return out


def shards(points: DataFrame, radius: int, refine: int = REFINE) -> DataFrame:
    """(fp, shard): any two fingerprints within the radius share a shard."""
    parts, width = radius + 1, BITS // (radius + 1)
    mask = (1 << width) - 1

    def segment(i: int) -> Column:
        return F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask))

    first = points.select("fp", F.explode(F.array(*(F.struct(F.lit(i).alias("tree"), shells(segment(i), width).alias("shell")) for i in range(parts)))).alias("s")).select("fp", "s.*")
    large = first.groupBy("tree", "shell").count().where(F.col("count") > refine).select("tree", "shell", F.lit(True).alias("large"))
    first = first.join(large, ["tree", "shell"], "left")
    small = first.where("large is null").select("fp", F.xxhash64("tree", "shell").alias("shard"))
    low = F.expr("fp & (shiftleft(1L, cast(tree * {w} as int)) - 1)".format(w=width))
    high = F.expr("shiftleft(shiftrightunsigned(shiftrightunsigned(fp, cast(tree * {w} as int)), {w}), cast(tree * {w} as int))".format(w=width))
    rest, sub = low.bitwiseOR(high), (BITS - width) // parts
    again = F.array(*(F.struct(F.lit(j).alias("j"), shells(F.shiftrightunsigned("rest", j * sub).bitwiseAND(F.lit((1 << sub) - 1)), sub).alias("s")) for j in range(parts)))
    split = first.where("large").withColumn("rest", rest).withColumn("x", F.explode(again)).select("fp", F.xxhash64("tree", "shell", "x.j", "x.s").alias("shard"))
    return small.unionByName(split)


def links(points: DataFrame, radius: int = 3, block: int = BLOCK, refine: int = REFINE) -> DataFrame:
    """src, dst: links between distinct fingerprints fp (long) that keep all components whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bounds, rows in runs(batches, ["shard", "lo", "hi"]):
            fp = rows["fp"].to_numpy().view(np.uint64)
            size = np.diff(bounds)
            end = np.repeat(bounds[1:], size)
            a, b = [], []
            few = np.repeat(size <= LEAF, size)  # trees of one leaf are scanned all at once
            for step in range(1, min(LEAF, size.max())):
                i = np.flatnonzero(few & (np.arange(len(fp)) + step < end))
                i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= radius]
                a.append(fp[i])
                b.append(fp[i + step])
            for k in np.flatnonzero(size > LEAF):
                own = fp[bounds[k] : bounds[k + 1]]
                i, j = stars(own, radius)
                a.append(own[i])
                b.append(own[j])
            if a:
                yield pd.DataFrame({"src": np.concatenate(a).view(np.int64), "dst": np.concatenate(b).view(np.int64)})

    dealt = block_pairs(shards(points, radius, refine), ["shard"], "fp", block)
    dealt = dealt.select("shard", "lo", "hi", "fp").repartition("shard", "lo", "hi").sortWithinPartitions("shard", "lo", "hi")
    return dealt.mapInPandas(run, "src long, dst long")


def fingerprints(docs: DataFrame, with_hash: bool = False) -> DataFrame:
    """doc_id, fp and, if asked for, a hash h of the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"].array, "fp": fp} | ({"h": b["h"].array} if with_hash else {}))

    rows = as_input(docs, {"doc_id": "long", "text": "string"})
    if with_hash:
        return rows.withColumn("h", F.xxhash64("text")).mapInPandas(run, "doc_id long, fp long, h long")
    return rows.mapInPandas(run, "doc_id long, fp long")


def components(fps: DataFrame, radius: int, block: int = BLOCK, refine: int = REFINE) -> DataFrame:
    """fp, component, component_id: the smallest doc_id that each distinct fingerprint reaches."""
    points = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    component = connected_components(links(points.select("fp"), radius, block, refine))
    joined = points.join(component.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    joined = written(joined, "components")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    return joined.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 3, block: int = BLOCK, refine: int = REFINE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of docs.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows give a row each.
    A null doc_id stays null; its component is the smallest id it reaches, null if it reaches none.
    Texts of any length are read whole. Of equal fingerprints the smallest id counts. Further columns
    are ignored; an empty table gives an empty result.
    """
    fps = written(fingerprints(docs), "fingerprints")
    named = components(fps, radius, block, refine).select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 3) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id, or of a null one if it has no other.

    Of several texts of that id in the component the one of the smallest hash stays; equal rows become one. Null
    and empty texts are one component. Columns of docs may have any names; an empty table gives an empty result.
    """
    fps = written(fingerprints(docs, with_hash=True), "fingerprints")
    rows = fps.join(components(fps, radius).select("fp", "component"), "fp")
    best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("best"))
    best = written(best.select(F.struct(F.col("best.doc_id").alias("id"), "best.h").alias("best")).distinct(), "decisions")
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("best.id")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("best.h"))
    kept = own.join(best, same, "left_semi").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
    return kept.dropDuplicates(["doc_id", "text"])


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
