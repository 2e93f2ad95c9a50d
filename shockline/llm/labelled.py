"""Labelled rows for the classifiers: the stated fold left out, bounded by a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_input


def held_out(doc_id: str, modulus: int, fold: int) -> Column:
    """crc32 of the id as text, modulo; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == fold, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, column: str, modulus: int, fold: int, most: int) -> DataFrame:
    """(label, h, text) of at most `most` labelled documents outside the fold, those of the smallest id hashes.

    Rows without an id or with a label other than 0 and 1 don't count; of several labels for an id the
    largest holds, of several texts that of the smallest hash. So there are at most `most` rows, and the
    broadcast ids are as many. The documents are scanned once.
    """
    y = as_input(labels, {"doc_id": "long", column: "int"}).where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", modulus, fold))
    y = y.groupBy("doc_id").agg(F.max(column).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = as_input(docs, {"doc_id": "long", "text": "string"}).join(F.broadcast(y), "doc_id")
    one = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"))
    return one.select("label", "x.h", "x.text")
