"""The corpus pipeline: five stages from the operators of the llm subpackage, one after the other.

Each stage takes all that the one before kept. The first four return the columns of documents; the last
one returns token counts and digests of the texts that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shockline.llm import bpe, decontaminate, quality, simhash, substring
from shockline.llm.common import table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; its labels are the table's, its texts the stage's input."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-equal fingerprints."""
    return simhash.keep_one(docs)


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages cut out of all documents but the first that has them."""
    return substring.drop_repeats(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text."""
    import public_tokenizers as p

    return bpe.tokenize(docs, p.path("byte_bpe_multi_50k.tiktoken"), p.PATTERN)


STAGES = [
    ("quality classifier", good_documents),
    ("SimHash near-dedup", one_of_each),
    ("substring dedup", no_repeats),
    ("benchmark decontamination", no_benchmark),
    ("byte-level BPE", tokens),
]

#: A classifier and MinHash are not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between them the rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
