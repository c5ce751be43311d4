"""A training corpus in five stages, each of which calls one operator of ``tillmark.llm``.

Every stage takes what its predecessor kept and returns the columns of ``documents``; the
last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmark.llm import bpe, packing, quality_rules, secrets, simhash, substrings
from tillmark.llm.common import set_apart, table
from tillmark.staging import stage, staging_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the references come from these documents."""
    inner, names = set_apart(docs, "text", "lang")
    judged = quality_rules.quality(inner, quality_rules.references(docs), carry=inner.columns)
    return judged.where("kept").select(*[F.col(n).alias(c) for c, n in names.items()])


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, three bits."""
    return simhash.keep_one(docs, length=3, bits=3)


def passage_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that an earlier document holds too.

    A text that loses nothing stays as it is; of another the kept words remain, joined by one
    space, and ``n_chars`` is set anew. A document that loses all its words goes.
    """
    inner, names = set_apart(docs, "doc_id", "text")
    made = substrings.deduplicate(inner, carry=inner.columns)
    cut = F.col("n_removed") > 0
    new = {
        "text": F.when(cut, F.col("kept")).otherwise(F.col("text")),
        "n_chars": F.when(cut, F.char_length("kept").cast("long")).otherwise(F.col(names["n_chars"])),
    }
    left = made.where((F.col("n_removed") < F.col("n_words")) | ~cut)
    return left.select(*[new.get(c, F.col(n)).alias(c) for c, n in names.items()])


def secret_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked, by way of a blob ledger for this run."""
    return secrets.redact(spark, docs, staging_path(spark, "ledger"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, bpe.vocabulary())


STAGES = [
    ("quality_rules", quality_filter),
    ("simhash_near_dedup", near_duplicate_filter),
    ("substring_dedup", passage_filter),
    ("secret_scans", secret_filter),
    ("packing", pack_sequences),
]

#: SQL expresses neither the divergence, the fingerprints nor the tokeniser; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
