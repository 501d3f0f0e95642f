"""The corpus pipeline: five stages over ``documents``, each the next one's input.

Toxic documents go, then exact copies (the largest id stays), then all but one
document of each group of near duplicates (the smallest id stays), then the
bytes of long repeats; what remains is packed into training sequences. Every
stage is written as Parquet and read back before the next one starts, so a
stage works on all rows that its predecessor kept, and a lost executor never
costs more than the stage it was working on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm.common import stored, table, tokenizer_path
from ledgerlens.llm.exact_dedup import drop_copies
from ledgerlens.llm.jaccard_join import keep_one_of_each
from ledgerlens.llm.packing import best_fit_packing
from ledgerlens.llm.suffix_dedup import remove_repeats
from ledgerlens.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents, the one with the smallest id."""
    return keep_one_of_each(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeat a document of smaller id."""
    return remove_repeats(docs, chars_col="n_chars")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts as pieces with their places in training sequences."""
    return best_fit_packing(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("n-gram jaccard join", near_stage),
    ("suffix-array dedup", suffix_stage),
    ("best-fit packing", packing_stage),
]

#: No SQL for a trained model and tokenizers; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k}")
    return docs
