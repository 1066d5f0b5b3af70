"""From raw documents to packed training sequences: judge, deduplicate, redact, mix and pack.

Every stage but the last returns the columns of its input, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atlaslens.llm import mixing, ngram_join, packing, pii, quality
from atlaslens.llm.common import stage, table


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' votes find good.

    Null and empty texts are scored like any other; repeated rows share their fate. With no usable label all stay.
    """
    labels = table(spark, sf_dir, "labels").where(~quality.held_out())
    return quality.keep(docs, quality.train(docs, labels))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id.

    Of repeated rows one stays. Null texts and those without words stay all, as do texts that only rows without doc_id have.
    """
    return ngram_join.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind. Null texts stay null; repeated rows are redacted alike."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As much of every source as its weight asks for.

    Null sources are a source, the last. Rows without words are taken no words of and go. Ties of the order go to the
    smaller doc_id, then to the row's hash; repeated rows are taken one after another.
    """
    return mixing.mixed_documents(docs, mixing.plan_mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of equal capacity. A null text is empty and still has its end token; repeated rows are packed each."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", judge),
    ("n-gram jaccard join", deduplicate),
    ("pii", redact),
    ("mixing", mix),
    ("best-fit packing", pack),
]

#: Votes of neighbours and boosted trees have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again: the packed pieces of what is left of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
