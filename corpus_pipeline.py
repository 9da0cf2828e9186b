"""A training-corpus pipeline: quality rules, quality classifier, line and near-duplicate removal, packing.

Each stage takes (session, documents, folder of the given tables); all but the last return documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import classifier, linededup, neardup, packing, rules
from wayfare.llm.common import free_names, staged, table, words_of
from wayfare.llm.queries import tokenizer_path
from wayfare.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail a base rule nor come from a rejected host."""
    configure(spark)
    return rules.kept_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier, fitted on the labelled ones among them, finds good."""
    configure(spark)
    return classifier.kept_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line is like; those that lose all their words so are gone."""
    configure(spark)
    names = free_names(docs, "n_lines", "n_dropped")
    cleaned = linededup.dedup_lines(docs, names=tuple(names))
    left = (F.col(names[1]) == 0) | (F.size(words_of(F.col("text"))) > 0)
    kinds = dict(docs.dtypes)
    n_chars = {"n_chars": F.length("text").cast(kinds["n_chars"])} if "n_chars" in kinds else {}
    return cleaned.where(left).withColumns(n_chars).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id; rows are judged one by one."""
    configure(spark)
    return neardup.without_copies(docs, percent=80, rows=4)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each span of the documents lies in sequences of 2048 tokens."""
    configure(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("packing", best_fit_packing),
]
#: The classifier and the packing cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
