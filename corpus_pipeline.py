"""From raw documents to packed training sequences; each stage is one operator of chatloom.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import materialize, table, unused
from chatloom.llm.nearcopies import keep_one
from chatloom.llm.packing import pack
from chatloom.llm.quality import fit_quality, score_quality
from chatloom.llm.toxicity import fit_toxicity, score_toxicity

#: Scores from which a document counts as toxic, and below which as of low quality.
TOXIC, LOW = 0.3, 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on all labels and all documents, doesn't reject.

    Null and empty texts count as texts without words; rows, repeated ones too, are judged one by one; an empty table stays empty.
    """
    model, name = fit_toxicity(docs, table(spark, sf_dir, "labels")), unused(docs, "score")
    return score_toxicity(docs, model, name=name).filter(F.col(name) < TOXIC).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules, fitted on the labels of the documents left, don't reject.

    Null and empty texts are judged by their statistics, which are zeros; rows, repeated ones too, are judged one by one; an
    empty table stays empty.
    """
    model, name = fit_quality(docs, table(spark, sf_dir, "labels")), unused(docs, "score")
    return score_quality(docs, model, name=name).filter(F.col(name) >= LOW).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    Null and empty texts are copies of each other; of repeated rows one stays; rows without an id all stay.
    """
    return keep_one(docs, words=5, similarity=0.8)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids over all documents kept; an empty one has its end id."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=0)


STAGES = [("toxicity", toxicity), ("quality classifier", quality), ("SimHash near-dedup", near_duplicates), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs


#: The classifiers and fingerprints are not expressible in SQL.
ORACLE_SQL = None
