"""The corpus pipeline: language, near-duplicates, repeated passages, mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cuelattice.llm import language, mixing, passages, pieces, simhash
from cuelattice.llm.common import materialise, table
from cuelattice.llm.queries import piece_model_path


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null and empty texts, texts without a
    letter, and any text of which no language has half the score. Null ids, sources and
    languages are no reason to go; repeated rows stay or go together."""
    return language.keep_identified(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id, null
    ids last; of repeated rows one. Texts without words are alike."""
    return simhash.keep_one(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that stand earlier too are cut out, whatever the ids;
    null and short texts stay as they are, and a document may end up empty."""
    return passages.remove_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are sampled and repeated to their target weights, null as a source of its
    own; rows alike in id and size are taken alike."""
    return mixing.mix_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document of the mix; null and empty texts have none."""
    return pieces.encode_documents(docs, piece_model_path())


STAGES = [("language", identified), ("near_duplicates", distinct), ("passages", unrepeated), ("mixing", mixed), ("pieces", encoded)]

#: Language identification and trained models are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again. An empty table
    gives an empty result at every stage; extra columns stay up to the last."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, "pipeline")
    return docs
