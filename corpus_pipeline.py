"""The corpus pipeline: drop toxic documents, keep one of each group of near copies, cut
repeated passages, mix the sources, encode.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept.
All but the last give documents with their columns. ``run`` applies them in order; between
two stages the documents are written to the shared folder, so that a stage reads what is
settled and a lost executor costs no more than its part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm import fmindex, mixing, partenum, pieces, toxicity
from churnlake.llm.queries import TOXIC_FROM, piece_model
from churnlake.llm.rows import fresh
from churnlake.plans.bounded import freeze, frozen_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold. The model learns from the labelled
    ones among them."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh("toxicity", docs)
    return toxicity.score_texts(docs, model, score).filter(F.col(score) < TOXIC_FROM).drop(score)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar shingle sets: the smallest doc_id."""
    return partenum.one_per_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of smaller doc_id has too. A document that
    loses all its words stays, with an empty text."""
    return fmindex.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, pieces, exact`` of every document."""
    return pieces.encode_documents(docs, piece_model())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_of_near_copies),
    ("substring dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifier can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What earlier stages wrote is deleted as soon as the stage after
    them is written, but for the documents that the last one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with frozen_scope(spark) as whole:
        for i, (_, stage) in enumerate(STAGES[:-1]):
            with frozen_scope(spark) as own:
                docs = freeze(stage(spark, docs, sf_dir), f"stage_{i}")
                own.keep(docs)
        whole.keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
