"""A training corpus from raw documents: the stages in order, each on all that the one before kept.

Every stage but the last returns the columns of documents. Rejected rows go: texts in no known
language, all but one document of each near-duplicate class, texts that hold benchmark
passages. Secrets are masked in place. The last stage returns token ids in place of texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.llm import decontaminate, forest, language, ledger, pieces
from vacancia.llm.common import saved, table

MIN_LANGUAGE_SCORE = 0.4  # share of a text's words in the learned languages together


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts of learned languages, one or several; a missing ``lang`` is filled in."""
    langs, logs = language.trained(docs)
    own = "_found_"
    while any(c.startswith(own) for c in docs.columns):
        own = "_" + own
    found = language.detected(docs, langs, logs, known=True, prefix=own)
    said = F.col(own + "lang_pred")
    if langs:
        found = found.where((said != language.UNKNOWN) & (F.col(own + "known") >= MIN_LANGUAGE_SCORE))
    return found.withColumn("lang", F.coalesce("lang", F.when(said != language.UNKNOWN, said))).select(*docs.columns)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return forest.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ledger.masked(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("secret scans", mask_secrets),
    ("SentencePiece encoding and decoding", encode_pieces),
]

ORACLE_SQL = None  # language mixtures, MinHash families and merge rounds have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
