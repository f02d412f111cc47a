"""Corpus preparation as five stages, each on all its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import decontam, langid, lines, pieces, simhash
from changeflow.llm.queries import PIECE_MODEL
from changeflow.llm.shared import drop_stored, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: documents whose language is not this many times as certain as a guess among
#: the learned languages are rejected
LEAST_LIFT = 1.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; null texts and texts
    without a letter go, and those of which it is not certain at all."""
    model = langid.train(docs)
    least = min(1.0, LEAST_LIFT / len(model.languages)) if model else 1.0
    found = langid.predict(docs.select(*COLUMNS), model)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_score") >= least)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents hold stay in the last one only; the
    text and its length are those after the cut. No document goes."""
    kept = lines.dedup_lines(docs.select(*COLUMNS))
    kept = kept.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.char_length("text").cast("long"))
    return kept.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    docs = docs.select(*COLUMNS)
    return simhash.keep_one(docs, simhash.near_duplicates(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they decode to its text."""
    vocabulary = pieces.load_vocabulary(PIECE_MODEL)
    both = pieces.decode(pieces.encode(docs.select(*COLUMNS), vocabulary), vocabulary)
    return both.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_ids"),
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("exact"))


STAGES = [("language ID", language), ("line dedup", line_dedup), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("SentencePiece encoding", encoding)]

#: language ID, SimHash and the encoding cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        after = stored(stage(spark, docs, sf_dir), "stage%d" % i)
        if i:
            drop_stored(docs)
        docs = after
    return docs
