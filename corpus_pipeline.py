"""A training corpus from raw documents: language, repeated lines, near copies, mix, token ids.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs. All but the last return the columns
of documents (doc_id, text, lang, source, n_chars). Columns beyond these are dropped by the first stage.
The last returns doc_id, position (0-based place in the mix), n_ids, ids, round_trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import language_id, line_dedup, mixing, pieces, simhash
from reviewlens.llm.queries import MIX, MIX_OTHER
from reviewlens.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A prediction less likely than this is no prediction.
LEAST_SCORE = 0.5
_WORD = r"[^\x20\x09-\x0D]"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told. Rejected: null texts, texts without a letter, scores under
    LEAST_SCORE. A missing lang becomes the predicted one."""
    docs = docs.select(*COLUMNS)
    found = language_id.identified_rows(docs, language_id.fit(docs))
    told = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return told.select("row.*", "lang_pred").withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that resemble an earlier line; documents that lose all their words go."""
    kept = line_dedup.line_dedup(docs, carry=["lang", "source", "n_chars"])
    touched = F.size("removed_lines") > 0
    left = kept.filter(~touched | F.col("kept_text").rlike(_WORD))
    n_chars = F.when(touched, F.length("kept_text").cast("bigint")).otherwise(F.col("carried.n_chars"))
    return left.select(
        "doc_id", F.col("kept_text").alias("text"), "carried.lang", "carried.source", n_chars.alias("n_chars")
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id's, null ids last."""
    return simhash.first_of_groups(docs.select(*COLUMNS)).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    mixed = mixing.mix_sources(docs, MIX, other=MIX_OTHER, carry=["text", "lang", "n_chars"])
    return mixed.orderBy("position").select(
        "doc_id", "carried.text", "carried.lang", "source", "carried.n_chars"
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place in the mix, ids of every document, and whether they decode to its text.

    Files have no order of rows that a reader must keep, so the place is worked out again from the same
    documents; it depends on their values alone.
    """
    mixed = mixing.mix_sources(docs, MIX, other=MIX_OTHER, carry=["text", "lang", "n_chars"])
    placed = mixed.select("doc_id", "position", "carried.text")
    found = pieces.round_trip(placed, pieces.read_model(pieces.MODEL), carry=["position"])
    return found.select("doc_id", "position", "n_ids", "ids", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_copies),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: SQL has neither XXH64 nor the other stages' methods; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
