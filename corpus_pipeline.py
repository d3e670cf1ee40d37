"""A training corpus from raw documents: toxicity, line dedup, near-dedup, decontamination, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between stages
docs is a Parquet table. All stages but the last return the columns of documents; the last adds the
encoding. n_chars follows the text where a stage changes it.

Defined cases: the operators' own (see their modules); in short, null and empty texts pass every
filter, rows are judged one by one, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope.llm import decontaminate, line_dedup, near_dup, pieces, toxicity
from lexiscope.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    scored = toxicity.score_documents(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a later document holds; a document may be left with an empty text."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies: five words, Jaccard similarity of 0.8.

    At 0.8 seven trees leave 0.2 ** 7, about 1e-5, of pairs; fewer than 24 of 48 equal tokens, 1e-6.
    Rows go by doc_id and text, so of rows that repeat a doc_id only those with a near copy go.
    """
    rows = near_dup.judged_rows(docs.select("doc_id", "text"), k=5, threshold=80, trees=7, loose=0.5)
    gone = rows.where("NOT kept").select("doc_id", "row_hash").distinct()
    own = docs.select(*COLUMNS).withColumns({"_id": F.col("doc_id").cast("long"), "_hash": F.xxhash64("text")})
    return own.join(gone, (F.col("_id") == gone["doc_id"]) & (F.col("_hash") == gone["row_hash"]), "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    found = decontaminate.find_spans(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("spans") == 0).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and what the backward search finds next to the best; texts that decoding doesn't give back would stop the run."""
    out = pieces.encode_documents(docs.select(*COLUMNS), columns=("ids", "n_pieces", "score", "second_gap", "round_trip"), n=2)
    lost = F.raise_error(F.lit("ids don't give the text back"))
    return out.withColumn("ids", F.when(F.col("round_trip"), F.col("ids")).otherwise(lost.cast("array<int>"))).drop("round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", encode),
]
#: Toxicity, near-dedup and the piece lattice are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
