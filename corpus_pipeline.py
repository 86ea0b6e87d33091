"""A corpus made ready for training: five stages over `documents`, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm import decontamination, lines, pieces, quality, simhash
from rosterloom.llm.queries import PIECE_MODEL, tokenizer_path
from rosterloom.llm.storage import stored, table, unused


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least 0.3, from a model fitted to labelled rows of `docs`."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "quality_score")
    return docs.withColumn(score, quality.scores(F.col("text"), model)).where(F.col(score) >= 0.3).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a larger id keeps; n_chars follows the text."""
    found = lines.with_kept_lines(docs)
    kept = F.col(f"{found.columns[-1]}.text")
    new = {"text": kept, "n_chars": F.char_length(kept).cast("long")}
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the smallest id, ties by a hash of the text, rows without an id last."""
    return simhash.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    found = decontamination.with_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col(f"{found.columns[-1]}.contaminated")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with the digest of its pieces and of the text decoded from them."""
    return pieces.piece_digest(docs, tokenizer_path(PIECE_MODEL))


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", encode),
]
#: The first stage is a trained model, the third needs XXH64: SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
