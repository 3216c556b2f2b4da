"""The corpus pipeline: stages over ``documents``, each a thin call of one operator.

Every stage takes all that the one before kept and its decisions take effect; all
but the last return the columns of ``documents``.  How each handles nulls, empty
and repeated rows is said in the operator's docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.llm.common import cut, read_table
from postline.llm.decontaminate import drop_contaminated
from postline.llm.line_dedup import dedup_lines
from postline.llm.sentence_pieces import round_trip_digests
from postline.llm.simhash import keep_first_of_group
from postline.llm.toxicity import drop_toxic


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def dedup_document_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, ``n_chars`` follows; a document that loses all its text goes."""
    lean = dedup_lines(docs, count_col="_lines_gone")
    emptied = (F.col("_lines_gone") > 0) & (F.trim(F.translate("text", "\n\t\r", "   ")) == "")
    changed = F.when(F.col("_lines_gone") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return lean.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", changed).drop("_lines_gone")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return keep_first_of_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to."""
    import public_tokenizers

    # a smaller cache than on its own: the executors still hold what the stages before needed
    return round_trip_digests(docs, public_tokenizers.path("piece_bpe_32k.model"), cache_parts=100_000)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_document_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: Classifier, fingerprints, seeds and tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
