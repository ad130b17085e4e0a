"""A training-corpus pipeline: each stage applies one of the corpus operators to all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm import langid, near_dedup, packing, quality, secrets
from rulecheck.llm.common import materialize, restore, shield, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough certainty (operator 5). Rejected: null texts, texts without a
    letter, scores under the calibrated threshold. The model learns from the labelled documents of the input."""
    model = langid.fit(docs)
    told = langid.predict(shield(docs, "text"), model).filter(~F.col("lang_rejected"))
    return told.select(*restore(told, docs.columns))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 9), a joint rule for each class of length certified on the table labels."""
    work = shield(docs, "doc_id", "text")
    told = quality.judge(work, table(spark, sf_dir, "labels"), keep_text=True, joint=True).filter("kept")
    return told.select(*restore(told, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies, that of the least doc_id (operator 1)."""
    return near_dedup.keep_one(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark (operator 4); n_chars, where there is one, follows the text."""
    work = secrets.redact(secrets.scan(shield(docs, "doc_id", "text")))
    size = F.char_length("text")
    return work.select(*restore(work, docs.columns)).withColumns({c: size.cast(docs.schema[c].dataType) for c in docs.columns if c == "n_chars"})


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their n_tokens (bytes and an end token), bucket, padded_length, batch and place (operator 8)."""
    return packing.pack(docs.withColumn("n_tokens", packing.byte_length(F.col("text"))), "n_tokens", "doc_id")


STAGES = [("language", language), ("quality", rules), ("near_duplicates", near_duplicates), ("secrets", redacted), ("packing", packed)]

#: SQL cannot express the trained model; tests/llm/test_pipeline.py holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again as the documents of the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{k}-{name}")
    return docs
