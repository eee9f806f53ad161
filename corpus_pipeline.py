"""Training-corpus pipeline: documents in, packed token sequences out.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwright.llm import line_rules, ngram_join, packing, quality_model, substring_dedup
from logwright.llm.runtime import Shield, prepare, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the boosted trees score below the threshold."""
    prepare(spark)
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    shield = Shield(docs)
    scored = quality_model.score(shield.inner, model)
    return shield.restore(scored.filter(F.col("score") >= quality_model.THRESHOLD))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove boilerplate lines; drop documents that fail the rules or are depleted."""
    prepare(spark)
    return line_rules.apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    prepare(spark)
    return ngram_join.one_of_each(docs)


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that an earlier document holds."""
    prepare(spark)
    return substring_dedup.apply_dedup(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize and pack into sequences of 1024 tokens; each piece comes with its ids."""
    import public_tokenizers

    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True, added_tokens=True)


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", quality_rules),
          ("near_duplicates", near_duplicates), ("substring_duplicates", substring_duplicates),
          ("best_fit_packing", best_fit_packing)]

#: A fitted classifier and a packing search are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces, with their token ids, of all documents that the stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
