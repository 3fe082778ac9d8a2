"""The training-data pipeline: five stages over ``documents``.

Each stage reads what the stage before it kept, written as Parquet, and all but
the last return the columns of ``documents``.  ``run`` applies them in order;
the stages' tables go to the folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickyard.llm import bpe, decontaminate, near_dedup, quality_classifier, quality_rules
from tickyard.llm.common import stored
from tickyard.session import use_utc
from tickyard.sources.tables import table

SHINGLE_WORDS = 5     # near-duplicates: words per shingle
TOKENIZER = "byte_bpe_50k.json"


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that fail the base rules or their source's fences go."""
    return quality_rules.accepted(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents scored below one half go.  The model is fitted on
    labelled rows of the whole table, since the stage's own input has lost the
    bad examples already."""
    weights = quality_classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, weights)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each near-duplicate component stays."""
    return near_dedup.survivors(docs, SHINGLE_WORDS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: (doc_id, n_tokens, ids) of every document that is left."""
    ids = bpe.encode(docs, public_tokenizers.path(TOKENIZER))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("bpe", encode_stage),
]

#: The classifier and the encoder have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
