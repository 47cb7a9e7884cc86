"""The training-data pipeline: five stages, each one of the operators in dimsmith.llm.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame; it is
written as Parquet and reread as the next one's docs. All but the last return
the columns of ``documents``. ``run`` applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.llm import aho_viterbi, pii_disclosure, quality_cascade, simhash_neardup, suffix_decontamination
from dimsmith.llm.common import documents, shared_folder, tune


# The stages' Python workers live on from stage to stage, side by side with a
# full heap, so they work on small Arrow batches and remember fewer words.
BATCH = (2 << 20, 500)
WORDS_KEPT = 40_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    tune(spark, *BATCH)
    return quality_cascade.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits)."""
    tune(spark, *BATCH)
    return simhash_neardup.deduplicate(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark spans; mostly contaminated documents go."""
    tune(spark, *BATCH)
    return _measured(suffix_decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data generalised or removed."""
    tune(spark, *BATCH)
    return _measured(pii_disclosure.sanitise(docs))


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids (piece ids) and n_pieces."""
    tune(spark, *BATCH)
    return aho_viterbi.encode(docs.select("doc_id", "source", "text"), words_kept=WORDS_KEPT).select(
        "doc_id", "source", "ids", F.size("ids").cast("long").alias("n_pieces"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("pii", pii), ("sentencepiece", sentencepiece)]

#: SQL can't express the stages; the tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written to the shared folder and reread."""
    tune(spark, *BATCH)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
