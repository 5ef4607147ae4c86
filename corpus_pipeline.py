"""Training-data pipeline over ``documents``: each stage works on what its predecessor kept.

Quality rules, toxicity, near-copies and benchmark passages filter documents; the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ludolake.llm import decontaminate, jaccard, packing, quality, toxicity
from ludolake.llm.common import ship_code, stored, table
from ludolake.llm.queries import tokenizer_path

REMEMBERED = 48 << 20  # bytes of encoded pieces that a worker of the last stage keeps


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the risk-controlled cutoffs."""
    ship_code(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    ship_code(spark)
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by five words and 80%; a repeated row stays once."""
    ship_code(spark)
    return jaccard.keep_first(docs, size=5, percent=80)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    ship_code(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; its workers have served four stages, so they remember less than the operator alone."""
    ship_code(spark)
    return packing.pack(docs, tokenizer_path(), remembered=REMEMBERED)


STAGES = [("quality_rules", good_quality), ("toxicity", not_toxic), ("ngram_jaccard_join", one_of_each_group),
          ("benchmark_decontamination", no_benchmark), ("packing", packed)]

#: Thresholds, the label model and the tokenizer can't be said in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
