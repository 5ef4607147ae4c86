"""One registered query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolake.llm import (
    chat, curves, decontaminate, encoding, gnat, html, jaccard, lm, packing, quality, toxicity, urls, whitening,
)
from ludolake.llm.common import ship_code, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return run


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1).select(
        "doc_id", "item_id", "equal", "span", "item_begin", "text_begin", "coverage")


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract_text(pages, html.learn_weights(pages))


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.judge_quality(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit_whitening(vectors)
    n, error = (model.n, model.identity_error) if model else (0, 0.0)
    return whitening.whiten(vectors, model).select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).alias("identity_error"))


@query
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.search_nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return gnat.mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


ORACLES["op7_chat_formatting"] = chat.ORACLE
ORACLES["op10_ngram_jaccard_join"] = jaccard.ORACLE
ORACLES["op13_hard_negatives"] = gnat.ORACLE
