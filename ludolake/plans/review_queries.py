"""Review text and sentiment (ids N, and the review metrics among A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ludolake.functions import text as tx
from ludolake.operators import reviews as rv
from ludolake.plans.registry import query
from ludolake.plans.text_sql import SCORED, clean_sql, context_sql, scored_sql


@query("n1_clean_review", f"SELECT review_id, {clean_sql('text')} AS clean FROM reviews")
def _(lake):
    return lake.reviews.select("review_id", tx.clean_review(F.col("text")).alias("clean"))


@query("n2_context_score", f"""
    WITH c AS (SELECT review_id, {clean_sql('text')} AS clean_text FROM reviews)
    SELECT review_id, round({context_sql('clean_text')}, 9) AS context FROM c""")
def _(lake):
    cleaned = lake.reviews.select("review_id", tx.clean_review(F.col("text")).alias("clean"))
    return cleaned.select("review_id", F.round(tx.context_score(F.col("clean")), 9).alias("context"))


# The scorer columns are arithmetic of the review numbers, so every branch of the rules is met.
SCORER_SQL = """
    SELECT review_id, (helpful_votes % 11) / 10.0e0 AS vader_pos, (total_votes % 7) / 10.0e0 AS vader_neg,
           (playtime_hours % 9) / 10.0e0 AS vader_neu, (helpful_votes % 21 - 10) / 10.0e0 AS vader_compound,
           (total_votes % 21 - 10) / 10.0e0 AS tb_polarity, (playtime_hours % 17 - 8) / 4.0e0 AS ctx FROM reviews"""


def _scorer_frame(lake):
    def tenth(column, modulus, shift=0, by=10.0):
        return (F.col(column) % modulus - shift) / F.lit(by)

    return lake.reviews.select(
        "review_id", tenth("helpful_votes", 11).alias("vader_pos"), tenth("total_votes", 7).alias("vader_neg"),
        tenth("playtime_hours", 9).alias("vader_neu"), tenth("helpful_votes", 21, 10).alias("vader_compound"),
        tenth("total_votes", 21, 10).alias("tb_polarity"),
        tenth("playtime_hours", 17, 8, 4.0).alias("context"))


ENSEMBLE_CTE = f"""s AS ({SCORER_SQL}), h AS (SELECT *, (tb_polarity + 1.0e0) / 2.0e0 AS half FROM s),
    e AS (SELECT review_id, ctx, vader_compound,
        (vader_pos * 1.2e0 + CASE WHEN tb_polarity > 0.1e0 THEN half WHEN tb_polarity < -0.1e0 THEN 0.0e0
                                  ELSE 0.2e0 END) / 2.0e0 AS p0,
        (vader_neg * 1.2e0 + CASE WHEN tb_polarity > 0.1e0 THEN 0.0e0 WHEN tb_polarity < -0.1e0 THEN abs(half)
                                  ELSE 0.2e0 END) / 2.0e0 AS q0,
        (vader_neu + CASE WHEN abs(tb_polarity) > 0.1e0 THEN 1.0e0 - abs(half) ELSE 0.6e0 END) / 2.0e0 AS u0
        FROM h)"""


def _rounded(df, *columns):
    return df.select("review_id", *[c for c in ("sentiment",) if c in df.columns],
                     *[F.round(c, 9).alias(c) for c in columns])


@query("n3_ensemble", f"""WITH {ENSEMBLE_CTE}
    SELECT review_id, round(p0, 9) AS pos, round(q0, 9) AS neg, round(u0, 9) AS neu FROM e""")
def _(lake):
    return _rounded(rv.ensemble(_scorer_frame(lake)), "pos", "neg", "neu")


@query("n3_ensemble_of_three", f"""WITH {ENSEMBLE_CTE},
    t AS (SELECT review_id, CASE WHEN helpful_votes % 5 > 0 THEN helpful_votes % 5 / 10.0e0 ELSE 0.33e0 END AS third FROM reviews)
    SELECT review_id, round((p0 * 2 + third) / 3.0e0, 9) AS pos, round((q0 * 2 + 0.33e0) / 3.0e0, 9) AS neg,
           round((u0 * 2 + 0.33e0) / 3.0e0, 9) AS neu FROM e JOIN t USING (review_id)""")
def _(lake):
    """A third scorer that gives one value, and that only for some reviews."""
    votes = lake.reviews.select("review_id", F.nullif(F.col("helpful_votes") % 5 / F.lit(10.0), F.lit(0.0)).alias("third_pos"))
    return _rounded(rv.ensemble(_scorer_frame(lake).join(votes, "review_id")), "pos", "neg", "neu")


BOOST = "least(abs(ctx) * 0.15e0, 0.4e0)"
LABEL_CTE = f"""{ENSEMBLE_CTE}, b AS (SELECT *,
        CASE WHEN ctx > 0 THEN least(1.0e0, p0 + {BOOST}) WHEN ctx < 0 THEN greatest(0.0e0, p0 - {BOOST} * 0.5e0)
             ELSE p0 END AS p1,
        CASE WHEN ctx > 0 THEN greatest(0.0e0, q0 - {BOOST} * 0.5e0) WHEN ctx < 0 THEN least(1.0e0, q0 + {BOOST})
             ELSE q0 END AS q1 FROM e),
    z AS (SELECT review_id, vader_compound, CASE WHEN p1 + q1 + u0 > 0 THEN p1 / (p1 + q1 + u0) ELSE p1 END AS pos,
        CASE WHEN p1 + q1 + u0 > 0 THEN q1 / (p1 + q1 + u0) ELSE q1 END AS neg,
        CASE WHEN p1 + q1 + u0 > 0 THEN u0 / (p1 + q1 + u0) ELSE u0 END AS neu FROM b),
    l AS (SELECT *, CASE WHEN neg > 0.35e0 AND neg > pos THEN 'negative'
                         WHEN pos > 0.35e0 AND pos > neg THEN 'positive' ELSE 'neutral' END AS sentiment,
        CASE WHEN neg > 0.35e0 AND neg > pos THEN neg WHEN pos > 0.35e0 AND pos > neg THEN pos
             ELSE greatest(neu, 0.4e0) END AS confidence FROM z)"""


@query("n4_adjust_and_label", f"""WITH {LABEL_CTE}
    SELECT review_id, sentiment, round(confidence, 9) AS confidence, round(pos, 9) AS pos, round(neg, 9) AS neg,
           round(neu, 9) AS neu FROM l""")
def _(lake):
    return _rounded(rv.adjust_and_label(rv.ensemble(_scorer_frame(lake))), "confidence", "pos", "neg", "neu")


@query("n5_compound_override", f"""WITH {LABEL_CTE},
    o AS (SELECT *, vader_compound < -0.5e0 AND sentiment <> 'negative' AS n,
                 vader_compound > 0.5e0 AND sentiment <> 'positive' AS p FROM l)
    SELECT review_id, CASE WHEN n THEN 'negative' WHEN p THEN 'positive' ELSE sentiment END AS sentiment,
           round(CASE WHEN n OR p THEN least(0.8e0, confidence + 0.2e0) ELSE confidence END, 9) AS confidence,
           round(CASE WHEN p THEN greatest(pos, 0.6e0) ELSE pos END, 9) AS pos,
           round(CASE WHEN n THEN greatest(neg, 0.6e0) ELSE neg END, 9) AS neg FROM o""")
def _(lake):
    labelled = rv.adjust_and_label(rv.ensemble(_scorer_frame(lake)))
    return _rounded(rv.compound_override(labelled), "confidence", "pos", "neg")


BLANKED = "(SELECT * EXCLUDE (text), CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 10 = 1 THEN '  9/10  ' " \
          "ELSE text END AS text FROM reviews)"


@query("n6_default_sentiment", f"""WITH {scored_sql(BLANKED, 'text')}
    SELECT review_id, sentiment, round(sentiment_confidence, 9) AS sentiment_confidence,
           round(positive_score, 9) AS positive_score, round(negative_score, 9) AS negative_score,
           round(neutral_score, 9) AS neutral_score FROM scored""")
def _(lake):
    blanked = lake.reviews.withColumn("text", F.when(F.col("doc_id") % 10 == 0, F.lit(None))
                                      .when(F.col("doc_id") % 10 == 1, F.lit("  9/10  ")).otherwise(F.col("text")))
    return _rounded(rv.score_reviews(blanked, "text"), "sentiment_confidence", "positive_score",
                    "negative_score", "neutral_score")


@query("n7_score_reviews", SCORED + """
    SELECT review_id, sentiment, round(sentiment_confidence, 9) AS sentiment_confidence,
           round(positive_score, 9) AS positive_score, round(negative_score, 9) AS negative_score,
           round(neutral_score, 9) AS neutral_score FROM scored""")
def score_all_reviews(lake):
    return _rounded(rv.score_reviews(lake.reviews, "text"), "sentiment_confidence", "positive_score",
                    "negative_score", "neutral_score")


@query("n8_pick_text_column", """
    SELECT review_id, length(review_text) AS n_chars FROM streamed_reviews""")
def _(lake):
    name = tx.pick_text_column(lake.streamed_reviews.columns)
    return lake.streamed_reviews.select("review_id", F.length(name).cast("bigint").alias("n_chars"))


@query("n9_synthetic_review", """
    SELECT review_id, 'Game review with ' || playtime_hours || ' hours played. Helpful votes: ' || helpful_votes
           || ', Total votes: ' || total_votes || '. ' || CASE WHEN helpful_votes > total_votes / 2.0e0
           THEN 'Highly recommended!' ELSE 'Could be better.' END AS synthetic_review FROM reviews""")
def _(lake):
    plain = lake.reviews.drop("text")
    base, name = rv.with_review_text(plain)
    return base.select("review_id", name)


SUMMARY = """count(*) AS total_reviews,
    round(100.0e0 * count(*) FILTER (sentiment = 'positive') / count(*), 2) AS positive_percentage,
    round(100.0e0 * count(*) FILTER (sentiment = 'negative') / count(*), 2) AS negative_percentage,
    round(100.0e0 * count(*) FILTER (sentiment = 'neutral') / count(*), 2) AS neutral_percentage,
    round(avg(sentiment_confidence), 3) AS average_confidence,
    round(50 + (100.0e0 * count(*) FILTER (sentiment = 'positive') / count(*)
                - 100.0e0 * count(*) FILTER (sentiment = 'negative') / count(*)) / 2, 2) AS sentiment_score"""
SURE = """count(*) FILTER (sentiment_confidence > 0.7e0) AS high_confidence_reviews,
    count(*) FILTER (sentiment_confidence > 0.7e0 AND sentiment = 'positive') AS positive_high_conf,
    count(*) FILTER (sentiment_confidence > 0.7e0 AND sentiment = 'negative') AS negative_high_conf"""


@query("n10_advanced_sentiment", SCORED + f" SELECT {SUMMARY}, {SURE} FROM scored")
def advanced(lake):
    return rv.advanced_sentiment(lake.reviews)


@query("a25_sentiment_summary", SCORED + f" SELECT {SUMMARY} FROM scored")
def _(lake):
    return rv.sentiment_summary(rv.score_reviews(lake.reviews, "text"))


@query("a26_confidence_counts", SCORED + f" SELECT {SURE} FROM scored")
def _(lake):
    return rv.confidence_counts(rv.score_reviews(lake.reviews, "text"))


@query("a24_basic_sentiment", """
    WITH c AS (SELECT count(*) AS n, count(*) FILTER (helpful_votes > total_votes / 2.0e0) AS h FROM reviews),
    p AS (SELECT n, 100.0e0 * h / n AS p, (n - h) / n * 100.0e0 * 0.7e0 AS q FROM c)
    SELECT n AS total_analyzed, round(50 + (p - q) / 2, 2) AS sentiment_score, 0.6e0 AS confidence,
           round(p, 2) AS positive_percentage, round(q, 2) AS negative_percentage,
           round(100 - p - q, 2) AS neutral_percentage FROM p""")
def _(lake):
    return rv.basic_sentiment(lake.reviews)


@query("a19_category_sentiment", SCORED + """, cat AS (
        SELECT 'Action Games' AS category, '00[1-3]' AS pattern UNION ALL SELECT 'RPG Games', '00[4-6]'
        UNION ALL SELECT 'Strategy Games', '00[7-9]')
    SELECT category, count(review_id) AS reviews, coalesce(round(50 + (
        100.0e0 * count(*) FILTER (sentiment = 'positive') / nullif(count(review_id), 0)
        - 100.0e0 * count(*) FILTER (sentiment = 'negative') / nullif(count(review_id), 0)) / 2, 2), 50.0e0)
        AS sentiment_score
    FROM cat LEFT JOIN scored ON regexp_matches(review_id, pattern) GROUP BY category""")
def _(lake):
    return rv.category_sentiment(lake.reviews)
