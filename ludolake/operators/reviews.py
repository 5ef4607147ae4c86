"""Review sentiment: row scoring, label rules and the summaries built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludolake.functions.predicates import REVIEW_CATEGORIES, id_category
from ludolake.functions.text import (clean_review, context_score, let, pick_text_column,
                                     synthetic_review)

# Rule constants of the ensemble.
LEXICON_BOOST = 1.2
POLARITY_BAND = 0.1
FLAT_POLARITY = {"pos": 0.2, "neg": 0.2, "neu": 0.6}
CONTEXT_STEP = 0.15
CONTEXT_LIMIT = 0.4
LABEL_THRESHOLD = 0.35
NEUTRAL_CONFIDENCE = 0.4
COMPOUND_LIMIT = 0.5
DEFAULT_SCORES = {"confidence": 0.5, "positive": 0.33, "negative": 0.33, "neutral": 0.34}
HIGH_CONFIDENCE = 0.7

SCORER_FIELDS = ["vader_pos", "vader_neu", "vader_neg", "vader_compound", "tb_polarity"]
THIRD_FIELDS = ["third_pos", "third_neg", "third_neu"]
THIRD_DEFAULT = 0.33  # fixed value


def _start(scorers: dict[str, Column]) -> dict[str, Column]:
    """pos, neg, neu as the mean over the scorers.

    An absent value of the first two counts as 0, of the third scorer as ``THIRD_DEFAULT``.
    """
    def given(name: str, absent: float = 0.0) -> Column:
        return F.coalesce(scorers[name].cast("double"), F.lit(absent)) if name in scorers else F.lit(absent)

    polarity = given("tb_polarity")
    half = (polarity + F.lit(1.0)) / F.lit(2.0)
    up, down = polarity > POLARITY_BAND, polarity < -POLARITY_BAND
    by_polarity = {
        "pos": F.when(up, half).when(down, F.lit(0.0)).otherwise(F.lit(FLAT_POLARITY["pos"])),
        "neg": F.when(up, F.lit(0.0)).when(down, F.abs(half)).otherwise(F.lit(FLAT_POLARITY["neg"])),
        "neu": F.when(up | down, F.lit(1.0) - F.abs(half)).otherwise(F.lit(FLAT_POLARITY["neu"])),
    }
    by_lexicon = {
        "pos": given("vader_pos") * F.lit(LEXICON_BOOST),
        "neg": given("vader_neg") * F.lit(LEXICON_BOOST),
        "neu": given("vader_neu"),
    }
    parts = ("pos", "neg", "neu")
    if any(f in scorers for f in THIRD_FIELDS):
        return {p: (by_lexicon[p] + by_polarity[p] + given(f"third_{p}", THIRD_DEFAULT)) / F.lit(3.0) for p in parts}
    return {p: (by_lexicon[p] + by_polarity[p]) / F.lit(2.0) for p in parts}


def ensemble(df: DataFrame) -> DataFrame:
    """Adds ``pos``, ``neg``, ``neu`` from whichever scorer columns the frame has.

    With any of ``third_pos/third_neg/third_neu`` present the mean is over three scorers.
    """
    known = {c: F.col(c) for c in SCORER_FIELDS + THIRD_FIELDS if c in df.columns}
    return df.withColumns(_start(known))


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def _adjusted(s: Column) -> Column:
    """(pos, neg, neu, context) to (sentiment, confidence, pos, neg, neu)."""
    def shift(s):
        ctx = s["context"]
        boost = F.least(F.abs(ctx) * F.lit(CONTEXT_STEP), F.lit(CONTEXT_LIMIT))

        def raised(c):
            return F.least(F.lit(1.0), s[c] + boost)

        def lowered(c):
            return F.greatest(F.lit(0.0), s[c] - boost * F.lit(0.5))

        return _struct(
            pos=F.when(ctx > 0, raised("pos")).when(ctx < 0, lowered("pos")).otherwise(s["pos"]),
            neg=F.when(ctx > 0, lowered("neg")).when(ctx < 0, raised("neg")).otherwise(s["neg"]),
            neu=s["neu"])

    def normalise(s):
        total = s["pos"] + s["neg"] + s["neu"]
        return _struct(**{c: F.when(total > 0, s[c] / total).otherwise(s[c]) for c in ("pos", "neg", "neu")})

    def label(s):
        negative = (s["neg"] > LABEL_THRESHOLD) & (s["neg"] > s["pos"])
        positive = (s["pos"] > LABEL_THRESHOLD) & (s["pos"] > s["neg"])
        return _struct(
            sentiment=F.when(negative, F.lit("negative")).when(positive, F.lit("positive"))
                       .otherwise(F.lit("neutral")),
            confidence=F.when(negative, s["neg"]).when(positive, s["pos"])
                        .otherwise(F.greatest(s["neu"], F.lit(NEUTRAL_CONFIDENCE))),
            pos=s["pos"], neg=s["neg"], neu=s["neu"])

    return let(let(let(s, shift), normalise), label)


def _overridden(s: Column, compound: Column) -> Column:
    """A strong compound score overrules a disagreeing label."""
    def apply(s):
        to_negative = (compound < -COMPOUND_LIMIT) & (s["sentiment"] != "negative")
        to_positive = (compound > COMPOUND_LIMIT) & (s["sentiment"] != "positive")
        stronger = F.least(F.lit(0.8), s["confidence"] + F.lit(0.2))
        return _struct(
            sentiment=F.when(to_negative, F.lit("negative")).when(to_positive, F.lit("positive"))
                       .otherwise(s["sentiment"]),
            confidence=F.when(to_negative | to_positive, stronger).otherwise(s["confidence"]),
            pos=F.when(to_positive, F.greatest(s["pos"], F.lit(0.6))).otherwise(s["pos"]),
            neg=F.when(to_negative, F.greatest(s["neg"], F.lit(0.6))).otherwise(s["neg"]),
            neu=s["neu"])

    return let(s, apply)


def _or_default(s: Column, clean: Column) -> Column:
    """Fixed neutral scores where there is no usable text."""
    d = DEFAULT_SCORES
    default = _struct(sentiment=F.lit("neutral"), confidence=F.lit(d["confidence"]),
                      pos=F.lit(d["positive"]), neg=F.lit(d["negative"]), neu=F.lit(d["neutral"]))
    return F.when(F.coalesce(clean, F.lit("")) == "", default).otherwise(s)


def _replace(df: DataFrame, scores: Column) -> DataFrame:
    """The frame with the fields of a score struct in place of columns of the same names."""
    fields = ["sentiment", "confidence", "pos", "neg", "neu"]
    return df.withColumn("__score", scores).select(
        *[c for c in df.columns if c not in fields], *[F.col(f"__score.{f}").alias(f) for f in fields])


def adjust_and_label(df: DataFrame, context: str = "context") -> DataFrame:
    """Shifts pos/neg by the context score, normalises, then sets ``sentiment`` and ``confidence``."""
    return _replace(df, _adjusted(F.struct("pos", "neg", "neu", F.col(context).alias("context"))))


def compound_override(df: DataFrame, compound: str = "vader_compound") -> DataFrame:
    if compound not in df.columns:
        return df
    given = F.coalesce(F.col(compound).cast("double"), F.lit(0.0))
    return _replace(df, _overridden(F.struct("sentiment", "confidence", "pos", "neg", "neu"), given))


def score_reviews(df: DataFrame, text_column: str, scorer=None) -> DataFrame:
    """Adds sentiment, sentiment_confidence, positive_score, negative_score, neutral_score.

    ``scorer`` may be any Arrow ``pandas_udf`` from cleaned text to a struct with fields out of
    ``SCORER_FIELDS`` / ``THIRD_FIELDS``. Without one the ensemble starts from its defaults and
    the whole scoring is column expressions.
    """
    own = [c for c in df.columns if c not in OUTPUT_COLUMNS]
    if scorer is None:
        scores = let(clean_review(F.col(text_column)), lambda clean: _or_default(
            _adjusted(_struct(context=context_score(clean), **_start({}))), clean))
        staged = df
    else:
        staged = df.withColumn("__clean", clean_review(F.col(text_column)))
        staged = staged.withColumn("__raw", scorer(F.col("__clean")))
        given = {f: F.col(f"__raw.{f}") for f in staged.schema["__raw"].dataType.fieldNames()}
        compound = F.coalesce(given.get("vader_compound", F.lit(0.0)).cast("double"), F.lit(0.0))
        start = _struct(context=context_score(F.col("__clean")), **_start(given))
        scores = _or_default(_overridden(_adjusted(start), compound), F.col("__clean"))
    fields = dict(zip(OUTPUT_COLUMNS, ("sentiment", "confidence", "pos", "neg", "neu")))
    return (staged.withColumn("__score", scores)
            .select(*own, *[F.col(f"__score.{f}").alias(name) for name, f in fields.items()]))


OUTPUT_COLUMNS = ["sentiment", "sentiment_confidence", "positive_score", "negative_score", "neutral_score"]


def _score_from(positive_pct: Column, negative_pct: Column) -> Column:
    return F.lit(50.0) + (positive_pct - negative_pct) / F.lit(2.0)


def _basic_aggregates() -> list[Column]:
    helpful = F.col("helpful_votes") > F.col("total_votes") / F.lit(2)
    return [F.count_if(helpful).alias("helpful_n"), F.count(F.lit(1)).alias("total_analyzed")]


def _basic_columns(df: DataFrame) -> DataFrame:
    n = F.col("total_analyzed")
    pos = F.try_divide(F.col("helpful_n"), n) * F.lit(100.0)
    neg = F.try_divide(n - F.col("helpful_n"), n) * F.lit(100.0) * F.lit(0.7)
    filled = n > 0
    raw = df.withColumns({"p": pos, "q": neg})
    pick = lambda value, empty: F.when(filled, F.round(value, 2)).otherwise(F.lit(empty))
    return raw.withColumns({
        "sentiment_score": pick(_score_from(F.col("p"), F.col("q")), 50.0),
        "confidence": F.when(filled, F.lit(0.6)).otherwise(F.lit(0.0)),
        "positive_percentage": pick(F.col("p"), 33.33),
        "negative_percentage": pick(F.col("q"), 33.33),
        "neutral_percentage": pick(F.lit(100.0) - F.col("p") - F.col("q"), 33.34),
    }).drop("helpful_n", "p", "q")


def basic_sentiment(df: DataFrame) -> DataFrame:
    """Vote-based sentiment of a whole frame; one row also when the frame is empty."""
    return _basic_columns(df.agg(*_basic_aggregates()))


def _summary_aggregates() -> list[Column]:
    labels = ("positive", "negative", "neutral")
    return ([F.count(F.lit(1)).alias("total_reviews")]
            + [F.count_if(F.col("sentiment") == lab).alias(f"{lab}_n") for lab in labels]
            + [F.avg("sentiment_confidence").alias("mean_confidence")])


def _summary_columns(df: DataFrame) -> DataFrame:
    pct = {lab: F.coalesce(F.try_divide(F.col(f"{lab}_n"), F.col("total_reviews")) * F.lit(100.0), F.lit(0.0))
           for lab in ("positive", "negative", "neutral")}
    return df.withColumns({
        **{f"{lab}_percentage": F.round(p, 2) for lab, p in pct.items()},
        "average_confidence": F.coalesce(F.round("mean_confidence", 3), F.lit(0.0)),
        "sentiment_score": F.round(_score_from(pct["positive"], pct["negative"]), 2),
    }).drop("positive_n", "negative_n", "neutral_n", "mean_confidence")


def sentiment_summary(scored: DataFrame) -> DataFrame:
    return _summary_columns(scored.agg(*_summary_aggregates()))


def _confidence_aggregates(threshold: float = HIGH_CONFIDENCE) -> list[Column]:
    sure = F.col("sentiment_confidence") > F.lit(threshold)
    return [
        F.count_if(sure).alias("high_confidence_reviews"),
        F.count_if(sure & (F.col("sentiment") == "positive")).alias("positive_high_conf"),
        F.count_if(sure & (F.col("sentiment") == "negative")).alias("negative_high_conf"),
    ]


def confidence_counts(scored: DataFrame, threshold: float = HIGH_CONFIDENCE) -> DataFrame:
    return scored.agg(*_confidence_aggregates(threshold))


def with_review_text(df: DataFrame) -> tuple[DataFrame, str]:
    """The frame and its text column; a synthetic text is added when there is none."""
    name = pick_text_column(df.columns)
    if name:
        return df, name
    return df.withColumn("synthetic_review", synthetic_review(df.columns)), "synthetic_review"


def advanced_sentiment(df: DataFrame, scorer=None, sample_size: int | None = None,
                       order_by: str = "review_id", use_text: bool = True) -> DataFrame:
    """Summary of the scored reviews with confidence counts, in one pass over the frame.

    ``sample_size`` limits the work to the first reviews by ``order_by``; by default all are
    scored. ``use_text=False`` gives the vote-based form with the same leading columns.
    """
    if not use_text:
        return basic_sentiment(df)
    base, text = with_review_text(df)
    if sample_size is not None:
        base = base.orderBy(order_by).limit(sample_size)
    scored = score_reviews(base, text, scorer)
    return _summary_columns(scored.agg(*_summary_aggregates(), *_confidence_aggregates()))


def review_categories(df: DataFrame) -> DataFrame:
    """One row per review and matching id category."""
    hits = F.filter(F.array(*[F.when(id_category(name), F.lit(name)) for name in REVIEW_CATEGORIES]),
                    lambda name: name.isNotNull())
    return df.withColumn("category", F.explode(hits))


def category_sentiment(df: DataFrame, per_category: int | None = None, scorer=None) -> DataFrame:
    """Sentiment score per id category; a category without reviews scores 50.

    Each review is scored once and then counted into every category it matches, so no group is
    gathered in one place. ``per_category`` keeps the first reviews by id of each category; the
    window limit is applied before the shuffle.
    """
    base, text = with_review_text(df)
    if per_category is not None:
        tagged = review_categories(base)
        first = Window.partitionBy("category").orderBy("review_id")
        kept = tagged.withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= per_category)
        scored = score_reviews(kept, text, scorer)
        aggregates = [agg for name in REVIEW_CATEGORIES
                      for agg in _category_aggregates(name, F.col("category") == name)]
    else:
        scored = score_reviews(base, text, scorer)
        aggregates = [agg for name in REVIEW_CATEGORIES
                      for agg in _category_aggregates(name, id_category(name))]
    one_row = scored.agg(*aggregates)
    rows = F.array(*[_category_row(name) for name in REVIEW_CATEGORIES])
    return one_row.select(F.inline(rows))


def _category_aggregates(name: str, member: Column) -> list[Column]:
    return [F.count_if(member).alias(f"{name}|n"),
            F.count_if(member & (F.col("sentiment") == "positive")).alias(f"{name}|p"),
            F.count_if(member & (F.col("sentiment") == "negative")).alias(f"{name}|q")]


def _category_row(name: str) -> Column:
    n, p, q = (F.col(f"`{name}|{part}`") for part in ("n", "p", "q"))
    score = _score_from(F.try_divide(p, n) * F.lit(100.0), F.try_divide(q, n) * F.lit(100.0))
    return F.struct(F.lit(name).alias("category"), n.alias("reviews"),
                    F.coalesce(F.round(score, 2), F.lit(50.0)).alias("sentiment_score"))
