"""Row predicates. Null never passes: each predicate is False, not null, on missing input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Review-id category, pattern.
REVIEW_CATEGORIES = {
    "Action Games": "00[1-3]",
    "RPG Games": "00[4-6]",
    "Strategy Games": "00[7-9]",
}

# Log action patterns.
JOINED = "joined"
LEFT = "left|disconnect"
CONNECTION = "joined|left"

# Fields a streamed game must carry.
REQUIRED_GAME_FIELDS = ["app_id", "title", "price_final", "positive_ratio", "user_reviews"]


def moment(as_of: datetime | str | Column) -> Column:
    """``as_of`` as a timestamp column; every time-bounded function takes it as an argument."""
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def hours_before(as_of, hours: float) -> Column:
    return moment(as_of) - F.make_dt_interval(secs=F.lit(float(hours) * 3600))


def minutes_since(ts: Column, as_of) -> Column:
    """Whole minutes from ``ts`` to ``as_of`` (truncated)."""
    micros = F.unix_micros(moment(as_of)) - F.unix_micros(ts.cast("timestamp"))
    return (micros / F.lit(60_000_000)).cast("bigint")


def matches(column: Column, pattern: str) -> Column:
    return F.coalesce(column.rlike(pattern), F.lit(False))


def action_matches(pattern: str, column: str = "action") -> Column:
    """Case-insensitive search for the pattern in the action text."""
    return matches(F.col(column), f"(?i){pattern}")


def title_contains(query: str, column: str = "title") -> Column:
    """Case-insensitive literal containment."""
    return F.coalesce(F.contains(F.lower(F.col(column)), F.lower(F.lit(query))), F.lit(False))


def id_category(category: str, column: str = "review_id") -> Column:
    return matches(F.col(column), REVIEW_CATEGORIES[category])


def valid_games(df: DataFrame) -> DataFrame:
    """Games fit for clustering: ratio, reviews and price present, ratio within 0..100."""
    return df.filter(F.col("positive_ratio").between(0, 100)
                     & F.col("user_reviews").isNotNull() & F.col("price_final").isNotNull())


def required_fields_present(fields: list[str] | None = None) -> Column:
    checks = [F.col(c).isNotNull() for c in (fields or REQUIRED_GAME_FIELDS)]
    keep = checks[0]
    for check in checks[1:]:
        keep = keep & check
    return keep


def split_required(df: DataFrame, fields: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); each rejected row names the fields it lacks."""
    names = fields or REQUIRED_GAME_FIELDS
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in names]),
                       lambda name: name.isNotNull())
    return (df.filter(required_fields_present(names)),
            df.filter(~required_fields_present(names)).withColumn("missing_fields", missing))


def last_hours(df: DataFrame, ts_column: str, hours: float, as_of) -> DataFrame:
    """Rows from ``hours`` before ``as_of`` up to ``as_of``; plain range filters, so they are pushed down."""
    low, high = hours_before(as_of, hours), moment(as_of)
    kind = df.schema[ts_column].dataType.typeName()
    if kind == "string":
        return df.filter(F.try_to_timestamp(F.col(ts_column)).between(low, high))
    # bounds of the column's own type leave the column bare, which the file scan needs to skip data
    return df.filter(F.col(ts_column).between(low.cast(kind), high.cast(kind)))


def in_cluster(df: DataFrame, cluster: int | None) -> DataFrame:
    return df if cluster is None else df.filter(F.col("cluster") == F.lit(cluster))


def high_confidence(df: DataFrame, threshold: float = 0.7, label: str | None = None) -> DataFrame:
    kept = df.filter(F.col("sentiment_confidence") > F.lit(threshold))
    return kept if label is None else kept.filter(F.col("sentiment") == F.lit(label))


def errors_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("level") == F.lit("ERROR"))
