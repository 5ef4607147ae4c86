"""Title search, listings and samples. Every top-k ends its sort key with the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludolake.functions.features import select_existing
from ludolake.functions.predicates import in_cluster, title_contains


def newest_first(df: DataFrame, limit: int, ts_column: str = "processed_at",
                 id_column: str = "event_id") -> DataFrame:
    return df.orderBy(F.col(ts_column).desc(), F.col(id_column)).limit(limit)


def paginate(df: DataFrame, limit: int = 100, offset: int = 0, order_by: str = "app_id",
             after: tuple | None = None, tie: str | None = None) -> DataFrame:
    """One page, with the total row count and whether more rows follow.

    A page by ``offset`` costs a task that reads offset + limit keys, so deep pages go by key: ``after`` is the
    (order_by, tie) pair of the last row seen, of any type, null keys first. It cuts the rows before they are ordered,
    and only a page's rows ever meet, however deep it lies.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    keys = [order_by] if tie is None else [order_by, tie]
    rows = df
    if after is not None:
        rows = df.filter(_beyond(keys, after))
    left = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    page = rows.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).offset(offset).limit(limit)
    return page.withColumn("total", total).withColumn("has_more", F.lit(offset + limit) < left)


def _beyond(keys: list[str], after: tuple) -> Column:
    """Rows ordered after the given key values; null is the first value of each key."""
    beyond = F.lit(False)
    for i, (key, value) in enumerate(zip(keys, after)):
        here = F.col(key).isNotNull() if value is None else F.coalesce(F.col(key) > F.lit(value), F.lit(False))
        for k, v in zip(keys[:i], after[:i]):
            here = here & F.col(k).eqNullSafe(F.lit(v))
        beyond = beyond | here
    return beyond


def title_match(query: str, exact: int, prefix: int, inside: int) -> Column:
    """Grade of a title that is known to contain the query."""
    title, wanted = F.lower(F.col("title")), F.lower(F.lit(query))
    return (F.when(title == wanted, F.lit(exact))
            .when(F.startswith(title, wanted), F.lit(prefix)).otherwise(F.lit(inside)))


def search_games(df: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """Best matching titles: exact, then prefix, then inside; more reviewed games first."""
    query = query.strip()
    found = df.filter(title_contains(query) & F.lit(bool(query)))
    total = found.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (found.withColumn("relevance_score", title_match(query, 100, 50, 10))
            .orderBy(F.col("relevance_score").desc(), F.col("user_reviews").desc(), F.col("app_id"))
            .limit(limit).withColumn("total_count", total))


def suggest_titles(df: DataFrame, query: str, limit: int = 8) -> DataFrame:
    """First titles holding the query; nothing for fewer than two characters."""
    query = query.strip()
    return (df.filter(title_contains(query) & F.lit(len(query) >= 2))
            .select("app_id", "title").orderBy("app_id").limit(limit))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, picked by a seeded hash of the key.

    The pick does not depend on partitioning or retries, unlike ``rand``.
    """
    ticket = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(ticket, F.col(key)).limit(n)


def sample_per_cluster(df: DataFrame, n: int = 5, cluster: str = "cluster",
                       order_by: str = "app_id") -> DataFrame:
    """The first ``n`` rows of each cluster.

    The rank filter is a window group limit: map tasks keep ``n`` rows per cluster before the
    shuffle, so a huge cluster sends no more than a small one.
    """
    rank = F.row_number().over(Window.partitionBy(cluster).orderBy(order_by))
    return df.withColumn("sample_rank", rank).filter(F.col("sample_rank") <= n)


def list_clustered(df: DataFrame, cluster: int | None = None, limit: int = 100, offset: int = 0,
                   include_features: bool = False) -> DataFrame:
    return paginate(select_existing(in_cluster(df, cluster), include_features=include_features),
                    limit, offset)
