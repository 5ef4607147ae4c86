"""Column statistics that stay exact without gathering a column in one place."""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.operators.frames import top_counts, unpivot_row, union_all

BUCKETS = 4096


LARGEST = sys.float_info.max


def _ordered(column: str) -> Column:
    """The column as finite doubles in the same order; null where it is NaN."""
    v = F.col(column).cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v), F.least(F.greatest(v, F.lit(-LARGEST)), F.lit(LARGEST)))


def order_statistics(df: DataFrame, wanted: dict[str, list[int]],
                     bounds: dict[str, tuple[float, float]]) -> dict[tuple[str, int], float]:
    """The values at the wanted ranks (from 0) of the non-null values of numeric columns.

    ``bounds`` gives each column's minimum and maximum. Every pass counts all open ranges, of all
    columns at once, into at most ``BUCKETS`` buckets each: partial aggregation on the executors,
    a bounded result on the driver. Ranges shrink to the bucket that holds the rank until it is a
    single value; two or three passes are usual. NaN counts as missing, infinities as the largest
    numbers there are; a pass that narrows no range ends the search with an error.
    """
    found: dict[tuple[str, int], float] = {}
    # (column, low, high) -> [(rank, how many values lie below low)]
    open_ranges = {(c, *bounds[c]): [(r, 0) for r in ranks] for c, ranks in wanted.items() if ranks}
    while open_ranges:
        for (c, low, high), ranks in list(open_ranges.items()):
            if low >= high:
                found.update({(c, rank): low for rank, _ in ranks})
                del open_ranges[(c, low, high)]
        if not open_ranges:
            break
        ranges = list(open_ranges.items())
        cells = []
        for i, ((c, low, high), _) in enumerate(ranges):
            v, scale = _ordered(c), 1.0 if math.isfinite(high - low) else 0.25
            width = high * scale - low * scale
            slot = F.least(F.floor((v * F.lit(scale) - F.lit(low * scale)) / F.lit(width) * F.lit(float(BUCKETS)))
                           .cast("int"), F.lit(BUCKETS - 1))
            cells.append(F.when(v.between(F.lit(low), F.lit(high)),
                                F.struct(F.lit(i).alias("range"), slot.alias("slot"), v.alias("v"))))
        inside = F.filter(F.array(*cells), lambda cell: cell.isNotNull())
        counted = (df.select(F.explode(inside).alias("cell"))
                   .groupBy("cell.range", "cell.slot")
                   .agg(F.count(F.lit(1)).alias("n"), F.min("cell.v").alias("low"), F.max("cell.v").alias("high"))
                   .orderBy("range", "slot").collect())
        before, open_ranges = set(open_ranges), {}
        for i, ((c, _, _), ranks) in enumerate(ranges):
            buckets = [row for row in counted if row["range"] == i]
            for rank, below in ranks:
                for row in buckets:
                    if below + row["n"] > rank:
                        open_ranges.setdefault((c, row["low"], row["high"]), []).append((rank, below))
                        break
                    below += row["n"]
        if before and set(open_ranges) == before:
            raise ArithmeticError(f"ranges that can't be narrowed: {sorted(before)}")
    return found


def exact_quantiles(df: DataFrame, columns: list[str],
                    probabilities: list[float]) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of the values of each column, without nulls and NaN."""
    values = {c: _ordered(c) for c in columns}
    row = df.agg(*[F.struct(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).alias(c)
                   for c, v in values.items()]).first()
    places = {c: [p * (row[c]["n"] - 1) for p in probabilities] for c in columns if row[c]["n"]}
    wanted = {c: sorted({r for x in at for r in (math.floor(x), math.ceil(x))}) for c, at in places.items()}
    known = order_statistics(df, wanted, {c: (row[c]["low"], row[c]["high"]) for c in places})

    def interpolated(c: str, x: float) -> float:
        low, high = known[(c, math.floor(x))], known[(c, math.ceil(x))]
        part = x - math.floor(x)
        if low == high or part == 0:
            return math.copysign(math.inf, low) if abs(low) == LARGEST else low
        return low * (1 - part) + high * part if not math.isfinite(high - low) else low + (high - low) * part

    return {c: [interpolated(c, x) for x in places[c]] if c in places else [None] * len(probabilities)
            for c in columns}


def impute_numeric_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing numbers replaced by the exact median of their column."""
    present = [c for c in columns if c in df.columns]
    medians = exact_quantiles(df, present, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m))
                           for c, (m,) in medians.items() if m is not None})


def impute_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing labels replaced by the most frequent one (smallest of tied labels)."""
    for c in columns:
        if c in df.columns:
            most = top_counts(df, c, 1).select(c).scalar()
            df = df.withColumn(c, F.coalesce(F.col(c), most))
    return df


def missing_values(df: DataFrame) -> DataFrame:
    """(column_name, missing) for columns that have missing values; one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return (unpivot_row(counts, "column_name", "missing", df.columns, "bigint")
            .filter(F.col("missing") > 0))


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std (sample), min, exact quartiles, max; one row per column."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])

    def stats(c: str) -> list[Column]:
        v = F.col(c).cast("double")
        return [F.struct(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                         F.min(v).alias("min"), F.max(v).alias("max")).alias(c)]

    one = df.agg(*[s for c in columns for s in stats(c)])

    def line(c: str) -> Column:
        p25, p50, p75 = (F.lit(q).cast("double") for q in quartiles[c])
        return F.struct(F.lit(c).alias("column_name"), F.col(c)["count"].alias("count"),
                        F.col(c)["mean"].alias("mean"), F.col(c)["std"].alias("std"),
                        F.col(c)["min"].alias("min"), p25.alias("p25"), p50.alias("p50"),
                        p75.alias("p75"), F.col(c)["max"].alias("max"))

    return one.select(F.inline(F.array(*[line(c) for c in columns])))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return top_counts(df, column, name="count")


# Name parts that flag a column as personal data.
PII_NAME_PARTS = ["email", "phone", "ssn", "address", "name", "id"]


def flag_pii(name: Column) -> Column:
    return F.lower(name).rlike("|".join(PII_NAME_PARTS))


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def profile_columns(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, nulls, distinct values, numeric range and PII flag of each column.

    Each column is its own aggregate over a scan that reads only that column. One combined
    aggregate would multiply every row by the number of exact distinct counts. Of wide values only two
    64-bit hashes travel, so an exact count never shuffles texts or arrays. Only numbers are aggregated to a range: an
    aggregate of text, even of nulls, would sort all rows.
    """
    lines = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        numeric = dtype.startswith(NUMERIC_TYPES)
        nullable_text = F.lit(None).cast("string")
        wide = dtype.startswith(("string", "binary", "array", "struct"))
        hashes = [F.when(c.isNotNull(), F.xxhash64(F.lit(salt), c)) for salt in ("first", "second")]
        distinct = (F.approx_count_distinct(c) if approximate else
                    F.count_distinct(*hashes) if wide else F.count_distinct(c))
        bounds = [F.min(c).cast("string").alias("min_value"), F.max(c).cast("string").alias("max_value")] if numeric else []
        line = df.select(c).agg(
            distinct.cast("bigint").alias("unique_values"), F.count_if(c.isNull()).alias("null_count"), *bounds)
        lines.append(line.select(
            F.lit(name).alias("column_name"), F.lit(dtype).alias("data_type"),
            (F.col("null_count") > 0).alias("nullable"), "unique_values", "null_count",
            *(["min_value", "max_value"] if numeric else [nullable_text.alias("min_value"), nullable_text.alias("max_value")]),
            flag_pii(F.lit(name)).alias("pii_flag")))
    return union_all(*lines)
