"""Global row numbers over range partitions: no task and no driver holds more than one range of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolake.session import scratch_path

_PART, _WITHIN = "__range", "__within"
_BITS = 33  # monotonically_increasing_id: partition number above, row of the partition in the lower bits


class RankIndex:
    """The rows of a frame stored in key order, one folder for each range of keys.

    ``order`` must end with a unique key: equal keys share a range. Any type orders, nulls as the columns say. An empty
    frame has no ranges and empty pages. The ranges are written once by one job, so numbers never change between reads.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    @classmethod
    def build(cls, df: DataFrame, order: list[Column], ranges: int | None = None) -> RankIndex:
        """Sorts by range (``ranges`` of them, else as many as the session's shuffles make) and writes."""
        path = scratch_path(df.sparkSession, "ranks")
        spread = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
        place = F.monotonically_increasing_id()
        (spread.sortWithinPartitions(*order).withColumn("__id", place)
         .withColumns({_PART: F.shiftright("__id", _BITS).cast("int"), _WITHIN: F.col("__id").bitwiseAND((1 << _BITS) - 1)})
         .drop("__id").write.partitionBy(_PART).parquet(path))
        return cls(df.sparkSession, path, df.schema)

    def _stored(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(_WITHIN, T.LongType()), T.StructField(_PART, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def ranges(self) -> DataFrame:
        """(range, begin, n): a row for each range, so bounded by the number of partitions, whatever the rows."""
        counts = self._stored().groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy(F.lit(0)).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0)))

    def numbered(self, name: str = "place") -> DataFrame:
        """All rows with their number from 0."""
        begins = F.broadcast(self.ranges().select(_PART, "begin"))
        rows = self._stored().join(begins, _PART)
        return rows.select(*[F.col(f"`{c}`") for c in self.schema.names],
                           (F.col("begin") + F.col(_WITHIN)).alias(name))

    def page(self, offset: int, limit: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit``, the total, and whether more rows follow.

        Only folders of ranges that meet the page are read, so a page costs the same at any depth.
        """
        ranges = self.ranges()
        meeting = ranges.filter((F.col("begin") < offset + limit) & (F.col("begin") + F.col("n") > offset))
        number = F.col("begin") + F.col(_WITHIN)
        rows = (self._stored().join(F.broadcast(meeting.select(_PART, "begin")), _PART)
                .filter((number >= offset) & (number < offset + limit)).orderBy(number))
        total = ranges.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar()
        return rows.select(*[F.col(f"`{c}`") for c in self.schema.names], total.alias("total"),
                           (F.lit(offset + limit) < total).alias("has_more"))


def label_ranks(df: DataFrame, column: str, by_count: bool = True) -> DataFrame:
    """(label, place) of the labels without null: the most frequent is 0, ties by label; or by label alone."""
    counts = (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("label"))
              .agg(F.count(F.lit(1)).alias("n")))
    order = [F.col("n").desc(), F.col("label")] if by_count else [F.col("label")]
    return RankIndex.build(counts, order).numbered().select("label", "place")
