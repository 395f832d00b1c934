"""Half-open intervals (key, start, end)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merged(intervals: DataFrame, distance: int, width: int = 1 << 20) -> DataFrame:
    """(key, start, end, n): intervals of a key joined where the gap between them is at most distance.

    Intervals are dealt to ranges of `width` by their start, and only a range is sorted in one task, however long its key is.  What
    one range hands to those behind it is two numbers, how far its intervals reach and where its last island begins; they are
    carried on over a row for each range that has any.
    """
    s = intervals.select("key", "start", "end", F.floor(F.col("start") / width).alias("_range"))
    before = Window.partitionBy("key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    reach = s.groupBy("key", "_range").agg(F.max("end").alias("_end")).select("key", "_range", F.max("_end").over(before).alias("_carried"))
    w = Window.partitionBy("key", "_range").orderBy("start", "end")
    far = F.greatest(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carried"))
    s = s.join(reach, ["key", "_range"]).withColumn("_far", far)
    s = s.withColumn("_first", F.when(F.col("_far").isNull() | (F.col("start") > F.col("_far") + distance), F.col("start")))
    last = s.groupBy("key", "_range").agg(F.max("_first").alias("_last")).select("key", "_range", F.max("_last").over(before).alias("_open"))
    s = s.join(last, ["key", "_range"]).withColumn("_island", F.coalesce(F.max("_first").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("_open")))
    return s.groupBy("key", "_island").agg(F.max("end").alias("end"), F.count("*").alias("n")).select("key", F.col("_island").alias("start"), "end", "n")


def overlapping(left: DataFrame, right: DataFrame, width: int) -> DataFrame:
    """(left_id, right_id): intervals of one key that share a point, each (key, id, start, end).

    Both sides are dealt to bins of `width`, so the join is on (key, bin); a pair counts in the bin where it first meets.
    """
    bins = lambda df, side: df.where("end > start").select("key", F.col("id").alias(f"{side}_id"), F.col("start").alias(f"{side}_s"), F.col("end").alias(f"{side}_e"), F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))).alias("bin"))
    j = bins(left, "left").join(bins(right, "right"), ["key", "bin"]).where("left_s < right_e and right_s < left_e")
    return j.where(F.col("bin") == F.floor(F.greatest("left_s", "right_s") / width)).select("left_id", "right_id")
