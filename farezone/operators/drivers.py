"""A12 as something that merges: exact driver counts from bitmaps.

A dictionary gives each driver a place, once and for good; a month's drivers are bitmaps over the
places, some kilobytes in all. Bitmaps of the same month merge by OR, so trips that arrive late are
added without reading those counted before, and the count stays exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets that number their drivers each for itself, so that no task numbers all.
BUCKETS = 64


def driver_places(drivers: DataFrame, known: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``(driver, place)`` of ``drivers`` (a column ``driver``; NULL and repeats are ignored) that aren't
    in ``known`` yet; places run from 1 without gaps in a bucket and never change.

    A bucket's k-th driver has place ``(k - 1) * buckets + bucket + 1``."""
    new = drivers.select("driver").where(F.col("driver").isNotNull()).distinct()
    bucket = F.pmod(F.xxhash64("driver"), F.lit(buckets))
    if known is None:
        numbered = new.withColumn("_bucket", bucket).withColumn("_taken", F.lit(0).cast("long"))
    else:
        taken = (known.groupBy(F.pmod(F.col("place") - 1, F.lit(buckets)).alias("_bucket"))
                 .agg(F.count(F.lit(1)).alias("_taken")))  # a row for each bucket
        numbered = (new.join(known.select("driver"), "driver", "left_anti").withColumn("_bucket", bucket)
                    .join(taken, "_bucket", "left").withColumn("_taken", F.coalesce("_taken", F.lit(0).cast("long"))))
    k = F.row_number().over(Window.partitionBy("_bucket").orderBy("driver")) + F.col("_taken")
    return numbered.select("driver", ((k - 1) * buckets + F.col("_bucket") + 1).alias("place"))


def driver_bitmaps(months: DataFrame, places: DataFrame) -> DataFrame:
    """``(year_month, part, drivers)``: bitmaps of the drivers in ``months`` (``year_month, driver``),
    one for each month and 32768 places."""
    return (months.select("year_month", "driver").join(places, "driver")
            .groupBy("year_month", F.expr("bitmap_bucket_number(place)").alias("part"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("drivers")))


def merge_bitmaps(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("year_month", "part").agg(F.expr("bitmap_or_agg(drivers)").alias("drivers"))


def count_drivers(bitmaps: DataFrame) -> DataFrame:
    """``(year_month, drivers)``: the exact number of different drivers."""
    return bitmaps.groupBy("year_month").agg(F.sum(F.expr("bitmap_count(drivers)")).alias("drivers"))
