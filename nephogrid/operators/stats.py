"""Statistics of rasters. Global ones are frames of one row (or 256), which later steps broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bands of absolute latitude, the lower end exclusive. The labels are our own.
ZONES = ((0, 30, "low"), (30, 45, "mid_low"), (45, 60, "mid"), (60, 70, "mid_high"), (70, 80, "high"), (80, 90, "polar"))


def zone_of(lat: Column) -> Column:
    """Name of the band of a latitude; null at the equator itself, which lies in none."""
    a, out = F.abs(lat), None
    for low, high, name in ZONES:
        here = (a > low) & (a <= high)
        out = F.when(here, name) if out is None else out.when(here, name)
    return out


def zone_stats(raster: DataFrame, value: str) -> DataFrame:
    """(zone, n, mean, zero_percent) by band of |lat|; missing values do not count."""
    z = raster.withColumn("zone", zone_of(F.col("lat"))).where(F.col("zone").isNotNull() & F.col(value).isNotNull())
    return z.groupBy("zone").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), (F.count_if(F.col(value) == 0) * 100.0 / F.count(F.lit(1))).alias("zero_percent"))


def raster_stats(raster: DataFrame, value: str) -> DataFrame:
    """One row: n, missing, low, high, mean, zero_percent and the mean of what is not zero."""
    v = F.col(value)
    return raster.agg(F.count(F.lit(1)).alias("n"), F.count_if(v.isNull()).alias("missing"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), (F.count_if(v == 0) * 100.0 / F.greatest(F.count(v), F.lit(1))).alias("zero_percent"), F.avg(F.when(v > 0, v)).alias("mean_above_zero"))


def range_measures(value: Column) -> dict[str, Column]:
    """n, low and high of the values above zero, as aggregates."""
    v = F.when(value > 0, value)
    return {"n": F.count(v), "low": F.min(v), "high": F.max(v)}


def value_range(raster: DataFrame, value: str) -> DataFrame:
    """One row: n, low and high of the values above zero."""
    return raster.agg(*[m.alias(k) for k, m in range_measures(F.col(value)).items()])


def background_measure(value: Column, share: float = 0.05) -> Column:
    """``background_floor`` as an aggregate: the percentile (linear rule, truncated) of the counts above zero, null if there are none. It holds a
    number for each count that occurs, 255 at most."""
    return F.floor(F.percentile(F.when(value > 0, value), share)).cast("int")


def raster_measures(value: Column) -> dict[str, Column]:
    """What is worth knowing about a density grid: n, missing, zeros, low, high and mean."""
    return {"pixels": F.count(F.lit(1)), "missing": F.count_if(value.isNull()), "zeros": F.count_if(value == 0), "least": F.min(value), "most": F.max(value), "mean": F.avg(value)}


def background_floor(raster: DataFrame, value: str, share: float = 0.05) -> DataFrame:
    """One row, ``bg``: the percentile (linear rule, truncated) of the values above zero; 0 if there are none.

    Values are counts of 0 to 255, so it is taken from their histogram, not from the pixels.
    """
    h = histogram(raster.where(F.col(value) > 0), value)
    up_to = F.sum("n").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0))  # 255 rows at most
    h = h.select("k", up_to.alias("upto"), F.sum("n").over(Window.partitionBy()).alias("total"))
    at = (F.col("total") - 1) * share
    low = F.min(F.when(F.col("upto") > F.floor(at), F.col("k")))
    high = F.min(F.when(F.col("upto") > F.floor(at) + 1, F.col("k")))
    part = F.max(at - F.floor(at))
    return h.agg(F.coalesce(F.floor(low + part * (F.coalesce(high, low) - low)), F.lit(0)).cast("int").alias("bg"))


def histogram(raster: DataFrame, value: str) -> DataFrame:
    """(k, n) of the counts that occur."""
    return raster.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))


def cdf(hist: DataFrame, counts: int = 256) -> DataFrame:
    """(k, cdf) for all counts from 0 to ``counts`` - 1, in single precision as the match needs; all zeros for an empty histogram.

    The running sum is one window over the counts, which the caller bounds.
    """
    spark = hist.sparkSession
    full = spark.range(counts).select(F.col("id").cast("int").alias("k")).join(F.broadcast(hist.where(F.col("k").between(0, counts - 1))), "k", "left").select("k", F.coalesce("n", F.lit(0)).alias("n"))
    # counts are not negative; without abs Spark makes the two casts (to float here, to double in the division) one, and totals beyond 2^24 stay unrounded
    single = lambda n: F.abs(n.cast("float"))
    up_to = single(F.sum("n").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    total = single(F.sum("n").over(Window.partitionBy()))
    return full.select("k", F.coalesce(F.try_divide(up_to, total), F.lit(0.0)).cast("float").alias("cdf"))
