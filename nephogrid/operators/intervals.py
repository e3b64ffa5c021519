"""Joins on half-open ranges that come as data and may overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bands that are broadcast; more of them meet the rows by a shuffle on their buckets.
BROADCAST_BANDS = 100_000


def interval_join(rows: DataFrame, value: Column, bands: DataFrame, width: float) -> DataFrame:
    """Each of ``rows`` with each of ``bands`` (low, high, ...) for which ``low < value <= high``.

    Both sides meet on buckets of ``width``: a band is there once for each bucket it touches, a row once, so no pair is compared outside a bucket and none
    is found twice. A width near the usual length of a band keeps both copies and comparisons few. Null values, and bands whose bounds are null,
    not finite or the wrong way round, match nothing. Columns of both sides have to be told apart by the caller.
    """
    finite = lambda c: F.abs(c) < float("inf")
    good = bands.where(finite(F.col("low")) & finite(F.col("high")) & (F.col("low") < F.col("high")))
    first, last = (F.floor(F.col(c) / width) for c in ("low", "high"))
    cut = good.withColumn("_bucket", F.explode(F.sequence(first, last)))
    cut = F.broadcast(cut) if cut.limit(BROADCAST_BANDS + 1).count() <= BROADCAST_BANDS else cut
    placed = rows.withColumn("_value", value.cast("double")).where(finite(F.col("_value"))).withColumn("_bucket", F.floor(F.col("_value") / width))
    met = placed.join(cut, "_bucket").where((F.col("low") < F.col("_value")) & (F.col("_value") <= F.col("high")))
    return met.drop("_bucket", "_value")


def band_stats(raster: DataFrame, value: str, bands: DataFrame, width: float = 10.0) -> DataFrame:
    """(zone, n, mean, zero_percent) of a raster (lat, value) for bands (zone, low, high) of |lat|, the lower end exclusive.

    Pixels of one latitude are counted together before they meet the bands, so the join has a row for each latitude. Missing values do not count,
    bands without a value are left out, a band that is there twice counts twice.
    """
    v = F.col(value)
    lines = raster.where(v.isNotNull()).groupBy(F.abs("lat").alias("_lat")).agg(F.count(F.lit(1)).alias("_n"), F.sum(v).alias("_sum"), F.count_if(v == 0).alias("_zeros"))
    met = interval_join(lines, F.col("_lat"), bands.select("zone", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high")), width)
    return met.groupBy("zone").agg(F.sum("_n").alias("n"), (F.sum("_sum") / F.sum("_n")).alias("mean"), (F.sum("_zeros") * 100.0 / F.sum("_n")).alias("zero_percent"))
