"""Streaming forms of the point job. An extension: what it does in batches, this does as files arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from nephogrid.functions import pixels as px

POINTS = "seq long, lat double, lng double, at timestamp"


def point_stream(spark: SparkSession, path: str) -> DataFrame:
    """Points as Parquet files arrive in a folder."""
    return spark.readStream.schema(POINTS).parquet(path)


def first_per_cell(points: DataFrame, late: str = "1 hour", degrees: float = 1.0) -> DataFrame:
    """One point a cell within ``late``; state older than the watermark is dropped."""
    key = px.cell(F.col("lat"), F.col("lng"), degrees)
    keyed = points.where("lat is not null and lng is not null").withColumn("a", key["cell_lat"]).withColumn("b", key["cell_lng"])
    out = keyed.withWatermark("at", late).dropDuplicatesWithinWatermark(["a", "b"])
    return out.select("seq", px.coordinate(F.col("lat")).alias("lat"), px.coordinate(F.col("lng")).alias("lng"), "at")


def first_ever_per_cell(points: DataFrame, degrees: float = 1.0) -> DataFrame:
    """The first point of each cell, once and for all: what arrives later for a cell that was seen yields nothing, however late and after any restart.

    A cell is a key of the state and costs it one flag, for ever: there are 360 * 180 of them at one degree. Of points of a cell that arrive together
    the one with the smallest ``seq`` counts. Points with missing or non-finite coordinates are dropped. Files that arrive in order of ``seq`` give
    what the batch job gives.
    """
    key = px.cell(F.col("lat"), F.col("lng"), degrees)
    good = points.where("lat is not null and lng is not null and abs(lat) < double('inf') and abs(lng) < double('inf')")
    keyed = good.select("seq", px.coordinate(F.col("lat")).alias("lat"), px.coordinate(F.col("lng")).alias("lng"), "at", key["cell_lat"].alias("a"), key["cell_lng"].alias("b"))

    def run(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first = None
        for part in parts:  # read to the end, a part at a time
            if not state.exists and len(part):
                own = part.loc[[part["seq"].idxmin()]]
                first = own if first is None or own["seq"].iloc[0] < first["seq"].iloc[0] else first
        if first is not None:
            state.update((True,))
            yield first[["seq", "lat", "lng", "at"]]

    return keyed.groupBy("a", "b").applyInPandasWithState(run, POINTS, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def counts_by_hour(points: DataFrame, late: str = "1 hour") -> DataFrame:
    """(hour, n) of points, final once the watermark has passed the hour."""
    w = points.withWatermark("at", late).groupBy(F.window("at", "1 hour")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("window.start").alias("hour"), "n")


def drain(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in all that has arrived and stop."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
