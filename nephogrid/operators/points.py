"""Geo-located point events: first-wins de-duplication by grid cell, fallback, capped sample, and a tolerant decoder of their wire format."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import BinaryType, DoubleType, LongType, NullType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from nephogrid.functions import pixels as px
from nephogrid.storage import materialize

# Latitude and longitude of the places that stand in when no source yields points.
DEFAULT_PLACES = (
    (34.05, -118.24), (-33.87, 151.21), (51.51, -0.13), (35.68, 139.76), (-34.60, -58.38), (41.01, 28.98), (19.08, 72.88), (-1.29, 36.82),
    (55.75, 37.62), (-22.91, -43.20), (30.04, 31.24), (-6.21, 106.85), (48.86, 2.35), (-37.81, 144.96), (37.57, 126.98), (14.60, 120.98),
    (-4.33, 15.31), (25.20, 55.27), (40.42, -3.70), (52.52, 13.41), (59.33, 18.07), (33.89, 35.50), (-26.20, 28.05), (53.55, -113.49),
    (43.65, -79.38), (-12.05, -77.04), (39.90, 116.41), (-31.95, 115.86), (47.38, 8.54), (60.17, 24.94), (38.72, -9.14), (50.85, 4.35),
    (52.37, 4.89), (45.44, 9.19), (17.39, 78.49), (29.56, 106.55), (44.80, 20.47), (-23.55, -46.63), (28.61, 77.23), (13.75, 100.50),
)


def first_per_cell(points: DataFrame, degrees: float = 1.0) -> DataFrame:
    """(seq, lat, lng): of (seq, lat, lng) the first point of each cell by ``seq``, coordinates rounded to 4 digits.

    Cells are cut from the unrounded coordinates. Points with missing or non-finite coordinates are dropped. An aggregate with map-side
    combine, so a crowded cell costs no task more than its share.
    """
    good = points.where("lat is not null and lng is not null and abs(lat) < double('inf') and abs(lng) < double('inf')")
    key = px.cell(F.col("lat"), F.col("lng"), degrees)
    first = good.groupBy(key["cell_lat"].alias("a"), key["cell_lng"].alias("b")).agg(F.min(F.struct("seq", "lat", "lng")).alias("p"))
    return first.select("p.seq", px.coordinate(F.col("p.lat")).alias("lat"), px.coordinate(F.col("p.lng")).alias("lng"))


def default_places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(DEFAULT_PLACES)], "seq long, lat double, lng double")


def or_default(points: DataFrame) -> DataFrame:
    """The points, or the default places if there are none."""
    some = points.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    stand_in = default_places(points.sparkSession).crossJoin(F.broadcast(some)).where("_n = 0").drop("_n")
    return points.select("seq", "lat", "lng").unionByName(stand_in)


def capped(points: DataFrame, most: int = 2000, seed: int = 0, order: Column | None = None) -> DataFrame:
    """All points if there are at most ``most``; else that many, in an order that hashes ``seq`` and the seed, so reruns agree.

    ``order`` stands in for that hash, where the choice has to be stated otherwise.
    """
    return points.orderBy(F.xxhash64(F.col("seq"), F.lit(seed)) if order is None else order, "seq").limit(most)


def to_json(points: DataFrame) -> DataFrame:
    """One row, ``points``: a JSON array of {"lat", "lng"} in order of ``seq``. For capped points: all of them are one value."""
    rows = F.sort_array(F.collect_list(F.struct("seq", "lat", "lng")))
    return points.agg(F.to_json(F.transform(rows, lambda p: F.struct(p["lat"].alias("lat"), p["lng"].alias("lng")))).alias("points"))


def storm_points(payloads: DataFrame, most: int = 2000, seed: int = 0, order: Column | None = None) -> DataFrame:
    """(seq, lat, lng) of payloads (path, content): decoded, one point a cell, default places if there is none, at most ``most``.

    Points of one payload keep their order; payloads come in order of path.
    """
    few = materialize(capped(first_per_cell(decode(payloads).select(F.struct("path", "seq").alias("seq"), "lat", "lng")), most, seed, order), "points", slim=True)  # read twice below
    numbered = few.select((F.row_number().over(Window.orderBy("seq")) - 1).cast("long").alias("seq"), "lat", "lng")  # at most ``most`` rows
    return or_default(numbered)


def decode_message(data: bytes) -> tuple[list[tuple[float, float]], str]:
    """Latitude and longitude of the locations in one message (repeated field 1, of which fields 1 and 2 are single floats), and why it ended:
    end, truncated, or foreign field.

    Keeps what came before a truncation or a foreign top-level field; skips the rest of a location at a field it does not know; drops locations
    without both coordinates and those that are not finite.
    """
    out: list[tuple[float, float]] = []
    at = 0
    while at < len(data) and data[at] == 0x0A:
        at, size, shift, more = at + 1, 0, 0, True
        while more:
            if at >= len(data) or shift > 63:
                return out, "truncated"
            size |= (data[at] & 0x7F) << shift
            more = data[at] >= 0x80
            shift, at = shift + 7, at + 1
        end = at + size
        found: dict[int, float] = {}
        while at < min(end, len(data)):
            field = {0x0D: 1, 0x15: 2}.get(data[at])
            if field is None:
                break
            if at + 5 > min(end, len(data)):
                break
            found[field] = struct.unpack_from("<f", data, at + 1)[0]
            at += 5
        if len(found) == 2 and all(map(math.isfinite, found.values())):
            out.append((found[1], found[2]))
        if end > len(data):
            return out, "truncated"
        at = end
    return out, "end" if at >= len(data) else "foreign field"


def decode_payload(data: bytes) -> list[tuple[float, float]]:
    """The points of ``decode_message``."""
    return decode_message(data)[0]


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of landed payload files, one row each."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


#: Bytes of payloads that are decoded at once.
AT_ONCE = 1 << 20


def _decode_together(content: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, seq, lat, lng) of payloads: locations in the usual 12 bytes are read all at once, what follows another kind one by one."""
    ends = np.frombuffer(content.buffers()[1], np.int32)[content.offset : content.offset + len(content) + 1].astype(np.int64)
    data = np.frombuffer(content.buffers()[2] or b"", np.uint8)
    n, slots = len(content), np.diff(ends) // 12
    first = np.cumsum(slots) - slots
    row = np.repeat(np.arange(n), slots)
    at = ends[row] + 12 * (np.arange(len(row)) - first[row])
    usual = (data[at] == 0x0A) & (data[at + 1] == 0x0A) & (data[at + 2] == 0x0D) & (data[at + 7] == 0x15)
    since = lambda flags: (lambda total: total[1:] - total[first][row])(np.concatenate([[0], np.cumsum(flags)]))
    usual &= since(~usual) == 0  # only before the first of another kind
    lat, lng = (data[at[:, None] + np.arange(k, k + 4)].view("<f4").ravel().astype(np.float64) for k in (3, 8))
    good = usual & np.isfinite(lat) & np.isfinite(lng)
    found = [(row[good], since(good)[good] - 1, lat[good], lng[good])]
    count, begin = np.bincount(row[good], minlength=n), ends[:-1] + 12 * np.bincount(row[usual], minlength=n)
    for i in np.flatnonzero(ends[1:] - begin >= 12):  # fewer bytes hold no location
        if more := decode_payload(data[begin[i] : ends[i + 1]].tobytes()):
            found.append((np.full(len(more), i), count[i] + np.arange(len(more)), *np.array(more).T))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def decode(payloads: DataFrame) -> DataFrame:
    """(path, seq, lat, lng) of payloads (path, content), as ``binaryFile`` reads them; seq counts within a payload. A task holds about a megabyte decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            content = pc.fill_null(b.column("content").cast(pa.binary()), b"")
            size = np.cumsum(pc.binary_length(content).to_numpy())
            edges = [0, *(np.flatnonzero(np.diff(size // AT_ONCE)) + 1).tolist(), b.num_rows]
            for a, z in zip(edges, edges[1:]):
                if a < z:
                    row, seq, lat, lng = _decode_together(content.slice(a, z - a))
                    yield pa.RecordBatch.from_arrays([b.column("path").slice(a, z - a).take(pa.array(row)), pa.array(seq), pa.array(lat), pa.array(lng)], ["path", "seq", "lat", "lng"])

    return payloads.select("path", "content").mapInArrow(run, "path string, seq long, lat double, lng double")


@udtf
class DecodePoints:
    """Table function of one payload: a row (seq, lat, lng, why) for each point, and a last one that says only why decoding ended.

    ``payloads.lateralJoin(DecodePoints(F.col("content").outer()))``, or in SQL as ``FROM payloads, LATERAL decode_points(content)`` where it is registered.
    """

    @staticmethod
    def analyze(content: AnalyzeArgument) -> AnalyzeResult:
        if content.dataType not in (BinaryType(), NullType()):
            raise ValueError("payloads are binary")
        return AnalyzeResult(StructType().add("seq", LongType()).add("lat", DoubleType()).add("lng", DoubleType()).add("why", StringType()))

    def eval(self, content):
        found, why = decode_message(bytes(content or b""))
        for seq, (lat, lng) in enumerate(found):
            yield seq, lat, lng, None
        yield None, None, None, why


def register(spark: SparkSession) -> None:
    """Make ``decode_points`` known to SQL."""
    spark.udtf.register("decode_points", DecodePoints)
