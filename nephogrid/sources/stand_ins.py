"""Rasters, points and listings made of the driver's tables, on which the queries run."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from nephogrid.functions import pixels as px
from nephogrid.sources.gridded import NOWHERE
from nephogrid.storage import file_system, materialize

WIDTH = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def height(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the primary raster; a count that Parquet's footers answer."""
    return table(spark, sf_dir, "events").count() // WIDTH


def primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, bt, phase, lat): each event is a pixel."""
    kind = F.col("event_type")
    phase = F.when(kind == "view", 0).when(kind == "click", 1).when(kind == "purchase", 2).when(kind == "signup", 3)
    e = table(spark, sf_dir, "events").select(F.expr(f"cast(event_id div {WIDTH} as int)").alias("r"), (F.col("event_id") % WIDTH).cast("int").alias("c"), (300.0 - px.no_nan(F.col("value"))).alias("bt"), phase.alias("phase"))
    return e.withColumn("lat", px.latitude(F.col("r"), height(spark, sf_dir)))


def primary_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, lat, d): density after gamma."""
    d = px.gamma(px.density(F.col("bt"), F.col("phase")))
    return primary(spark, sf_dir).select("r", "c", "lat", d.alias("d"))


def secondary_height(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "orders").count() // WIDTH


def secondary(spark: SparkSession, sf_dir: str, polar_only: bool = True) -> DataFrame:
    """(r, c, lat, s): each order is a pixel of a raster of its own height; zero equatorward of 60 degrees unless all are asked for."""
    return _placed(table(spark, sf_dir, "orders"), secondary_height(spark, sf_dir), polar_only)


def secondary_on_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, lat, s): all orders on the grid of the primary raster, the largest of those that fall on one pixel; zero equatorward of 60 degrees."""
    h = height(spark, sf_dir)
    o = table(spark, sf_dir, "orders").withColumn("o_orderkey", F.col("o_orderkey") % (h * WIDTH))
    return _placed(o, h, True).groupBy("r", "c", "lat").agg(F.max("s").alias("s"))


def _placed(orders: DataFrame, h: int, polar_only: bool) -> DataFrame:
    o = orders.select(F.expr(f"cast(o_orderkey div {WIDTH} as int)").alias("r"), (F.col("o_orderkey") % WIDTH).cast("int").alias("c"), (F.floor("o_totalprice").cast("long") % 256).cast("int").alias("s"))
    o = o.withColumn("lat", px.latitude(F.col("r"), h))
    return o.withColumn("s", F.when(F.abs("lat") < px.POLAR, 0).otherwise(F.col("s"))) if polar_only else o


def plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, v): each embedding is a row of 64 counts."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("r"), F.posexplode("embedding").alias("c", "e"))
    return e.select("r", "c", F.floor(F.least(F.greatest((F.col("e").cast("double") + 0.5) * 255.0, F.lit(0.0)), F.lit(255.0))).cast("int").alias("v"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, lat, lng)."""
    a, b = F.col("user_id"), F.col("event_id")
    return table(spark, sf_dir, "events").select(b.alias("seq"), ((a * 37 + b * 13) % 18000 / 100.0 - 90.0).alias("lat"), ((a * 91 + b * 29) % 36000 / 100.0 - 180.0).alias("lng"))


@arrow_udf(BinaryType())
def _location(lat: pa.Array, lng: pa.Array) -> pa.Array:
    """A location of the wire format: 12 bytes."""
    out = np.empty((len(lat), 12), np.uint8)
    out[:, :3], out[:, 7] = (0x0A, 0x0A, 0x0D), 0x15
    for at, x in ((3, lat), (8, lng)):
        out[:, at : at + 4] = x.to_numpy(zero_copy_only=False).astype("<f4").view(np.uint8).reshape(-1, 4)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(12), len(lat), [None, pa.py_buffer(out)]).cast(pa.binary())


def payloads(spark: SparkSession, sf_dir: str, points_per_payload: int = 500) -> DataFrame:
    """(path, content): the points, in stretches of ``seq``, in the wire format of the point source. Groups are put together by Spark, not one by one in Python."""
    one = points(spark, sf_dir).select(F.expr(f"seq div {points_per_payload}").alias("stretch"), F.struct("seq", F.hex(_location("lat", "lng")).alias("hex")).alias("x"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["hex"]), "")
    return one.groupBy("stretch").agg(F.unhex(whole).alias("content")).select(F.format_string("payload-%012d", "stretch").alias("path"), "content")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, size, modified, hour): orders as files of an hourly product."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    hour = F.date_trunc("day", day) + F.make_interval(hours=(k % 24).cast("int"))
    kind = F.when(k % 3 == 0, "_full_").otherwise("_blend_")
    stamp = F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("_s"), F.date_format(hour, "yyyyMMddHH"), F.lit("0000")))
    end = F.when(k % 7 == 0, ".tmp").otherwise(".nc")
    key = F.concat(F.lit("product/"), F.date_format(hour, "yyyy/MM/dd/HH"), F.lit("/file"), kind, k.cast("string"), stamp, end)
    return table(spark, sf_dir, "orders").select(key.alias("key"), F.floor("o_totalprice").cast("long").alias("size"), (hour + F.make_interval(mins=F.lit(7))).alias("modified"), hour.alias("hour"))


def _message(kind: int, body: bytes) -> bytes:
    body += bytes(-len(body) % 8)
    return struct.pack("<HHB3x", kind, len(body), 0) + body


def _header(*messages: bytes) -> bytes:
    """An object header of the older kind."""
    return struct.pack("<BxHIi4x", 1, len(messages), 1, sum(map(len, messages))) + b"".join(messages)


def _float_type(size: int) -> bytes:
    mantissa, exponent, bias = (52, 11, 1023) if size == 8 else (23, 8, 127)
    return struct.pack("<BBBBIHHBBBBI", 0x11, 0x20, 8 * size - 1, 0, size, 0, 8 * size, mantissa, exponent, 0, mantissa, bias)


def _text_attribute(name: str, value: str) -> bytes:
    padded = lambda b: b + bytes(-len(b) % 8)
    name_, kind, space = name.encode() + b"\0", struct.pack("<BBBBI", 0x13, 0, 0, 0, len(value)), struct.pack("<BB6x", 1, 0)
    return _message(0xC, struct.pack("<BxHHH", 1, len(name_), len(kind), len(space)) + padded(name_) + padded(kind) + padded(space) + value.encode())


def chunk_table(leaves: list[tuple[int, int, tuple[int, ...]]], at: int, rank: int, fan: int = 64) -> tuple[bytes, int]:
    """The B-tree of chunks (place, size, origin) written at ``at``, and where its root is."""
    key = lambda size, origin: struct.pack("<II", size, 0) + struct.pack(f"<{rank + 1}Q", *origin, 0)
    nodes, level, out = [(place, size, origin) for place, size, origin in leaves], 0, b""
    end = key(0, [1 << 40] * rank)
    while True:
        above = []
        for i in range(0, len(nodes), fan):
            group = nodes[i : i + fan]
            after = key(nodes[i + fan][1], nodes[i + fan][2]) if i + fan < len(nodes) else end
            above.append((at + len(out), group[0][1], group[0][2]))
            out += struct.pack("<4sBBHQQ", b"TREE", 1, level, len(group), NOWHERE, NOWHERE) + b"".join(key(s, o) + struct.pack("<Q", p) for p, s, o in group) + after
        if len(above) == 1:
            return out, above[0][0]
        nodes, level = above, level + 1


def grid_file(raster: DataFrame, path: str, names: list[str], coordinates: dict[str, list[float]], height: int, width: int, rows: int, columns: int, attributes: dict[str, dict[str, str]]) -> None:
    """Write a gridded file: variables ``names`` of (r, c, names...) in shuffled and deflated chunks of ``rows`` x ``columns`` doubles, coordinates whole.

    Chunks are packed in tasks; nulls are NaN, and chunks without a pixel are not stored. The file is one stream, so one task writes it, chunk
    after chunk; the driver has the chunks' sizes only.
    """

    def pack(b: pd.DataFrame) -> pd.DataFrame:
        y, x = int(b["y"].iloc[0]), int(b["x"].iloc[0])
        at = (b["r"] - y * rows) * columns + b["c"] - x * columns
        out = []
        for n in names:
            plane = np.full(rows * columns, np.nan)
            plane[at.to_numpy()] = b[n].astype("float64").to_numpy()
            out.append(zlib.compress(plane.view(np.uint8).reshape(-1, 8).T.tobytes()))
        return pd.DataFrame({"variable": range(len(names)), "y": y, "x": x, "packed": out})

    px_ = raster.select(F.expr(f"r div {rows}").cast("int").alias("y"), F.expr(f"c div {columns}").cast("int").alias("x"), "r", "c", *names)
    packed = materialize(px_.groupBy("y", "x").applyInPandas(pack, "variable int, y int, x int, packed binary"), "chunks").orderBy("variable", "y", "x")
    sizes = packed.select("variable", "y", "x", F.length("packed").alias("n")).collect()
    space = lambda *n: _message(0x1, struct.pack(f"<BBB5x{len(n)}Q", 1, len(n), 0, *n))
    kind, filters = _message(0x3, _float_type(8)), _message(0xB, struct.pack("<BB6xHHHHI4xHHHHI4x", 1, 2, 2, 0, 0, 1, 8, 1, 0, 0, 1, 6))
    text = lambda n: [_text_attribute(k, v) for k, v in attributes.get(n, {}).items()]
    every = sorted([*names, *coordinates])
    heap = b"\0" * 8
    places = {}
    for n in every:
        places[n], heap = len(heap), heap + n.encode() + b"\0" + bytes(-(len(n) + 1) % 8)

    def metadata(at: dict[str, int], root: int, trees: dict[str, int], data: dict[str, int]) -> dict[str, bytes]:
        """All parts before the chunks; their sizes do not depend on the places."""
        parts = {"super": b"\x89HDF\r\n\x1a\n" + struct.pack("<8BHHIQQQQQQII16x", 0, 0, 0, 0, 0, 8, 8, 0, 4, 16, 0, 0, NOWHERE, at.get("end", 0), NOWHERE, 0, at.get("root", 0), 0, 0)}
        parts["root"] = _header(_message(0x11, struct.pack("<QQ", at.get("tree", 0), at.get("heap", 0))), *text(""))
        parts["tree"] = struct.pack("<4sBBHQQQQQ", b"TREE", 0, 0, 1, NOWHERE, NOWHERE, 0, at.get("symbols", 0), places[every[-1]])
        parts["symbols"] = struct.pack("<4sBxH", b"SNOD", 1, len(every)) + b"".join(struct.pack("<QQII16x", places[n], at.get(n, 0), 0, 0) for n in every)
        parts["heap"] = struct.pack("<4sB3xQQQ", b"HEAP", 0, len(heap), NOWHERE, at.get("names", 0))
        parts["names"] = heap
        for n in names:
            parts[n] = _header(space(1, height, width), kind, filters, _message(0x8, struct.pack("<BBBQIIII", 3, 2, 4, trees.get(n, 0), 1, rows, columns, 8)), *text(n))
        for n, values in coordinates.items():
            parts[n] = _header(space(len(values)), kind, _message(0x8, struct.pack("<BBQQ", 3, 1, data.get(n, 0), 8 * len(values))), *text(n))
        return parts

    def laid(parts: dict[str, bytes], begin: int = 0) -> tuple[dict[str, int], int]:
        at = {}
        for n, b in parts.items():
            at[n], begin = begin, begin + len(b)
        return at, begin

    at, end = laid(metadata({}, 0, {}, {}))
    values = {n: np.array(v, "<f8").tobytes() for n, v in coordinates.items()}
    data, end = laid(values, end)
    room, trees, tables = {}, {}, {}
    for i, n in enumerate(names):  # the tables' sizes are known, their places come before the chunks'
        room[n] = len(chunk_table([(0, 0, (0, 0, 0))] * max(1, sum(s["variable"] == i for s in sizes)), 0, 3)[0])
    where, first = laid({n: bytes(k) for n, k in room.items()}, end)
    for i, n in enumerate(names):
        leaves = []
        for s in sizes:
            if s["variable"] == i:
                leaves.append((first, s["n"], (0, s["y"] * rows, s["x"] * columns)))
                first += s["n"]
        tables[n], trees[n] = chunk_table(leaves, where[n], 3) if leaves else (bytes(room[n]), NOWHERE)
    at["end"] = first
    head = b"".join([*metadata(at, 0, trees, data).values(), *values.values(), *tables.values()])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = file_system(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        with store.open_output_stream(place) as f:
            f.write(head)
            for b in batches:
                for p in b["packed"]:
                    f.write(bytes(p))
        yield pd.DataFrame({"done": [1]})

    packed.coalesce(1).sortWithinPartitions("variable", "y", "x").select("packed").mapInPandas(write, "done int").collect()


def land_listing(files: DataFrame, root: str) -> None:
    """Write a file of ``size`` bytes for each of (key, size) below ``root``, in tasks."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = file_system(root)
        for b in batches:
            for key, size in zip(b["key"], b["size"], strict=True):
                store.create_dir(f"{top}/{key}".rpartition("/")[0], recursive=True)
                with store.open_output_stream(f"{top}/{key}") as f:
                    f.write(bytes(int(size)))
            yield pd.DataFrame({"n": [len(b)]})

    files.select("key", "size").mapInPandas(write, "n long").write.format("noop").mode("overwrite").save()
