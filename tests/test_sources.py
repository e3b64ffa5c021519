"""Local files: landed rasters, tiles, faces, manifest, point payloads and streams."""

import json
import struct
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from nephogrid.functions import pixels as px
from nephogrid.operators import layout, points
from nephogrid.plans.cloud_map import CloudMapConfig, cloud_map, density_grid, density_grid_of_scaled, load_first, publish_faces, published_faces
from nephogrid.sources import png, published, rasters, stand_ins
from nephogrid.streaming import ingest
from tests.test_png import written


def test_landed_rows_are_pruned(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") / 10).cast("int").alias("r"), (F.col("id") % 10).cast("int").alias("c"), F.col("id").alias("v"))
    rasters.land(df, str(tmp_path / "x"), 16)
    got = rasters.read_landed(spark, str(tmp_path / "x"), 20, 39, 16)
    assert sorted(r["v"] for r in got.collect()) == list(range(200, 400))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stretch" in plan and "PushedFilters: [IsNotNull(r)" in plan


def test_tiles_and_mosaic(spark, tmp_path):
    tile = lambda ty, tx: written([[(ty * 100 + tx * 10 + k,) for k in (2 * y, 2 * y + 1)] for y in range(2)], 8, 0)
    for ty in range(2):
        for tx in range(2):
            (tmp_path / f"tile_{ty}_{tx}.png").write_bytes(tile(ty, tx))
    at = lambda k: lambda p: F.regexp_extract(p, r"tile_(\d+)_(\d+)", k)
    tiles = rasters.read_tiles(spark, str(tmp_path), at(1), at(2))
    got = {(r["r"], r["c"]): r["v"] for r in layout.mosaic(tiles, 2).collect()}
    assert len(got) == 16 and got[0, 0] == 0 and got[3, 3] == 113 and got[2, 1] == 101
    files = spark.createDataFrame([(0, tile(0, 0)), (1, tile(0, 1)[:40]), (2, None)], "ty int, content binary")
    assert [r["ty"] for r in rasters.sound_tiles(files, ["ty"]).collect()] == [0]
    (tmp_path / "tile_0_1.png").write_bytes(tile(0, 1)[:40])
    with pytest.raises(Exception, match="tile 0 1: truncated"):
        tiles.collect()


def test_tiles_without_time_stand_in(spark):
    timed = spark.createDataFrame([(0, 0, 1)], "ty int, tx int, v int")
    latest = spark.createDataFrame([(0, 0, 9), (0, 1, 9)], "ty int, tx int, v int")
    assert sorted(tuple(r) for r in rasters.fall_back(timed, latest, ["ty", "tx"]).collect()) == [(0, 0, 1, True), (0, 1, 9, False)]


def test_payload_files(spark, tmp_path):
    one = lambda a, b: b"\x0a\x0a\x0d" + struct.pack("<f", a) + b"\x15" + struct.pack("<f", b)
    (tmp_path / "a.pb").write_bytes(one(1.25, 2.5) + one(1.5, 2.75) + one(3, 4))
    (tmp_path / "empty.pb").write_bytes(b"")
    got = points.decode(points.read_payloads(spark, str(tmp_path)))
    assert sorted((r["lat"], r["lng"]) for r in points.first_per_cell(got).collect()) == [(1.25, 2.5), (3.0, 4.0)]


def test_whole_map_and_sinks(spark, small, tmp_path):
    config = CloudMapConfig(width=100, height=10, face=8)
    main = stand_ins.primary(spark, small)
    grid = density_grid(main, 100, 10, config)
    faces = cloud_map(grid, stand_ins.secondary_on_grid(spark, small).select("r", "c", "s"), config)
    assert faces.count() == 6 * 64
    root = str(tmp_path / "out")
    publish_faces(faces, root, "20240131_120000", 8, pages="https://host.example.org//")
    assert sorted(tuple(r) for r in published_faces(spark, root).collect()) == sorted(tuple(r) for r in faces.collect())
    said = published.latest(spark, root).first()
    assert said["stamp"] == "20240131_120000" and said["manifest"] == {"baseUrl": "https://host.example.org/tiles/", "timestamp": "20240131_120000"}
    assert [f["name"] for f in said["files"]] == [f"tiles/{k}.png" for k in sorted(px.FACES)]


def test_second_source(spark):
    src = spark.createDataFrame([(r, c, 60.0 - 40.0 * r, 220.0 if c else 1.0) for r in range(4) for c in range(3)], "r int, c int, lat double, v double")
    got = {(r["r"], r["c"]): r["d"] for r in density_grid_of_scaled(src, 0.0, False, 5).collect()}
    assert len(got) == 6 * 5 and got[1, 0] == 0 and got[1, 1] == 195 and got[0, 1] == 0 and got[1, 4] == 0
    with pytest.raises(ValueError):
        density_grid_of_scaled(src, 0.0, False, 2)


def test_strips_of_a_raster(spark):
    df = spark.range(50).select((F.col("id") / 10).cast("int").alias("r"), (F.col("id") % 10).cast("int").alias("c"), F.when(F.col("id") != 7, F.col("id")).alias("d"))
    got = {r["strip"]: png.decode(bytes(r["image"]))[0].tolist() for r in rasters.strips(df, 10, 2).collect()}
    assert [row for k in sorted(got) for row in got[k]] == [[0 if 10 * r + c == 7 or r == 5 else 10 * r + c for c in range(10)] for r in range(6)]


def test_load_first_needs_a_slot(spark):
    slots = spark.createDataFrame([(datetime(2024, 1, 1, 5), False)], "slot timestamp, available boolean")
    with pytest.raises(LookupError):
        load_first(slots, F.lit(datetime(2024, 1, 1, 6)), lambda path: None, F.lit("x"), CloudMapConfig())


def test_storm_job_falls_back(spark):
    none = spark.createDataFrame([("a", b"")], "path string, content binary")
    assert points.storm_points(none).count() == len(points.DEFAULT_PLACES)
    assert json.loads(points.to_json(points.storm_points(none)).first()["points"])[0] == {"lat": 34.05, "lng": -118.24}


def test_streamed_points(spark, tmp_path):
    t = datetime(2024, 1, 1)
    rows = [(i, 10.0 + i % 3, 20.5, t + timedelta(minutes=i)) for i in range(30)]
    spark.createDataFrame(rows, ingest.POINTS).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = ingest.drain(ingest.first_per_cell(ingest.point_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination(120)
    assert sorted(r["lat"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [10.0, 11.0, 12.0]


def test_a_seen_cell_yields_nothing_ever_again(spark, tmp_path):
    """A second file, a year late and after a restart; within a file the smallest sequence number counts."""
    t, out = datetime(2024, 1, 1), str(tmp_path / "out")

    def arrive(name, rows):
        spark.createDataFrame(rows, ingest.POINTS).repartition(3).write.parquet(str(tmp_path / "in" / name))
        stream = ingest.point_stream(spark, str(tmp_path / "in" / "*"))
        ingest.drain(ingest.first_ever_per_cell(stream), out, str(tmp_path / "state")).awaitTermination(180)
        return sorted((r["seq"], r["lat"]) for r in spark.read.parquet(out).collect())

    first = arrive("a", [(5, 10.5, 20.5, t), (3, 10.25, 20.5, t), (4, 11.5, 20.5, t), (9, None, 1.0, t), (10, float("nan"), 1.0, t)])
    assert first == [(3, 10.25), (4, 11.5)]
    late = arrive("b", [(1, 10.75, 20.5, t - timedelta(days=365)), (20, 11.75, 20.5, t + timedelta(days=365)), (21, -10.03125, 20.5, t)])
    assert late == [(3, 10.25), (4, 11.5), (21, -10.0312)]
    batch = spark.createDataFrame([(3, 10.25, 20.5), (5, 10.5, 20.5), (4, 11.5, 20.5), (20, 11.75, 20.5), (21, -10.03125, 20.5)], "seq long, lat double, lng double")
    assert sorted((r["seq"], r["lat"]) for r in points.first_per_cell(batch).collect()) == late
