"""Boundaries, properties and plans of the raster and point operators."""

import math
import re
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nephogrid.functions import pixels as px
from nephogrid.operators import gaps, geometry, intervals, layout, matching, points, resample, stats
from nephogrid.plans.cloud_map import CloudMapConfig, cloud_map
from nephogrid.sources import stand_ins


def values(df, column):
    return [r[column] for r in df.collect()]


def test_density_boundaries(spark):
    rows = [(0, 199.0, 1), (1, 200.0, 1), (2, 284.99, 1), (3, 285.0, 1), (4, 300.0, 1), (5, None, 1), (6, 220.0, 0), (7, 220.0, None), (8, float("nan"), 2)]
    df = spark.createDataFrame(rows, "i int, bt double, phase int").withColumn("bt", px.no_nan(F.col("bt")))
    got = df.orderBy("i").select(px.density(F.col("bt"), F.col("phase")).alias("d"), px.density(F.col("bt")).alias("e"))
    assert values(got, "d") == [255, 255, 0, 0, 0, 0, 0, 0, 0]
    assert values(got, "e") == [255, 255, 0, 0, 0, 0, 195, 195, 0]


def test_fill_value_and_prescaled(spark):
    df = spark.createDataFrame([(0, 201.0), (1, 201.5), (2, None), (3, 400.0)], "i int, v double").orderBy("i")
    assert values(df.select(px.density_with_fill(F.col("v"), 200.0).alias("d")), "d") == [0, 250, 0, 0]
    assert values(df.select(px.prescaled(F.col("v")).alias("d")), "d") == [201, 201, 0, 255]


def test_gamma_is_monotone_and_keeps_zero(spark):
    got = values(spark.range(256).orderBy("id").select(px.gamma(F.col("id")).alias("g")), "g")
    assert got[0] == 0 and got[1] == 21 and got[255] == 255 and got == sorted(got)


def test_stretch_range_and_gates(spark):
    df = spark.createDataFrame([(0, 45), (1, 100), (2, 255), (3, 0)], "i int, d int").crossJoin(spark.createDataFrame([(3, 45, 255)], "n int, low int, high int"))
    assert values(df.orderBy("i").select(px.stretch(F.col("d"), F.col("low"), F.col("high"), F.col("n")).alias("d")), "d") == [0, 66, 255, 0]
    same = df.withColumn("high", F.lit(45)).orderBy("i").select(px.stretch(F.col("d"), F.col("low"), F.col("high"), F.col("n")).alias("d"))
    assert values(same, "d") == [45, 100, 255, 0]


def test_zones_are_open_below(spark):
    df = spark.createDataFrame([(0.0,), (30.0,), (30.5,), (-60.0,), (60.1,), (-90.0,)], "lat double")
    assert values(df.select(stats.zone_of(F.col("lat")).alias("z")), "z") == [None, "low", "mid_low", "mid", "mid_high", "polar"]


@pytest.mark.parametrize("data", [[1, 2, 5, 9], [7], [3, 3, 3], list(range(1, 200)), [0, 0]])
def test_background_floor_is_the_linear_percentile(spark, data):
    got = stats.background_floor(spark.createDataFrame([(x,) for x in data], "s int"), "s").first()["bg"]
    above = [x for x in data if x > 0]
    assert got == (int(np.percentile(above, 5)) if above else 0)


def test_lut_gate_and_model(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(1, 255, 100), np.clip(rng.normal(120, 30, 101), 1, 255).astype(int)
    frame = lambda x: spark.createDataFrame([(int(i),) for i in x], "v int")
    same = {r["src"]: r["dst"] for r in matching.cdf_lut(frame(a), frame(a)).collect()}
    assert same == {i: i for i in range(256)}
    a = np.append(a, 17)
    ca, cb = (np.cumsum(np.bincount(x, minlength=256)).astype(np.float32) / np.float32(len(x)) for x in (a, b))
    want = [int(np.argmin(np.abs(cb.astype(float) - float(c)))) for c in ca]
    got = sorted(tuple(r) for r in matching.cdf_lut(frame(a), frame(b)).collect())
    assert [d for _, d in got] == want and want == sorted(want)


def _rasters(spark, height=37, width=12):
    rng = np.random.default_rng(1)
    cells = [(r, c, 90.0 - r * 180.0 / (height - 1), int(rng.integers(0, 3) * 80)) for r in range(height) for c in range(width)]
    main = spark.createDataFrame(cells, "r int, c int, lat double, d int")
    aux = spark.createDataFrame([(r, c, lat, 0 if abs(lat) < 60 else (r * 7 + c) % 256) for r, c, lat, _ in cells], "r int, c int, lat double, s int")
    return main, aux


def test_fill_changes_gaps_only(spark):
    main, aux = _rasters(spark)
    before = {(r["r"], r["c"]): r for r in main.collect()}
    after = {(r["r"], r["c"]): r["d"] for r in gaps.fill_gaps(main, aux).collect()}
    assert after.keys() == before.keys()
    assert all(after[k] == b["d"] for k, b in before.items() if b["d"] > 0 or abs(b["lat"]) <= 60)


def test_fill_joins_the_table_by_broadcast_and_never_crosses(spark):
    main, aux = _rasters(spark)
    plan = gaps.fill(main, aux, matching.cdf_lut(main.select(F.col("d").alias("v")), main.select(F.col("d").alias("v"))))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_edges(spark):
    df = spark.createDataFrame([(0, c, c) for c in range(12)], "r int, c int, d int")
    got = [r["d"] for r in layout.fix_edges(df, 12).orderBy("c").collect()]
    assert got == [3, 4, 5, 3, 4, 5, 6, 7, 8, 6, 7, 8]
    again = layout.fix_edges(layout.fix_edges(df, 12), 12).orderBy("c")
    assert [r["d"] for r in again.collect()] == got
    with pytest.raises(ValueError):
        layout.fix_edges(df, 11)


def test_polar_rows_leave_the_known_blank_rows():
    rows = layout.polar_rows(2500)
    assert rows["cap_north"] == (1, 68) and rows["band_north"] == (69, 347) or rows["band_north"][0] == 69
    assert rows["band_south"][0] == 2083 and sum(rows["cap_south"]) == 2500


def test_later_bands_cover(spark):
    one = spark.createDataFrame([(0, 0, 5), (0, 1, 6)], "r int, c int, v int")
    two = spark.createDataFrame([(0, 1, 1)], "r int, c int, v int")
    assert sorted(tuple(r) for r in layout.composite([one, two]).collect()) == [(0, 0, 5), (0, 1, 1)]


def test_bilinear_against_numpy(spark):
    rng = np.random.default_rng(5)
    grid = rng.integers(0, 256, (7, 9))
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform([-3, -2], [14, 9], (200, 2)))]
    got = geometry.sample_bilinear(spark.createDataFrame(pts, "i int, ix double, iy double"), spark.createDataFrame([(int(r), int(c), int(grid[r, c])) for r in range(7) for c in range(9)], "r int, c int, v int"), "v", 9, 7)
    for r in got.collect():
        x, y = math.floor(r["ix"]), math.floor(r["iy"])
        fx, fy = r["ix"] - x, r["iy"] - y
        g = lambda a, b: grid[min(max(a, 0), 6), b % 9]
        want = round(g(y, x) * (1 - fx) * (1 - fy) + g(y, x + 1) * fx * (1 - fy) + g(y + 1, x) * (1 - fx) * fy + g(y + 1, x + 1) * fx * fy)
        assert r["v"] == want


def test_tiles_have_their_neighbours_border(spark):
    """Sizes that do and do not divide by the side; every neighbour of every pixel is in the pixel's own tile."""
    rng = np.random.default_rng(6)
    for height, width, side in ((7, 9, 4), (8, 8, 4), (5, 3, 4), (1, 1, 2), (4, 10, 1)):
        grid = rng.integers(0, 256, (height, width))
        raster = spark.createDataFrame([(r, c, int(grid[r, c])) for r in range(height) for c in range(width)], "r int, c int, v int").repartition(3)
        got = {r["tile"]: r["block"] for r in geometry.tiles(raster, "v", width, height, side).collect()}
        n = -(-width // side)
        assert len(got) == n * -(-height // side)
        for tile, block in got.items():
            y, x = tile // n * side, tile % n * side
            rows_, columns = min(side + 1, height - y), min(side, width - x) + 1
            assert block == [int(grid[y + i, (x + k) % width]) for i in range(rows_) for k in range(columns)]
        pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform([-width, -2], [2 * width, height + 2], (100, 2)))] + [(500, None, 1.0), (501, 1.0, None)]
        for r in geometry.sample_bilinear(spark.createDataFrame(pts, "tile int, ix double, iy double"), raster, "v", width, height, side).collect():
            if r["ix"] is None or r["iy"] is None:
                assert r["v"] is None
                continue
            x, y = math.floor(r["ix"]), math.floor(r["iy"])
            fx, fy = r["ix"] - x, r["iy"] - y
            g = lambda a, b: grid[min(max(a, 0), height - 1), b % width]
            assert r["v"] == round(g(y, x) * (1 - fx) * (1 - fy) + g(y, x + 1) * fx * (1 - fy) + g(y + 1, x) * (1 - fx) * fy + g(y + 1, x + 1) * fx * fy)


def _face_direction(face, u, v):
    x, y, z = {"px": (1.0, -v, -u), "nx": (-1.0, -v, u), "py": (u, 1.0, v), "ny": (u, -1.0, -v), "pz": (u, -v, 1.0), "nz": (-u, -v, -1.0)}[face]
    n = math.sqrt(u * u + v * v + 1.0)
    return x / n, y / n, z / n


@pytest.mark.parametrize(("size", "w", "h"), [(41, 100, 83), (600, 100, 7), (1, 5, 3)])
def test_faces_to_the_last_bit(spark, size, w, h):
    """Every pixel once, angles as the C library has them, x wrapped as the SQL wraps it; sampled values by the same numbers."""
    want = {}
    for face in px.FACES:
        for k in range(0, size * size, 1 if size < 100 else 97):
            fy, fx = divmod(k, size)
            x, y, z = _face_direction(face, fx * 2.0 / size - 1.0, fy * 2.0 / size - 1.0)
            lon = -math.pi if x == 0 and y == 0 and face == "nz" else math.atan2(y, x)
            ix = ((lon / (2 * math.pi) + 0.5) * w % w + w) % w
            want[face, fy, fx] = ix, max(0.0, min((0.5 - math.asin(max(-1.0, min(1.0, z))) / math.pi) * h, h - 1.0))
    got = [tuple(r) for r in geometry.cubemap_targets(spark, size, w, h).collect()]
    assert len(got) == len({g[:3] for g in got}) == 6 * size * size
    got = {g[:3]: g[3:] for g in got}
    assert all(got[k] == p for k, p in want.items())
    grid = np.random.default_rng(size).integers(0, 256, (h, w))
    raster = spark.createDataFrame([(r, c, int(grid[r, c])) for r in range(h) for c in range(w)], "r int, c int, d int").repartition(3)
    faces = {(r["face"], r["fy"], r["fx"]): r["v"] for r in geometry.cubemap(raster, "d", w, h, size).collect()}
    assert len(faces) == 6 * size * size
    for k, (ix, iy) in want.items():
        x, y = math.floor(ix), math.floor(iy)
        fx, fy, x, z, below = ix - x, iy - y, x % w, (x + 1) % w, min(y + 1, h - 1)
        assert faces[k] == round(grid[y, x] * (1 - fx) * (1 - fy) + grid[y, z] * fx * (1 - fy) + grid[below, x] * (1 - fx) * fy + grid[below, z] * fx * fy)


def test_faces_and_bands_shuffle_no_target_pixel(spark):
    """What is shuffled are source rows: the plans join a table of blocks, and pixels are made after the last exchange."""
    raster = spark.range(5000).selectExpr("int(id div 100) r", "int(id % 100) c", "int(id % 256) d")
    for out in (geometry.cubemap(raster, "d", 100, 50, 700), geometry.reproject_mercator(raster, "d", 100, 50, 60.0, 85.0, 900)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan.splitlines()[0] and "RepartitionByExpression" in plan.splitlines()[1] + plan.splitlines()[2]
    holes = geometry.cubemap(raster.where("r != 20"), "d", 100, 50, 60)
    assert 0 < holes.where("v is null").count() < holes.count() == 6 * 60 * 60


def test_coordinates_that_agree_lie_together(spark, tmp_path):
    """Files of a face's coordinates take some 3 bytes a row (4.6 where runs were longer and poles and sides shared files)."""
    geometry.cubemap_targets(spark, 1000, 100, 2000, digits=6).write.parquet(f"{tmp_path}/at")
    assert sum(p.stat().st_size for p in (tmp_path / "at").glob("*.parquet")) < 3.5 * 6 * 1000 * 1000


def _units(out):
    return int(re.search(r"Range \(0, (\d+)", out._jdf.queryExecution().optimizedPlan().toString())[1])


@pytest.mark.parametrize("size", [30_000, 180_000])
def test_source_rows_of_faces_are_shuffled_a_bounded_number_of_times(spark, size):
    """Units that get source rows do not grow with the faces (20,886 and 743,424 blocks of 512 x 512 did); large sources make them smaller."""
    raster = spark.range(5000).selectExpr("int(id div 100) r", "int(id % 100) c", "int(id % 256) d")
    assert _units(geometry.cubemap(raster, "d", 100, 2 * size, size)) <= 6 * 16 * 16
    assert _units(geometry.cubemap(raster, "d", 64 * size, 2 * size, size)) > 6 * 16 * 16


def test_source_rows_of_a_whole_map_are_shuffled_a_bounded_number_of_times(spark):
    density = spark.range(5000).selectExpr("int(id div 100) r", "int(id % 100) c", "90d - id div 100 as lat", "int(id % 256) d")
    assert _units(cloud_map(density, None, CloudMapConfig(100, 360_000, 180_000))) <= 6 * 16 * 16


def test_units_of_several_blocks_are_whole(spark):
    """Squares of blocks, and stretches of them, give every pixel once and the values that one block gives."""
    raster = spark.range(7000).selectExpr("int(id div 100) r", "int(id % 100) c", "cast(abs(hash(id)) % 256 as int) d")
    before, geometry.SIDE = geometry.SIDE, 4
    try:
        faces, band = geometry.cubemap(raster, "d", 100, 70, 100).collect(), geometry.reproject_mercator(raster, "d", 100, 70, 60.0, 85.0, 500).collect()
        geometry.SIDE = 1 << 14
        assert sorted(map(tuple, faces)) == sorted(map(tuple, geometry.cubemap(raster, "d", 100, 70, 100).collect())) and len({(r["face"], r["fy"], r["fx"]) for r in faces}) == 6 * 100 * 100
        assert sorted(map(tuple, band)) == sorted(map(tuple, geometry.reproject_mercator(raster, "d", 100, 70, 60.0, 85.0, 500).collect()))
    finally:
        geometry.SIDE = before


def test_files_of_a_band_are_small(spark, tmp_path):
    """Under a byte a row (2.3 where blocks were long rows), and source rows are shuffled for a bounded number of units (125,001 blocks for 600,000 columns)."""
    raster = spark.range(640_000).selectExpr("int(id div 64) r", "int(id % 64) c", "cast(abs(hash(id)) % 256 as int) d")
    geometry.reproject_mercator(raster, "d", 64, 10_000, 60.0, 85.0, 10_000).write.parquet(f"{tmp_path}/band")
    assert sum(p.stat().st_size for p in (tmp_path / "band").glob("*.parquet")) < 694 * 10_000
    assert _units(geometry.reproject_mercator(raster, "d", 64, 600_000, 60.0, 85.0, 600_000)) <= 1200


def test_south_pole_pixel_has_a_longitude(spark):
    at = geometry.cubemap_targets(spark, 4, 100, 50).where("face = 'nz' and fx = 2 and fy = 2").first()
    assert at["ix"] == 0.0 and at["iy"] == 49.0


def test_lanczos_keeps_constants_and_size(spark):
    df = spark.createDataFrame([(r, c, 77) for r in range(13) for c in range(11)], "r int, c int, v int")
    out = resample.lanczos(df, 11, 13, 4, 5)
    assert out.count() == 20 and set(values(out, "v")) == {77}
    assert resample.lanczos(df, 11, 13, 11, 13).count() == 143


def test_lanczos_in_whole_numbers(spark, monkeypatch):
    """Against sums of one pixel after the other, for odd sizes, larger and smaller, over several stretches."""
    monkeypatch.setattr(resample, "STRETCH", 4)
    rng = np.random.default_rng(3)

    def resized(plane, n_out):
        n_in, out = len(plane), []
        for o in range(n_out):
            mid, wide = (o + 0.5) * n_in / n_out, max(1.0, n_in / n_out)
            at = range(max(0, math.floor(mid - 3 * wide + 0.5)), min(n_in, math.floor(mid + 3 * wide + 0.5)))
            x = [(i - mid + 0.5) / wide for i in at]
            w = [1.0 if t == 0 else 3 * math.sin(math.pi * t) * math.sin(math.pi * t / 3) / (math.pi * t) ** 2 if abs(t) < 3 else 0.0 for t in x]
            whole = [math.trunc(v / math.fsum(w) * 2**22 + math.copysign(0.5, v)) for v in w]
            out.append([max(0, min(255, (2**21 + sum(k * plane[i][c] for k, i in zip(whole, at, strict=True))) >> 22)) for c in range(len(plane[0]))])
        return out

    for height, width, out_height, out_width in ((23, 17, 9, 5), (7, 9, 20, 31), (30, 6, 30, 4), (5, 8, 13, 8), (1, 1, 3, 2)):
        plane = rng.integers(0, 256, (height, width)).tolist()
        df = spark.createDataFrame([(r, c, plane[r][c] if (r, c) != (0, 0) else None) for r in range(height) for c in range(width) if (r, c) != (2, 3)] + [(-1, 0, 9), (0, width, 9)], "r int, c int, v int").repartition(3)
        plane[0][0] = 0
        if height > 2 and width > 3:
            plane[2][3] = 0
        rows_ = [list(x) for x in zip(*resized([list(x) for x in zip(*plane, strict=True)], out_width), strict=True)] if out_width != width else plane
        want = resized(rows_, out_height) if out_height != height else rows_
        got = {(x["r"], x["c"]): x["v"] for x in resample.lanczos(df, width, height, out_width, out_height).collect()}
        assert got == {(r, c): want[r][c] for r in range(out_height) for c in range(out_width)}
    assert resample.lanczos(df.where("false"), 1, 1, 3, 2).count() == 0


def test_the_pass_along_rows_has_no_shuffle(spark):
    lines = spark.createDataFrame([(0, [0, 1], [1, 2])], "r int, cs array<int>, vs array<int>")
    assert "Exchange" not in resample._along_rows(lines, 2, 1)._jdf.queryExecution().executedPlan().toString()


def test_cdf_rounds_sums_to_single_precision(spark):
    """Beyond 2^24 neighbouring whole numbers are one float."""
    counts = [3, (1 << 24) + 1, 5, 1 << 25]
    got = [r["cdf"] for r in stats.cdf(spark.createDataFrame(list(enumerate(counts)), "k int, n long"), 4).orderBy("k").collect()]
    sums = np.cumsum(counts).astype(np.float32).astype(float)
    assert got == list((sums / sums[-1]).astype(np.float32))


@pytest.mark.parametrize("sweeps", [1, 7, 64])
def test_merging_finds_what_comparing_all_finds(spark, monkeypatch, sweeps):
    monkeypatch.setattr(matching, "SWEEPS", sweeps)
    rng = np.random.default_rng(sweeps)
    for n, m in ((40, 40), (3, 60), (60, 1)):
        a, b = (np.sort(rng.choice(np.linspace(0, 1, 30), k)).astype(np.float32) for k in (n, m))
        curve = lambda x: spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "k int, cdf float").repartition(3)
        got = {r["src"]: r["dst"] for r in matching.nearest_by_merge(curve(a), curve(b)).collect()}
        assert got == {i: int(np.abs(b.astype(float) - float(v)).argmin()) for i, v in enumerate(a)}
    assert matching.nearest_by_merge(curve(a), curve([])).count() == 0 == matching.nearest_by_merge(curve([]), curve(b)).count()


def test_what_is_observed_while_writing(spark, small):
    grid = stand_ins.primary_density(spark, small)
    aux = stand_ins.secondary_on_grid(spark, small)
    said: dict = {}
    cloud_map(grid, aux.select("r", "c", "s"), CloudMapConfig(100, 10, 4), said)
    assert said["auxiliary"]["floor"] == stats.background_floor(aux, "s").first()["bg"]
    want = stats.raster_stats(grid, "d").first()
    assert (said["density"]["pixels"], said["density"]["least"], said["density"]["most"]) == (want["n"], want["low"], want["high"]) and abs(said["density"]["mean"] - want["mean"]) < 1e-9
    assert said["density"]["gaps"] == grid.where(gaps.is_gap(F.col("d"), F.col("lat"))).count() > said["filled"]["zeros"] - said["density"]["zeros"]
    assert said["filled"]["low"] >= 45 and said["filled"]["n"] > 0


def test_bands_that_come_as_data(spark):
    rng = np.random.default_rng(2)
    points_ = [(i, float(v)) for i, v in enumerate(rng.uniform(-5, 95, 200).round(1))] + [(900, None), (901, float("nan")), (902, float("inf")), (903, 10.0), (904, 20.0)]
    bands = [(k, float(a), float(a + w)) for k, (a, w) in enumerate(zip(rng.integers(-10, 90, 40), rng.integers(0, 30, 40), strict=True))] + [(70, 10.0, 20.0), (70, 10.0, 20.0), (71, None, 5.0), (72, 5.0, float("inf")), (73, 30.0, 10.0)]
    rows_, table = spark.createDataFrame(points_, "i int, x double"), spark.createDataFrame(bands, "zone int, low double, high double")
    want = sorted((i, z) for i, x in points_ if x is not None and abs(x) < 1e9 for z, a, b in bands if a is not None and abs(b) < 1e9 and a < x <= b)
    for width in (3.0, 10.0, 1000.0):
        joined = intervals.interval_join(rows_, F.col("x"), table, width)
        assert sorted((r["i"], r["zone"]) for r in joined.collect()) == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    grid = spark.createDataFrame([(0.0, 5), (10.0, 0), (-10.0, 7), (20.0, None), (15.0, 0)], "lat double, d int")
    got = {r["zone"]: (r["n"], r["mean"], r["zero_percent"]) for r in intervals.band_stats(grid, "d", spark.createDataFrame([("a", 0, 10), ("b", 9, 90), ("none", 50, 60)], "zone string, low int, high int")).collect()}
    assert got == {"a": (2, 3.5, 50.0), "b": (3, 7 / 3, 200 / 3)}


def test_the_decoder_as_a_table_function(spark):
    one = b"\x0a\x0a\x0d" + struct.pack("<f", 1) + b"\x15" + struct.pack("<f", 2)
    points.register(spark)
    spark.createDataFrame([("a", one * 2), ("b", one[:-1]), ("c", one + b"\x12"), ("d", None), ("e", b"")], "name string, content binary").createOrReplaceTempView("payloads")
    got = sorted((tuple(r) for r in spark.sql("select name, seq, lat, lng, why from payloads, lateral decode_points(content)").collect()), key=repr)
    assert got == sorted([("a", 0, 1.0, 2.0, None), ("a", 1, 1.0, 2.0, None), ("a", None, None, None, "end"), ("b", None, None, None, "truncated"), ("c", 0, 1.0, 2.0, None), ("c", None, None, None, "foreign field"), ("d", None, None, None, "end"), ("e", None, None, None, "end")], key=repr)
    with pytest.raises(Exception, match="payloads are binary"):
        spark.sql("select * from decode_points(1)").collect()


def test_first_per_cell(spark):
    rows = [(3, 10.9, 20.1), (1, 10.1, 20.9), (2, -0.5, -0.5), (4, 0.5, 0.5), (5, None, 1.0), (6, float("nan"), 1.0), (7, 34.03125, 1.03125)]
    got = sorted(tuple(r) for r in points.first_per_cell(spark.createDataFrame(rows, "seq long, lat double, lng double")).collect())
    assert got == [(1, 10.1, 20.9), (2, -0.5, -0.5), (4, 0.5, 0.5), (7, 34.0312, 1.0312)]
    again = points.first_per_cell(spark.createDataFrame(got, "seq long, lat double, lng double"))
    assert sorted(tuple(r) for r in again.collect()) == got


def test_default_places_only_when_empty(spark):
    some = spark.createDataFrame([(1, 2.0, 3.0)], "seq long, lat double, lng double")
    assert points.or_default(some).count() == 1
    assert points.or_default(some.where("false")).count() == 40


def test_cap(spark):
    df = spark.range(50).select(F.col("id").alias("seq"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lng"))
    assert points.capped(df, 60).count() == 50
    assert sorted(values(points.capped(df, 20), "seq")) == sorted(values(points.capped(df.repartition(7), 20), "seq"))


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=80))
def test_decoder_never_raises(data):
    for lat, lng in points.decode_payload(data):
        assert math.isfinite(lat) and math.isfinite(lng)


def test_decoder_cases():
    one = lambda a, b: b"\x0a\x0a\x0d" + struct.pack("<f", a) + b"\x15" + struct.pack("<f", b)
    assert points.decode_payload(one(1, 2) + one(3, 4)) == [(1, 2), (3, 4)]
    assert points.decode_payload(one(1, 2) + b"\x12\x00" + one(3, 4)) == [(1, 2)]
    assert points.decode_payload(one(1, 2) + one(3, 4)[:-1]) == [(1, 2)]
    assert points.decode_payload(one(float("nan"), 2)) == []


def test_payloads_decoded_together_are_as_decoded_one_by_one(spark):
    rng = np.random.default_rng(8)
    one = lambda a, b: b"\x0a\x0a\x0d" + struct.pack("<f", a) + b"\x15" + struct.pack("<f", b)
    turned = lambda a, b: b"\x0a\x0a\x15" + struct.pack("<f", a) + b"\x0d" + struct.pack("<f", b)
    kinds = [one(1, 2), one(-3, 4), one(math.nan, 1), one(5, math.inf), turned(6, 7), b"\x0a\x0b" + one(8, 9)[2:] + b"\x18", b"\x0a\x00", b"\x12\x00", b"\x0a\x8a\x00" + one(1, 3)[2:]]
    texts = [b"".join(kinds[k] for k in rng.integers(0, len(kinds), rng.integers(0, 6)))[: rng.integers(1, 70)] for _ in range(300)] + [None, b"", one(2, 2) * 400]
    want = sorted((f"p{i:03d}", k, *p) for i, t in enumerate(texts) for k, p in enumerate(points.decode_payload(t or b"")))
    df = spark.createDataFrame([(f"p{i:03d}", t) for i, t in enumerate(texts)], "path string, content binary")
    assert sorted(tuple(r) for r in points.decode(df).collect()) == want


def test_stand_in_payloads_are_put_together_by_spark(spark, small):
    made = stand_ins.payloads(spark, small, 3)
    assert "FlatMapGroups" not in made._jdf.queryExecution().optimizedPlan().toString()
    got = {r["path"]: bytes(r["content"]) for r in made.collect()}
    at = sorted(tuple(r) for r in stand_ins.points(spark, small).collect())
    assert len(got) == 334
    for k, content in got.items():
        i = int(k.removeprefix("payload-")) * 3
        assert content == b"".join(b"\x0a\x0a\x0d" + struct.pack("<f", a) + b"\x15" + struct.pack("<f", z) for _, a, z in at[i : i + 3])
