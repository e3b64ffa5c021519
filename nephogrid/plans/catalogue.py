"""Named queries of the raster and point operators, each with the SQL that checks it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nephogrid.functions import pixels as px
from nephogrid.operators import discovery, gaps, geometry, intervals, layout, matching, points, resample, stats
from nephogrid.plans import cloud_map
from nephogrid.plans.oracles import ORACLES
from nephogrid.sources import gridded, listing, png, published, rasters
from nephogrid.sources import stand_ins as si
from nephogrid.storage import materialize, scratch_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
__all__ = ["ORACLES", "QUERIES"]


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Registers a query; whole numbers go out as longs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = f(spark, sf_dir)
        return out.select(*[F.col(c).cast("long").alias(c) if t in ("int", "smallint") else F.col(c) for c, t in out.dtypes])

    QUERIES[f.__name__] = run
    return run


@query
def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.primary(spark, sf_dir).select("r", "c", px.density(F.col("bt"), F.col("phase")).alias("d"))


@query
def density_no_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.primary(spark, sf_dir).select("r", "c", px.density(F.col("bt")).alias("d"))


@query
def density_fill_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With 200 standing in for the fill value."""
    return si.primary(spark, sf_dir).select("r", "c", px.density_with_fill(F.col("bt"), 200.0).alias("d"))


@query
def density_prescaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.secondary(spark, sf_dir, polar_only=False).select("r", "c", px.prescaled(F.col("s")).alias("d"))


@query
def gamma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.primary_density(spark, sf_dir).select("r", "c", "d")


def _stretched(spark: SparkSession, sf_dir: str, least: int) -> DataFrame:
    d = si.primary_density(spark, sf_dir).select("r", "c", px.threshold(F.col("d"), least).alias("d"))
    of = d.crossJoin(F.broadcast(stats.value_range(d, "d")))  # one row
    return of.select("r", "c", px.stretch(F.col("d"), F.col("low"), F.col("high"), F.col("n")).alias("d"))


@query
def threshold_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stretched(spark, sf_dir, 45)


@query
def threshold_stretch_35(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stretched(spark, sf_dir, 35)


@query
def zone_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = si.primary(spark, sf_dir).withColumn("d", px.density(F.col("bt"), F.col("phase")))
    return stats.zone_stats(d, "d").select("zone", "n", F.round("mean", 6).alias("mean"), F.round("zero_percent", 6).alias("zero_percent"))


@query
def band_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics for overlapping bands of latitude, one a supplier."""
    k = F.col("s_suppkey")
    bands = si.table(spark, sf_dir, "supplier").select(k.alias("zone"), (k * 7 % 83).alias("low"), (k * 7 % 83 + k % 16).alias("high"))
    s = intervals.band_stats(si.primary_density(spark, sf_dir), "d", bands)
    return s.select("zone", "n", F.round("mean", 6).alias("mean"), F.round("zero_percent", 6).alias("zero_percent"))


@query
def raster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stats.raster_stats(si.primary_density(spark, sf_dir), "d")
    return s.select("n", "missing", "low", "high", *[F.round(c, 6).alias(c) for c in ("mean", "zero_percent", "mean_above_zero")])


@query
def background_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.background_floor(si.secondary(spark, sf_dir), "s")


@query
def background_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.subtract_background(si.secondary(spark, sf_dir), "s").select("r", "c", "s")


@query
def histogram256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(si.secondary(spark, sf_dir), "s")


@query
def cdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = stats.histogram(si.secondary(spark, sf_dir).where("s > 0"), "s")
    return stats.cdf(h).select("k", F.round(F.col("cdf").cast("double"), 6).alias("cdf"))


def _lut(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    main, aux = si.primary_density(spark, sf_dir), gaps.subtract_background(si.secondary_on_grid(spark, sf_dir), "s")
    return main, aux, gaps.match_table(main, aux)


@query
def cdf_lut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lut(spark, sf_dir)[2]


@query
def match_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest match of two curves of 65,536 counts: order totals to line prices."""
    count = lambda t, c: si.table(spark, sf_dir, t).select((F.floor(c) % 65536).alias("v"))
    source, target = (stats.cdf(stats.histogram(count(*x), "v"), 1 << 16) for x in (("orders", "o_totalprice"), ("lineitem", "l_extendedprice")))
    return matching.nearest_by_merge(source, target)


@query
def lut_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, aux, lut = _lut(spark, sf_dir)
    return matching.apply_lut(aux, lut, "s").select("r", "c", "s")


@query
def gap_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.primary_density(spark, sf_dir).select("r", "c", gaps.is_gap(F.col("d"), F.col("lat")).alias("gap"))


@query
def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.fill(*_lut(spark, sf_dir), feather=False).select("r", "c", "d")


@query
def gap_fill_feather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.fill_gaps(si.primary_density(spark, sf_dir), si.secondary_on_grid(spark, sf_dir)).select("r", "c", "d")


@query
def edge_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.fix_edges(si.primary_density(spark, sf_dir).select("r", "c", "d"), si.WIDTH)


@query
def pad_to_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows within 60 degrees, counted from the first of them, on a grid of 104 columns."""
    d = si.primary_density(spark, sf_dir).where(F.abs("lat") <= 60)
    first = d.agg(F.min("r").alias("first"))
    d = d.crossJoin(F.broadcast(first)).withColumn("r", F.col("r") - F.col("first")).drop("first")
    return layout.pad_to_global(d, 104)


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plane cut into tiles of 16 x 16."""
    return si.plane(spark, sf_dir).select(F.expr("r div 16").alias("ty"), F.expr("c div 16").alias("tx"), (F.col("r") % 16).alias("y"), (F.col("c") % 16).alias("x"), "v")


@query
def mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.mosaic(_tiles(spark, sf_dir), 16)


def _caps(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, int, int]]:
    """The whole secondary raster as either cap, the southern one inverted."""
    b, h = si.secondary(spark, sf_dir, polar_only=False), si.secondary_height(spark, sf_dir)
    return {"cap_north": (b.select("r", "c", F.col("s").alias("v")), si.WIDTH, h), "cap_south": (b.select("r", "c", (255 - F.col("s")).alias("v")), si.WIDTH, h)}


@query
def png_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of 16 x 16 written as grey images, read back and put together."""
    tiles = png.images(_tiles(spark, sf_dir), ["ty", "tx"], 16, 16, row="y", column="x", rows=6)
    return layout.mosaic(png.whole_pixels(tiles.withColumnRenamed("image", "content"), ["ty", "tx"]), 16)


@query
def png_luminance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole plane as one colour image for each 50 rows; luminance of what is read back."""
    colour = si.plane(spark, sf_dir).select(F.expr("r div 50").alias("part"), (F.col("r") % 50).alias("r"), "c", F.col("v").alias("red"), (255 - F.col("v")).alias("green"), (F.col("v") * 7 % 256).alias("blue"))
    whole = png.images(colour, ["part"], 64, 50, values=("red", "green", "blue"), rows=16)
    return png.whole_pixels(whole.withColumnRenamed("image", "content"), ["part"]).select((F.col("part") * 50 + F.col("y")).alias("r"), F.col("x").alias("c"), "v")


@query
def band_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rasters as all four bands, each resized to its rows."""
    caps = _caps(spark, sf_dir)
    return layout.polar_composite(caps | {"band_north": caps["cap_south"], "band_south": caps["cap_north"]}, si.WIDTH, si.height(spark, sf_dir))


@query
def polar_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polar auxiliary from tiles and caps."""
    rows = si.table(spark, sf_dir, "embeddings").count()
    return cloud_map.polar_auxiliary(_tiles(spark, sf_dir), 16, (64, rows), _caps(spark, sf_dir), si.WIDTH, si.height(spark, sf_dir))


@query
def source_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest slot, its raster, density and gamma, half the size."""
    h = si.height(spark, sf_dir)
    slots, now, path = _slots(spark, sf_dir)
    grid, stamp = cloud_map.load_first(slots, now, lambda _: (si.primary(spark, sf_dir), si.WIDTH, h), path, cloud_map.CloudMapConfig(si.WIDTH // 2, h // 2))
    return grid.select(F.lit(stamp).alias("stamp"), "r", "c", F.round("lat", 6).alias("lat"), "d")


@query
def whole_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill, threshold, stretch, edges and faces."""
    h = si.height(spark, sf_dir)
    return cloud_map.cloud_map(si.primary_density(spark, sf_dir), si.secondary_on_grid(spark, sf_dir), cloud_map.CloudMapConfig(si.WIDTH, h, h // 2))


def _scratch_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/files-{uuid.uuid4().hex}"


@query
def map_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: newest slot, gaps filled from landed images, faces published, and read back from what ``latest`` means."""
    h, rows, caps = si.height(spark, sf_dir), si.table(spark, sf_dir, "embeddings").count(), _caps(spark, sf_dir)
    # every tile of the plane is landed, also where no vector gives it a pixel
    blank = spark.range(-(-rows // 16) * 4).selectExpr("id div 4 as ty", "cast(id % 4 as int) as tx", "0 as y", "0 as x", "cast(null as int) as v")
    tiles = png.images(_tiles(spark, sf_dir).unionByName(blank), ["ty", "tx"], 16, 16, row="y", column="x").withColumnRenamed("image", "content")
    _, w, cap_rows = caps["cap_north"]
    both = caps["cap_north"][0].withColumn("cap", F.lit("cap_north")).unionByName(caps["cap_south"][0].withColumn("cap", F.lit("cap_south")))
    landed = png.images(both, ["cap"], w, cap_rows).withColumnRenamed("image", "content")
    polar = cloud_map.PolarInputs(materialize(tiles, "landed-tiles"), 16, (64, rows), materialize(landed, "landed-caps"), {k: (w, cap_rows) for k in caps})
    slots, now, path = _slots(spark, sf_dir)
    root = _scratch_folder(spark)
    stamp = cloud_map.run_job(slots, now, lambda _: (si.primary(spark, sf_dir), si.WIDTH, h), path, polar, root, cloud_map.CloudMapConfig(si.WIDTH, h, h // 2), repository="Some-Owner/Site")
    said = published.latest(spark, root).first()
    faces = cloud_map.published_faces(spark, root)
    return faces.select("face", "fy", "fx", "v", F.lit(stamp).alias("stamp"), F.lit(said["manifest"]["baseUrl"]).alias("base_url"), F.lit(len(said["files"])).alias("files"))


@query
def gridded_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plane as a gridded file of 32 x 16 chunks; rows from 64 on and columns 10 to 39 of what is read from it, with a coordinate of its own."""
    rows, path = si.table(spark, sf_dir, "embeddings").count(), f"{_scratch_folder(spark)}/plane.nc"
    lat = [90.0 - 180.0 * i / rows for i in range(rows)]
    si.grid_file(si.plane(spark, sf_dir), path, ["v"], {"lat": lat}, rows, 64, 32, 16, {})
    got = gridded.read_grid(spark, path, "r int, c int, lat double, v double").where("r >= 64 and c >= 10 and c < 40")
    return got.select("r", "c", F.round("lat", 6).alias("lat"), F.col("v").cast("long").alias("v"))


@query
def second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second source from its gridded file: the rows within 60 degrees as counts of one layer, padded to the globe."""
    h, path = si.height(spark, sf_dir), f"{_scratch_folder(spark)}/second.nc"
    lat = [90.0 - r * 180.0 / (h - 1) for r in range(h)]
    first, lat = next(r for r in range(h) if abs(lat[r]) <= 60), [x for x in lat if abs(x) <= 60]
    counts = si.primary(spark, sf_dir).where(F.col("r").between(first, first + len(lat) - 1)).select((F.col("r") - first).alias("r"), "c", F.col("bt").alias("LIR"))
    si.grid_file(counts, path, ["LIR"], {"lat": lat}, len(lat), si.WIDTH, 16, 50, {"LIR": {"long_name": "counts in kelvin"}, "": {"time_coverage_start": "2024-01-31T12:00:00Z"}})
    grid, stamp = cloud_map.load_second(spark, path, 200.0, 104)
    return grid.select("r", "c", "d", F.lit(stamp).alias("stamp"))


@query
def published_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The density raster published as strips of 16 rows, twice under one alias, and read back: each strip's place and sum."""
    grid = si.primary_density(spark, sf_dir)
    root = _scratch_folder(spark)
    for stamp, value in (("first", F.lit(255)), ("second", F.col("d"))):
        strips = rasters.strips(grid.withColumn("d", value), si.WIDTH, 16).select(F.format_string("strip-%06d.png", "strip").alias("name"), F.col("image").alias("content"))
        published.publish(strips, root, stamp)
    got = published.read_latest(spark, root)
    v = png.whole_pixels(got, ["name"])
    return v.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.sum(F.col("v") * (F.col("y") * 100 + F.col("x"))).alias("moment"))


@query
def mercator_reproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A band as wide as the plane is high."""
    rows = si.table(spark, sf_dir, "embeddings").count()
    return geometry.reproject_mercator(si.plane(spark, sf_dir), "v", 64, rows, 60.0, 85.0, rows)


@query
def bilinear_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = si.table(spark, sf_dir, "embeddings").count()
    k = F.col("event_id")
    at = si.table(spark, sf_dir, "events").select(k.alias("id"), (k * 7 % 6400 / 100.0).alias("ix"), (k * 13 % (rows * 100) / 100.0).alias("iy"))
    return geometry.sample_bilinear(at, si.plane(spark, sf_dir), "v", 64, rows).select("id", "v")


@query
def cubemap_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = si.height(spark, sf_dir)
    return geometry.cubemap_targets(spark, h // 2, si.WIDTH, h, digits=6)


@query
def cubemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = si.height(spark, sf_dir)
    return geometry.cubemap(si.primary_density(spark, sf_dir), "d", si.WIDTH, h, h // 2)


@query
def lanczos_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = si.table(spark, sf_dir, "embeddings").count()
    return resample.lanczos(si.plane(spark, sf_dir), 64, rows, 25, rows // 2)


@query
def storm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.first_per_cell(si.points(spark, sf_dir))


@query
def storm_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.or_default(si.points(spark, sf_dir).where("lat > 90"))


@query
def storm_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With an order that both engines can state."""
    return points.capped(si.points(spark, sf_dir), 2000, order=F.col("seq") * 7919 % 10007)


@query
def storm_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads decoded, one point a cell, at most 2,000, as one JSON array."""
    order = F.col("seq.seq") * 7919 % 503
    return points.to_json(points.storm_points(si.payloads(spark, sf_dir), 2000, order=order))


@query
def storm_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of three points, each whole and cut after every byte."""
    cut = si.payloads(spark, sf_dir, 3).withColumn("n", F.explode(F.sequence(F.lit(0), F.length("content"))))
    return points.decode(cut.select(F.concat("path", F.lit("/"), F.lpad(F.col("n").cast("string"), 2, "0")).alias("path"), F.substr("content", F.lit(1), F.col("n")).alias("content")))


@query
def storm_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of three points, cut after every byte and with a foreign field behind, through the table function: how many points, and why it ended."""
    cut = si.payloads(spark, sf_dir, 3).withColumn("n", F.explode(F.sequence(F.lit(-1), F.length("content"))))
    cut = cut.select("path", "n", F.when(F.col("n") < 0, F.concat("content", F.lit(b"\x12\x00"))).otherwise(F.substr("content", F.lit(1), F.col("n"))).alias("content"))
    got = cut.lateralJoin(points.DecodePoints(F.col("content").outer()))
    return got.groupBy("path", "n").agg(F.count("seq").alias("points"), F.max("why").alias("why"))


def _slots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column, Column]:
    """Slots, the time from which to look back, and the path of a slot."""
    e = si.table(spark, sf_dir, "events")
    now = e.agg((F.date_trunc("hour", F.max("ts")) - F.make_interval(hours=F.lit(30))).alias("now")).first()["now"]
    slots = e.select(F.date_trunc("hour", "ts").alias("slot"), (F.col("event_type") == "purchase").alias("available"))
    return slots, F.lit(now), discovery.hourly_path("archive", "composite", F.col("slot"))


@query
def latest_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots, now, path = _slots(spark, sf_dir)
    return discovery.latest_slot(slots, now).select(F.date_format("slot", "yyyyMMdd_HHmmss").alias("stamp"), path.alias("path"))


@query
def second_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variable, scaling and stamp read off made headers, one for each event type and hour."""
    e = si.table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").alias("hour"), "event_type").distinct()
    names = F.when(F.col("event_type") == "view", F.array(F.lit("x"), F.lit("LIR"))).when(F.col("event_type") == "click", F.array(F.lit("IR"), F.lit("data"))).otherwise(F.array(F.lit("y"), F.lit("z")))
    long_name = F.concat("event_type", F.when(F.hour("hour") % 2 == 0, " scaled 0-255").otherwise(" in kelvin"))
    stamp = discovery.compact_time(F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return e.select("event_type", stamp.alias("stamp"), discovery.chosen_variable(names).alias("variable"), discovery.is_scaled(long_name).alias("is_scaled"))


@query
def latest_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = si.listing(spark, sf_dir)
    now = li.agg((F.max("hour") + F.make_interval(hours=F.lit(5))).alias("now")).first()["now"]
    return discovery.latest_largest(li, F.lit(now)).select(F.date_format("stamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"), "key", "size")


def _landed_listing(spark: SparkSession, sf_dir: str) -> str:
    """A folder of files, one for each hour and type of the events: as many bytes as events, named by turns in ways that match and do not."""
    e = si.table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("size"))
    end = F.when(F.col("event_type") == "error", ".tmp").otherwise(".nc")
    key = F.concat(F.date_format("hour", "yyyy/MM/dd/HH"), F.lit("/"), "event_type", F.when(F.col("event_type") == "view", "_full_").otherwise("_blend_"), F.date_format("hour", "'s'yyyyMMddHHmmss"), end)
    root = _scratch_folder(spark)
    si.land_listing(e.select(key.alias("key"), "size"), root)
    return root


@query
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three days before the last event's, by a listing that opens no other day's folders."""
    top = si.table(spark, sf_dir, "events").agg(F.date_trunc("day", F.max("ts")).alias("t")).first()["t"]
    files = listing.listed(spark, _landed_listing(spark, sf_dir), top - timedelta(days=3), top - timedelta(hours=1))
    return files.select("key", "size", F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"))


@query
def newest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest matching file of the newest hour that has one, five hours after the last event."""
    now = si.table(spark, sf_dir, "events").agg((F.max("ts") + F.make_interval(hours=F.lit(5))).alias("t")).first()["t"]
    got = listing.newest(spark, _landed_listing(spark, sf_dir), now)
    return got.select(F.date_format("stamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"), "key", "size")


@query
def scalar_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = si.listing(spark, sf_dir).withColumn("k", F.regexp_extract("key", r"_(?:full|blend)_(\d+)", 1).cast("long"))
    compact = F.date_format("hour", "yyyyMMdd_HHmmss")
    iso, none = discovery.iso_time(compact), F.lit(None).cast("string")
    return li.select(
        "key",
        F.date_format(discovery.key_stamp(F.col("key")), "yyyy-MM-dd HH:mm:ss").alias("key_stamp"),
        iso.alias("iso"),
        discovery.compact_time(iso).alias("compact"),
        discovery.hour_prefix("product", F.col("hour")).alias("prefix"),
        discovery.tile_query("https://maps.example.org/api", "ir", F.col("k") % 4, F.expr("k div 4 % 4"), F.when(F.col("k") % 2 == 0, iso), none).alias("tile"),
        discovery.box_query("https://maps.example.org/wms?map=ir", 60 + F.col("k") % 10, F.lit(85), none, none, F.lit(1024)).alias("box"),
    )


@query
def grid_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latitudes of the primary raster's rows, and longitudes of as many columns as the secondary one has rows."""
    sizes = (("lat", si.height(spark, sf_dir), 90.0, -90.0), ("lon", si.secondary_height(spark, sf_dir), -180.0, 180.0))
    parts = [spark.range(n).select(F.lit(name).alias("axis"), F.col("id").alias("i"), F.round(px.axis(F.col("id"), a, z, n), 6).alias("value")) for name, n, a, z in sizes]
    return parts[0].unionByName(parts[1])


@query
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest an order: from a given base, from a repository's name, or from neither."""
    k = F.col("o_orderkey")
    pages = F.when(k % 3 == 0, F.concat(F.lit("https://host"), k.cast("string"), F.lit(".example.org/x"), F.repeat(F.lit("/"), (k % 4).cast("int"))))
    repository = F.when(k % 3 == 1, F.concat(F.lit("Owner-"), F.col("o_custkey").cast("string"), F.lit("/Site"), k.cast("string"))).when(k % 2 == 0, "")
    m = F.struct(discovery.base_url(pages, repository).alias("baseUrl"), F.date_format("o_orderdate", "yyyyMMdd_HHmmss").alias("timestamp"))
    return si.table(spark, sf_dir, "orders").select(k.alias("k"), F.to_json(m).alias("manifest"))
