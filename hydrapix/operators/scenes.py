"""Scene names, metadata, angle grids in XML, geographic tiles and extents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCENE = r"S2(.)_MSIL1C_(\d{8}T\d{6})_N(\d{4})_R(\d{3})_(T\w{5})_"


def input_id(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.(zip|SAFE)$", "")


def parse_scene(name: str = "name") -> list[Column]:
    part = lambda i: F.regexp_extract(name, SCENE, i)
    start = F.to_timestamp(part(2), "yyyyMMdd'T'HHmmss")
    return [
        F.concat(F.lit("S2"), part(1)).alias("platform"), F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("start"), F.upper(F.date_format(start, "dd-MMM-yyyy")).alias("day"),
        part(3).alias("version"), part(4).cast("int").alias("orbit"), part(5).alias("granule"),
    ]


def format_scene(name: str = "name") -> Column:
    part = lambda i: F.regexp_extract(name, SCENE, i)
    version = F.concat(F.substring(part(3), 1, 2), F.lit("."), F.substring(part(3), 3, 2))
    return F.concat_ws("_", F.concat(F.lit("S2"), part(1)), F.lit("L2W"), part(2), F.concat(F.lit("N"), version), F.concat(F.lit("R"), part(4)), part(5))


def expected_files(name: str = "name") -> Column:
    """Struct of the file names that the steps of a scene's processing give, and the places of its static mask."""
    base = F.regexp_replace(F.regexp_replace(F.col(name), r"/$", ""), r"\.SAFE$", "")
    at = lambda a, n: F.substring(base, a + 1, n)
    tile = at(39, 5)
    stamp = F.concat_ws("_", at(11, 4), at(15, 2), at(17, 2), at(20, 2), at(22, 2), at(24, 2))
    ends = {"resampled": "-resampled.nc", "destriped": "-resampled_TGC.nc", "idepix": "-idepix.nc", "c2rcc": "-c2rcc.nc", "cloudmask": "-mask.nc", "polymer": "-polymer.nc"}
    mask = lambda kind: F.concat(F.substring(tile, 1, 2), F.lit(f"/{kind}-"), tile, F.lit(".tif"))
    return F.struct(
        tile.alias("granule"), stamp.alias("stamp"), *[F.concat(base, F.lit(e)).alias(n) for n, e in ends.items()],
        F.concat(at(0, 3), F.lit("_MSI_"), stamp, F.lit("_S2R_L2R.nc")).alias("acolite"), mask("mask").alias("mask"), mask("globalmask").alias("global_mask"),
    )


#: The product's global attributes that a producer fills in.
MAKER = ("institution", "references", "license", "creator_name", "creator_url", "creator_email", "contact", "project", "naming_authority", "summary")


def product_attributes(
    name: str = "name", version: str = "1.0", title: str = "Water-leaving reflectances in 60 m", copy_inputs: bool = False, processor: str = "hydrapix",
    steps: tuple[str, ...] = ("switching", "resampling"), auxiliary: str = "elevation model, ocean and inland mask", **more: str,
) -> Column:
    """Map of the product's 36 global attributes, 37 with copied inputs, from the scene's name. Those of the producer (MAKER)
    are "TBD" unless given; date_created and tracking_id differ on each run, and id holds the former."""
    part = lambda i: F.regexp_extract(name, SCENE, i)
    start = F.to_timestamp(part(2), "yyyyMMdd'T'HHmmss")
    made = F.date_format(F.current_timestamp(), "yyyyMMdd'T'HHmmss")
    day = F.concat(F.date_format(start, "yyyy-MMM-dd HH:mm:ss"), F.lit(".000000"))
    # names and values of a product format (fixed values)
    known = {
        "id": F.concat(F.lit("S2"), part(1), F.lit("_MSIL2W_"), part(2), F.lit("_N"), part(3), F.lit("_R"), part(4), F.lit("_"), part(5), F.lit("_"), made, F.lit(".nc")),
        "local_id": F.concat(part(5), F.lit("_"), part(2), F.lit("_AQU_60m.nc")), "date_created": F.concat(made, F.lit("Z")), "tracking_id": F.expr("uuid()"),
        "title": F.lit(title), "source": F.lit("Sentinel-2 MSI L1C"), "auxiliary": F.lit(auxiliary), "input": F.col(name), "processor": F.lit(f"{processor} v{version}"),
        "parameters": F.lit("--copyinputs" if copy_inputs else ""), "product_version": F.concat(F.substring(part(3), 1, 2), F.lit("."), F.substring(part(3), 3, 2)),
        "history": F.lit("; ".join(f"{s} v{version}" for s in steps)),
        "keywords": F.lit("reflectance, surface water, ocean optics, Copernicus"), "keywords_vocabulary": F.lit("NASA Global Change Master Directory (GCMD) Science keywords"),
        "Conventions": F.lit("CF-1.11"), "standard_name_vocabulary": F.lit("NetCDF Climate and Forecast (CF) Metadata Convention"),
        "cmd_data_type": F.lit("Grid"), "spatial_resolution": F.lit("60m"), "time_coverage_start": F.concat(part(2), F.lit("Z")),
        "platform": F.concat(F.lit("Sentinel-2"), part(1)), "sensor": F.lit("MSI"), "start_date": day, "stop_date": day, "metadata_profile": F.lit("beam"),
    }
    known |= {k: F.lit("TBD") for k in MAKER}
    if copy_inputs:
        known["auto_grouping"] = F.lit("rhow_B*_c:rhos_*_a:Rw*_p:Rw*:B*")
    known |= {k: F.lit(v) for k, v in more.items()}
    return F.create_map(*[x for k, v in known.items() for x in (F.lit(k), v)])


def i2m(transform: Column) -> Column:
    """'x0 dx rx y0 ry dy' to 'dx,rx,ry,dy,x0,y0'."""
    p = F.split(F.trim(transform), r"\s+")
    return F.concat_ws(",", *[p[i] for i in (1, 2, 4, 5, 0, 3)])


def xml_grid(xml: Column) -> Column:
    """Rows of numbers under Values_List/VALUES as an array of arrays."""
    return F.transform(F.xpath(xml, F.lit("//Values_List/VALUES/text()")), lambda r: F.transform(F.split(F.trim(r), r"\s+"), lambda v: v.cast("float")))


def tile_of(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(j, i) of the 3-degree tile; coordinates are truncated to whole degrees first."""
    return ((F.lit(90) - lat.cast("int")) / 3).cast("int"), ((F.lit(180) + lon.cast("int")) / 3).cast("int")


def tile_name(name: str) -> tuple[Column, Column]:
    """(j, i) of a tile named like N36E105, by its south-west corner."""
    part = lambda i: F.regexp_extract(name, r"([NS])(\d{2})([EW])(\d{3})", i)
    lat = F.when(part(1) == "N", part(2).cast("int")).otherwise(-part(2).cast("int"))
    lon = F.when(part(3) == "E", part(4).cast("int")).otherwise(-part(4).cast("int"))
    return ((F.lit(87) - lat) / 3).cast("int"), ((lon + 180) / 3).cast("int")


def edge_tiles(rings: DataFrame) -> DataFrame:
    """Tiles (ring, j, i) touched by the edges of rings (ring, n, lon, lat): the bounding rows and columns of each
    edge; edges of more than 60 columns go the other way around the globe. A ring's tiles of one row are the bits of two
    numbers, so what a task holds grows with rings and not with tiles."""
    w = Window.partitionBy("ring").orderBy("n")
    at = rings.select("ring", "n", ((90 - F.col("lat")) / 3).cast("int").alias("j"), ((180 + F.col("lon")) / 3).cast("int").alias("i"))
    edges = at.select("ring", "j", "i", F.lag("j").over(w).alias("j0"), F.lag("i").over(w).alias("i0")).where("j0 is not null")
    lo, hi = F.least("i0", "i"), F.greatest("i0", "i")
    cols = F.when(hi - lo <= 60, F.sequence(lo, hi)).otherwise(F.sequence(hi, lo + 120))
    out = edges.withColumn("jj", F.explode(F.sequence(F.least("j0", "j"), F.greatest("j0", "j")))).withColumn("ii", F.explode(cols))
    out = out.select("ring", F.col("jj").alias("j"), F.pmod(F.col("ii"), F.lit(120)).alias("i"))
    half = lambda k: F.expr(f"bit_or(if(i div 60 = {k}, shiftleft(1L, i % 60), 0L))")
    rows = out.groupBy("ring", "j").agg(half(0).alias("west"), half(1).alias("east"))
    touched = F.expr("filter(sequence(0, 119), k -> getbit(if(k < 60, west, east), k % 60) = 1)")
    return rows.select("ring", "j", F.explode(touched).alias("i"))


def extent(points: DataFrame) -> DataFrame:
    """Smallest box of (lon, lat), longitudes unwrapped about the first point's."""
    first = points.agg(F.min_by("lon", "event_id").alias("ref"))
    rel = F.pmod(F.col("lon") - F.col("ref") + 540.0, F.lit(360.0)) - 180.0
    out = points.join(F.broadcast(first)).select(rel.alias("d"), "lat", "ref")  # one row
    box = out.agg(F.first("ref").alias("ref"), F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"), F.min("d").alias("a"), F.max("d").alias("b"))
    return box.select("lat_min", "lat_max", (F.col("a") + F.col("ref")).alias("lon_min"), (F.col("b") + F.col("ref")).alias("lon_max"))


def window_of(lat: tuple[float, float], lon: tuple[float, float], rows: int, cols: int) -> list[tuple[int, int, int, int]]:
    """Windows (first row, last row, first column, last column; ends exclusive) of a global grid that hold a box: two if
    it crosses the antimeridian (lon[0] > lon[1])."""
    y = math.floor((90.0 - lat[1]) / 180.0 * rows), math.ceil((90.0 - lat[0]) / 180.0 * rows)
    x0, x1 = math.floor((lon[0] + 180.0) / 360.0 * cols), math.ceil((lon[1] + 180.0) / 360.0 * cols)
    return [(*y, x0, x1)] if lon[0] <= lon[1] else [(*y, x0, cols), (*y, 0, x1)]


def stride(lat: tuple[float, float]) -> int:
    """Columns of a global grid for one, by the cosine of the box's mean latitude."""
    return max(1, int(1.0 / math.cos(math.radians((lat[0] + lat[1]) / 2))))


def subset(pixels: DataFrame, lat: tuple[float, float], lon: tuple[float, float], rows: int, cols: int) -> DataFrame:
    """Pixels (y, x) of a global grid in the box, columns thinned by 1 / cos of its mean latitude. Across the antimeridian
    the two halves are one window, so columns are counted on through it."""
    step, base, inside = stride(lat), 0, []
    for a, b, c, d in window_of(lat, lon, rows, cols):
        inside.append(f"(y >= {a} and y < {b} and x >= {c} and x < {d} and (x - {c} + {base}) % {step} = 0)")
        base = d - c
    return pixels.where(" or ".join(inside))


def windows(boxes: DataFrame, rows: int, cols: int) -> DataFrame:
    """(granule, y0, y1, x0, x1, base, step) of boxes (granule, lat_min, lat_max, lon_min, lon_max) on a global grid: rows and
    columns, ends exclusive. A box across the antimeridian (lon_min > lon_max) has two; base is the number of columns before
    a window's first one, step the stride over all of them."""
    place = lambda v, up: f"cast({'ceil' if up else 'floor'}(({v} + 180.0D) / 360 * {cols}) as int)"
    out = boxes.selectExpr(
        "granule", f"cast(floor((90.0D - lat_max) / 180 * {rows}) as int) as y0", f"cast(ceil((90.0D - lat_min) / 180 * {rows}) as int) as y1",
        f"{place('lon_min', False)} as a", f"{place('lon_max', True)} as b", "lon_min > lon_max as crosses", "greatest(1, cast(1 / cos(radians((lat_min + lat_max) / 2)) as int)) as step",
    )
    halves = F.expr(f"if(crosses, array(struct(a as x0, {cols} as x1, 0 as base), struct(0 as x0, b as x1, {cols} - a as base)), array(struct(a as x0, b as x1, 0 as base)))")
    return out.select("granule", "y0", "y1", "step", F.explode(halves).alias("w")).select("granule", "y0", "y1", "w.*", "step")


def subsets(mask: DataFrame, boxes: DataFrame, rows: int, cols: int, tile: int = 610) -> DataFrame:
    """(granule, y, x, and the columns of mask): the windows of many boxes on a mask stored by write_tiles, as subset() takes
    them. Windows meet the tiles that they cover by the partition columns, so Spark reads no other tiles of the mask.

    A column of a tile is one row with its pixels (a tile's height of them at most), and pixels come up only where a window
    takes their column. Windows and columns meet by column and by bands of tile rows, four to eight to a window's height, so a
    window has a row for each of its columns and bands however fine the grid is. Both sides are shuffled and sorted: that table
    is larger than Spark's estimate of it and must not be broadcast."""
    at = windows(boxes, rows, cols).where("y1 > y0 and x1 > x0")
    at = at.withColumns({"top": F.expr(f"cast(y0 div {tile} as int)"), "bottom": F.expr(f"cast((y1 - 1) div {tile} as int)")})
    names = [c for c in mask.columns if c not in ("tile_y", "tile_x")]
    across = F.expr(f"sequence(cast(x0 div {tile} as int), cast((x1 - 1) div {tile} as int))")
    under = at.withColumn("tile_x", F.explode(across)).select("top", "bottom", "tile_x").distinct()
    under = under.select(F.explode(F.sequence("top", "bottom")).alias("tile_y"), "tile_x").distinct()
    under = mask.join(under, ["tile_y", "tile_x"], "left_semi")
    lines = under.groupBy("tile_y", "tile_x", F.col("x").cast("long").alias("at_x")).agg(F.collect_list(F.struct(*names)).alias("line"))
    at = at.withColumn("band", F.expr("shiftleft(1, greatest(0, cast(log2(bottom - top + 1) as int) - 2))"))  # tile rows of a band
    bands = at.select("band").distinct()  # powers of two: some thirty at most
    lines = lines.crossJoin(F.broadcast(bands)).withColumn("nth", F.expr("cast(tile_y div band as int)"))
    at = at.withColumn("x0", F.expr("x0 + pmod(-base, step)"))  # the first column taken
    taken = F.explode(F.expr("if(x0 < x1, sequence(x0, x1 - 1, step), cast(array() as array<int>))"))
    at = at.withColumn("at_x", taken).withColumn("at_x", F.col("at_x").cast("long"))
    at = at.withColumn("nth", F.explode(F.expr("sequence(cast(top div band as int), cast(bottom div band as int))")))
    # the result is far larger than what is shuffled, so Spark must not put its tasks together by that
    at = at.repartition(int(mask.sparkSession.conf.get("spark.sql.shuffle.partitions")), "band", "nth", "at_x")
    met = at.join(lines.hint("merge"), ["band", "nth", "at_x"]).where("tile_y between top and bottom")
    out = met.select("granule", "y0", "y1", F.explode("line").alias("p")).where("p.y >= y0 and p.y < y1")
    return out.select("granule", *[F.col(f"p.{c}").alias(c) for c in names])


def rasterized(rings: DataFrame, tile: int = 610) -> DataFrame:
    """(y, x) of the cells whose centre lies in some polygon, by the even-odd rule; rings (polygon, ring, n, y, x) in cells of
    the raster, n in order along each ring, which closes by itself. A centre on an edge counts as right of it.

    Each edge gives its crossings with the centres of rows; a polygon's crossings in a row, sorted, turn into runs of columns
    by parity; runs are cut at tiles, and those of several polygons in a row of a tile are united before any cell is made. So
    a group is a polygon's row or a tile's row, and memory does not grow with a polygon's area."""
    w = Window.partitionBy("polygon", "ring")
    nxt = lambda c: F.coalesce(F.lead(c).over(w.orderBy("n")), F.first(c).over(w.orderBy("n")))
    edges = rings.select("polygon", F.col("y").alias("y1"), F.col("x").alias("x1"), nxt("y").alias("y2"), nxt("x").alias("x2")).where("y1 <> y2")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    # rows whose centre row + 0.5 lies in [low, high)
    spans = edges.withColumn("a", F.greatest(F.ceil(low - 0.5), F.lit(0)).cast("int")).withColumn("b", (F.ceil(high - 0.5) - 1).cast("int")).where("b >= a")
    at = spans.withColumn("row", F.explode(F.sequence("a", "b"))).select("polygon", "row", F.expr("x1 + (row + 0.5D - y1) / (y2 - y1) * (x2 - x1)").alias("c"))
    runs = at.groupBy("polygon", "row").agg(F.array_sort(F.collect_list("c")).alias("c"))
    pairs = F.expr("transform(sequence(0, size(c) div 2 - 1), i -> struct(cast(greatest(ceil(c[2 * i] - 0.5D), 0) as int) as a, cast(ceil(c[2 * i + 1] - 0.5D) - 1 as int) as b))")
    runs = runs.select("row", F.explode(pairs).alias("r")).select("row", "r.*").where("b >= a")
    runs = runs.withColumn("tile_x", F.explode(F.expr(f"sequence(cast(a div {tile} as int), cast(b div {tile} as int))")))
    runs = runs.select("row", "tile_x", F.expr(f"greatest(a, tile_x * {tile})").alias("a"), F.expr(f"least(b, tile_x * {tile} + {tile - 1})").alias("b"))
    runs = runs.groupBy("row", "tile_x", "a").agg(F.max("b").alias("b"))  # of runs with one start the longest: a tile's width of them at most
    line = Window.partitionBy("row", "tile_x").orderBy("a")
    reach = F.coalesce(F.max("b").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    fresh = runs.select("row", F.greatest("a", reach + 1).alias("a"), "b").where("b >= a")  # what no run before it covers
    return fresh.select(F.col("row").alias("y"), F.explode(F.sequence("a", "b")).alias("x"))


def feature_tiles(rings: DataFrame) -> DataFrame:
    """(j, i, feature): each feature (feature, ring, n, lon, lat) once for each 3-degree tile that its edges touch."""
    named = rings.withColumn("ring", F.struct("feature", "ring"))
    return edge_tiles(named).select("j", "i", F.col("ring.feature").alias("feature")).distinct()


def write_feature_tiles(features: DataFrame, tiles: DataFrame, path: str) -> None:
    """Features (feature, and whatever they carry) as one folder for each tile that they touch, by the table (j, i, feature):
    a feature goes to many tiles in one shuffle, and a rerun replaces the tiles that it writes. Large tiles are split."""
    out = tiles.join(features, "feature").hint("rebalance", "j", "i")
    out.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("j", "i").parquet(path)


def sorted_longitudes(lons: Column) -> Column:
    """Longitudes in the order that has no jump at the antimeridian: sorted by lon mod 360, then to +-180."""
    return F.transform(F.array_sort(F.transform(lons, lambda v: F.pmod(v, F.lit(360.0)))), lambda v: F.when(v >= 180, v - 360.0).otherwise(v))
