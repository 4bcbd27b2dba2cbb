"""The two chains as functions: resampling of a granule, and switching to the water product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import columns
from .operators import granule, interpolate, resample, switching
from .sources.rasters import append_statistics, save_layers, write_tiles, zipped


def resample_band(df: DataFrame, value: str, source_res: int, target_res: int, rows: int, cols: int, downsampling: str = "mean", upsampling: str = "bilinear", reflectance: bool = True) -> DataFrame:
    """A band at the target resolution: aggregated if that is coarser, interpolated if finer, else as it is."""
    if target_res > source_res:
        return resample.downsample(df, downsampling, target_res // source_res, value, reflectance)
    if target_res < source_res:
        f = source_res // target_res
        if upsampling == "nearest":
            return resample.upsample_nearest(df, f, value)
        if upsampling != "bilinear":
            raise NotImplementedError(f"{upsampling}: choose nearest or bilinear")
        return resample.upsample_bilinear(df, f, value, rows, cols, reflectance=reflectance)
    return df.select("y", "x", value)


def switch(stack: DataFrame, path: str, product: str, copy_inputs: bool = False, acolite_index: str = "reference", tile: int = 610) -> DataFrame:
    """Writes the water product as tiles, appends its statistics, and returns the product. The pixel frame is
    computed once, for the table; the statistics, of all its granules, are counted from what was written."""
    many = [c for c in ("granule",) if c in stack.columns]
    out = switching.l2w(stack, acolite_index, copy_inputs, keep=("s2wmask", *many))
    write_tiles(out, f"{path}/pixels", tile)
    done = out.sparkSession.read.parquet(f"{path}/pixels")
    append_statistics(switching.scene_statistics(done), f"{path}/statistics", product)
    return done


def static_mask(regional: DataFrame | None, everywhere: DataFrame | None, pixels: DataFrame) -> DataFrame:
    """Mask code of each pixel: the regional mask, else the global one, else ocean. Masks of several granules have a column
    granule."""
    out = pixels
    for n, m in (("m1", regional), ("m2", everywhere)):
        if m is None:
            out = out.withColumn(n, F.lit(None).cast("int"))
        else:
            key = resample.place(m)
            out = out.join(m.select(*key, F.col("code").alias(n)), key, "left")
    return out.withColumn("s2wmask", F.coalesce("m1", "m2", F.lit(64))).drop("m1", "m2")


def resample_product(
    images: dict[int, DataFrame],
    shape: tuple[int, int],
    resolution: int = 60,
    angles: DataFrame | dict[str, DataFrame] | None = None,
    sun: DataFrame | dict[str, DataFrame] | None = None,
    place_of: DataFrame | None = None,
    ancillary: list[DataFrame] | None = None,
    **options,
) -> DataFrame:
    """The resampling step: bands, detectors and flags at one resolution, viewing angles and their means, layers of the sun's
    tie-point grid (r, c, layers), lat and lon by place_of (zone, north, left, top: the image's UTM zone, hemisphere and
    upper left corner), and the layers of ancillary grids (i, j, lat, lon, layers) there. With a column granule in all of
    them it does many granules."""
    out = granule.resample_granule(images, resolution, shape, **options)
    if angles is not None:
        out = granule.viewing_angles(out, angles, resolution, "master_detfoo" if options.get("detector_filter", True) else None)
    for grid in sun.values() if isinstance(sun, dict) else [sun] if sun is not None else []:
        layers = [c for c in grid.columns if c not in ("granule", "r", "c")]
        out = interpolate.with_tie_points(out, grid, layers, resolution)
    if place_of is not None:
        out = georeferenced(out, place_of, resolution)
    for grid in ancillary or []:
        layers = [c for c in grid.columns if c not in ("granule", "i", "j", "lat", "lon")]
        out = interpolate.with_ancillary(out, grid, layers)
    return out


def georeferenced(pixels: DataFrame, place_of: DataFrame, resolution: int) -> DataFrame:
    """Adds lat and lon of the pixels' centres by a table (zone, north, left, top), with a row for each granule."""
    keep = [c for c in pixels.columns if c not in ("lat", "lon")]
    by = [c for c in ("granule",) if c in place_of.columns]
    at = place_of.select(*by, *[F.col(c).alias(f"_{c}") for c in ("zone", "north", "left", "top")])
    out = pixels.select(*keep).join(at, by) if by else pixels.select(*keep).join(F.broadcast(at))  # one row
    x, y = F.col("_left") + (F.col("x") + 0.5) * resolution, F.col("_top") - (F.col("y") + 0.5) * resolution
    return columns.to_geographic(out, x.cast("double"), y.cast("double"), F.col("_zone"), F.col("_north")).select(*keep, "lat", "lon")


def process(
    images: dict[int, DataFrame],
    shape: tuple[int, int],
    corrections: list[DataFrame],
    path: str,
    product: str,
    masks: tuple[DataFrame | None, DataFrame | None] = (None, None),
    resolution: int = 60,
    tile: int = 610,
    copy_inputs: bool = False,
    acolite_index: str = "reference",
    **options,
) -> DataFrame:
    """The whole chain: resampling (options are those of resample_product), then the results of the external corrections
    (tables by y and x) and the static mask, then switching, the product's tiles and statistics. Numbers B2, B4 and B11 and
    the quality flags of all bands serve classification.

    With a column granule in all tables one job does many granules. The resampled image and the corrections are then stored
    bucketed by granule and tile and meet without a shuffle; the product has that column too."""
    out = resample_product(images, shape, resolution, **options)
    if "granule" in out.columns:
        layers = {"resampled": out} | {f"correction{i}": t for i, t in enumerate(corrections)}
        out = zipped(save_layers(layers, f"{path}/layers", tile)).drop("tile_y", "tile_x")
    else:
        for table in corrections:
            out = out.join(table, resample.place(out))
    out = static_mask(*masks, out)
    out = out.withColumnsRenamed({"B2": "b2", "B4": "b4", "B11": "b11"}).withColumn("pid", F.col("y").cast("long") * (shape[1] * 60 // resolution) + F.col("x"))
    return switch(out, path, product, copy_inputs, acolite_index, tile)
