"""Interpolation of tie-point, angle and ancillary grids to pixels. Grids have a fixed small size and are
broadcast as cells with four corners, so pixels are never shuffled."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import about, around
from .resample import CORNERS, corners, place


def pixel_grid(spark, rows: int, cols: int) -> DataFrame:
    return spark.range(rows * cols).selectExpr(f"cast(id div {cols} as int) as y", f"cast(id % {cols} as int) as x")


def _mixed(wy: Column, wx: Column, field: str | None = None) -> Column:
    v = [F.col(f"{n}.{field}" if field else n) for n in CORNERS]
    return (1 - wy) * (1 - wx) * v[0] + (1 - wy) * wx * v[1] + wy * (1 - wx) * v[2] + wy * wx * v[3]


def _placed(pixels: DataFrame, res: int, tp_res: int) -> DataFrame:
    at = lambda k: f"({k} * {res} + {res // 2})"
    return pixels.withColumns({
        "r": F.expr(f"cast({at('y')} div {tp_res} as int)"), "c": F.expr(f"cast({at('x')} div {tp_res} as int)"),
        "wy": F.expr(f"({at('y')} % {tp_res}) / {tp_res}D"), "wx": F.expr(f"({at('x')} % {tp_res}) / {tp_res}D"),
    })


def tie_points(pixels: DataFrame, grid: DataFrame, value: str, res: int = 60, tp_res: int = 5000) -> DataFrame:
    """(y, x, value): tie points (r, c, value) interpolated to pixel centres, those beyond the grid left out; by granule if
    grid has several."""
    return with_tie_points(pixels, grid, [value], res, tp_res, "inner").select(*place(pixels), value)


def with_tie_points(pixels: DataFrame, grid: DataFrame, values: list[str], res: int = 60, tp_res: int = 5000, how: str = "left") -> DataFrame:
    """Adds values of a tie-point grid (r, c, values) to the pixels, all by one lookup; null beyond the grid. One grid has
    23 x 23 cells at most and is broadcast; grids of many granules are joined as Spark sees fit."""
    by = place(grid)[:-2]
    cells = grid.select(*by, F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.struct(*values).alias("v"))
    cells = corners(cells, "v", *by).dropna(subset=list(CORNERS))  # a cell at the grid's edge lacks corners
    cells = cells if by else F.broadcast(cells)
    mixed = lambda v: _mixed(F.col("wy"), F.col("wx"), v)
    out = _placed(pixels, res, tp_res).join(cells, [*by, "r", "c"], how)
    return out.withColumns({v: mixed(v) for v in values}).drop("r", "c", "wy", "wx", "v00", "v01", "v10", "v11")


def angles_by_detector(pixels: DataFrame, grid: DataFrame, value: str, res: int = 60, tp_res: int = 5000, azimuth: bool = False) -> DataFrame:
    """As tie_points, from the grid (det, r, c, value) of the pixel's detector; null where that has no value.
    Azimuths are interpolated about each detector's first one."""
    if azimuth:
        first = grid.where(F.col(value).isNotNull()).groupBy("det").agg(F.min_by(value, F.struct("r", "c")).alias("ref"))
        grid = grid.join(first, "det").withColumn(value, about(F.col(value), F.col("ref")))
    cells = corners(grid.where(F.col(value).isNotNull()), value, "det")
    cells = cells.join(first, "det") if azimuth else cells
    out = _placed(pixels, res, tp_res).join(F.broadcast(cells), ["det", "r", "c"], "left")  # 12 detectors at most
    result = _mixed(F.col("wy"), F.col("wx"))
    return out.select("y", "x", "det", (around(result, F.col("ref")) if azimuth else result).alias(value))


def plane_filled(vz: np.ndarray, va: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zenith and azimuth of one detector (rows x columns, NaN where it has none), extended by one cell around the valid
    area, from a plane through the distances at unit altitude."""
    known = np.isfinite(vz) & np.isfinite(va)
    if not known.any():
        return np.full(vz.shape, np.nan), np.full(va.shape, np.nan)
    rows, cols = np.indices(vz.shape)
    plane = []
    for turn in (np.cos, np.sin):
        q = np.where(known, np.tan(np.radians(vz)) * turn(np.radians(va)), np.nan)
        steps = [np.diff(q, axis=k) for k in (0, 1)]
        dr, dc = (np.nanmean(d) if np.isfinite(d).any() else 0.0 for d in steps)
        plane.append(np.nanmean(q - dc * cols - dr * rows) + dc * cols + dr * rows)
    u, v = plane
    wide = np.pad(known, 1)
    near = np.logical_or.reduce([wide[1 + a : wide.shape[0] - 1 + a, 1 + b : wide.shape[1] - 1 + b] for a in (-1, 0, 1) for b in (-1, 0, 1)])
    return np.where(known, vz, np.where(near, np.degrees(np.arctan(np.hypot(u, v))), np.nan)), np.where(known, va, np.where(near, np.degrees(np.arctan2(v, u)), np.nan))


def _gridded(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    vz, va = (np.full((pdf["r"].max() + 1, pdf["c"].max() + 1), np.nan) for _ in range(2))
    vz[pdf["r"], pdf["c"]], va[pdf["r"], pdf["c"]] = pdf["vz"].astype(float), pdf["va"].astype(float)
    return vz, va


def _grid_keys(grid: DataFrame) -> list[str]:
    return [k for k in ("granule", "band", "det") if k in grid.columns]


def fill_by_plane(grid: DataFrame) -> DataFrame:
    """(granule, band, det, r, c, vz, va; the first two where grid has them): angle grids extended by one cell around the
    valid area of each detector. A detector's grid has a fixed size, and all are filled in one shuffle."""
    keys = _grid_keys(grid)
    types = dict(grid.dtypes)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        vz, va = plane_filled(*_gridded(pdf))
        own = lambda a: pd.array(a[pdf["r"], pdf["c"]], dtype="Float64")
        out = pdf[[*keys, "r", "c"]].assign(vz=own(vz), va=own(va))
        return out.assign(**{k: out[k].mask(np.isnan(out[k].to_numpy(float, na_value=np.nan))) for k in ("vz", "va")})

    schema = ", ".join(f"{k} {types[k]}" for k in (*keys, "r", "c")) + ", vz double, va double"
    return grid.select(*keys, "r", "c", "vz", "va").groupBy(*keys).applyInPandas(run, schema)


def angle_cells(grid: DataFrame) -> DataFrame:
    """(granule, band, det, r, c, corners): cells of the filled grids with all four corners: zenith z00 to z11, azimuth a00
    to a11 about the detector's first one, and that as ref. One shuffle for all granules, bands and detectors."""
    keys = _grid_keys(grid)
    types = dict(grid.dtypes)
    names = [f"{q}{a}{b}" for q in "za" for a in (0, 1) for b in (0, 1)]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        vz, va = plane_filled(*_gridded(pdf))
        known = np.isfinite(vz) & np.isfinite(va)
        ref = va[known][0] if known.any() else np.nan
        va = (va - ref + 540.0) % 360.0 - 180.0
        whole = known[:-1, :-1] & known[:-1, 1:] & known[1:, :-1] & known[1:, 1:]
        r, c = np.nonzero(whole)
        out = pd.DataFrame({**{k: [v] * len(r) for k, v in zip(keys, key, strict=True)}, "r": r, "c": c})
        for q, layer in (("z", vz), ("a", va)):
            for a in (0, 1):
                for b in (0, 1):
                    out[f"{q}{a}{b}"] = layer[r + a, c + b]
        return out.assign(ref=ref)

    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", r int, c int, " + ", ".join(f"{n} double" for n in (*names, "ref"))
    cells = grid.select(*keys, "r", "c", "vz", "va").groupBy(*keys).applyInPandas(run, schema)
    return cells.select(*keys, "r", "c", F.struct(*names, "ref").alias("corners"))


def mean_angle(*angles: Column, azimuth: bool = False) -> Column:
    """Mean of the angles that are not null; azimuths are turned by 180 degrees first if one exceeds 270."""
    turn = ((F.greatest(*angles) if len(angles) > 1 else angles[0]) > 270) if azimuth else F.lit(False)
    half = lambda a: F.pmod(a + 180.0, F.lit(360.0))
    own = [F.when(turn, half(a)).otherwise(a) for a in angles]
    n = sum((a.isNotNull().cast("int") for a in angles), F.lit(0))
    mean = F.when(n > 0, sum((F.coalesce(a, F.lit(0.0)) for a in own), F.lit(0.0)) / n)
    return F.when(turn, half(mean)).otherwise(mean)


def ancillary(pixels: DataFrame, grid: DataFrame, value: str) -> DataFrame:
    """Pixels (y, x, lat, lon) with a geographic grid (i, j, lat, lon, value) interpolated."""
    return with_ancillary(pixels, grid, [value]).select(*place(pixels), value)


def with_ancillary(pixels: DataFrame, grid: DataFrame, values: list[str]) -> DataFrame:
    """Adds values of a geographic grid (i, j, lat, lon, values) to pixels with lat and lon, all by one lookup: clamped to the
    grid's extent, and turned by 180 degrees where it may cross the antimeridian. One grid (9 x 9 points) is broadcast;
    those of many granules are joined by the column granule."""
    by = place(grid)[:-2]
    ends = grid.groupBy(*by).agg(
        *[F.max_by(k, F.col(n)).alias(f"_{k}1") for k, n in (("lat", "i"), ("lon", "j"))],
        *[F.min_by(k, F.col(n)).alias(f"_{k}0") for k, n in (("lat", "i"), ("lon", "j"))],
        F.max("i").alias("_ni"), F.max("j").alias("_nj"),
    )
    out = pixels.join(ends, by) if by else pixels.join(F.broadcast(ends))  # one row
    half = lambda c: F.pmod(c + 360.0, F.lit(360.0)) - 180.0
    cross = F.col("_lon0") > 90
    turned = lambda c: F.when(cross, half(F.col(c))).otherwise(F.col(c))
    out = out.withColumns({"_plon": turned("lon"), "_a0": turned("_lon0"), "_a1": turned("_lon1")})
    lat_step = (F.col("_lat1") - F.col("_lat0")) / F.col("_ni")
    lon_step = (F.col("_a1") - F.col("_a0")) / F.col("_nj")
    lat = F.when(F.col("lat") > F.col("_lat0"), F.col("_lat0")).when(F.col("lat") <= F.col("_lat1"), F.col("_lat1") - 0.0001 * lat_step).otherwise(F.col("lat"))
    lon = F.when(F.col("_plon") < F.col("_a0"), F.col("_a0")).when(F.col("_plon") >= F.col("_a1"), F.col("_a1") - 0.0001 * lon_step).otherwise(F.col("_plon"))
    out = out.withColumns({"_py": (lat - F.col("_lat0")) / lat_step, "_px": (lon - F.col("_a0")) / lon_step})
    out = out.withColumns({"_r": F.col("_py").cast("int"), "_c": F.col("_px").cast("int")})
    points = grid.select(*by, F.col("i").cast("int").alias("r"), F.col("j").cast("int").alias("c"), F.struct(*values).alias("v"))
    cells = corners(points, "v", *by).withColumnsRenamed({"r": "_r", "c": "_c"})
    out = out.join(cells if by else F.broadcast(cells), [*by, "_r", "_c"])
    out = out.withColumns({v: _mixed(F.col("_py") - F.col("_r"), F.col("_px") - F.col("_c"), v) for v in values})
    return out.select(*[c for c in pixels.columns if c not in values], *values)
