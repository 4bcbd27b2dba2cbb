"""Resampling between resolutions: block aggregation down, replication and bilinear interpolation up.

Aggregations have one shuffle, on the block key, with partial aggregation before it. Upsampling gathers the four
corners of each cell in one shuffle and then fans out without another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import about, around

AGGREGATES = ("first", "mean", "median", "min", "flagand", "max", "flagor", "majority")


def place(df: DataFrame) -> list[str]:
    """The key of a pixel: its place, and its granule where df has several."""
    return [*(["granule"] if "granule" in df.columns else []), "y", "x"]


def block(f: int) -> list[Column]:
    return [F.expr(f"y div {f}").alias("y"), F.expr(f"x div {f}").alias("x")]


def downsample(df: DataFrame, mode: str, f: int, value: str, reflectance: bool = False) -> DataFrame:
    """(y, x, value) at a resolution coarser by f. Reflectances of 0 are missing; their results are truncated and
    0 where nothing is left. Flag modes are the numeric minimum and maximum."""
    v = F.col(value)
    if mode == "first":
        keep = df.where(f"y % {f} = {(f - 1) // 2} and x % {f} = {(f - 1) // 2}")
        return keep.select(*place(df)[:-2], *block(f), v.alias(value))
    if reflectance:
        v = F.when(v != 0, v)
    if mode == "mean":
        out = F.avg(v)
    elif mode == "median":
        out = F.median(v)
    elif mode in ("min", "flagand"):
        out = F.min(v)
    elif mode in ("max", "flagor"):
        out = F.max(v)
    elif mode == "majority":
        out = F.expr(f"cast(bround(avg({value})) as int)")
    else:
        raise NotImplementedError(f"{mode}: choose one of {', '.join(AGGREGATES)}")
    if reflectance:
        out = F.coalesce(out.cast("int"), F.lit(0))
    return df.groupBy(*place(df)[:-2], *block(f)).agg(out.alias(value))


def downsample_by_detector(df: DataFrame, f: int, value: str, target: DataFrame, detector: str = "det", reflectance: bool = True) -> DataFrame:
    """Mean over the contributions of the target's detector (target: y, x, tgt), truncated."""
    v = F.when(F.col(value) != 0, F.col(value)) if reflectance else F.col(value)
    fine = df.withColumns({"by": F.expr(f"y div {f}"), "bx": F.expr(f"x div {f}")}).drop("y", "x")
    both = fine.join(target.select(F.col("y").alias("by"), F.col("x").alias("bx"), "tgt"), ["by", "bx"])
    out = F.coalesce(F.avg(F.when(F.col(detector) == F.col("tgt"), v)).cast("int"), F.lit(0))
    return both.groupBy(F.col("by").alias("y"), F.col("bx").alias("x")).agg(out.alias(value))


def master_detector(df: DataFrame, f: int, target: DataFrame, detector: str = "det") -> DataFrame:
    """The target detector where some contribution has it, else 0."""
    fine = df.withColumns({"by": F.expr(f"y div {f}"), "bx": F.expr(f"x div {f}")}).drop("y", "x")
    both = fine.join(target.select(F.col("y").alias("by"), F.col("x").alias("bx"), "tgt"), ["by", "bx"])
    seen = F.max((F.col(detector) == F.col("tgt")).cast("int"))
    return both.groupBy(F.col("by").alias("y"), F.col("bx").alias("x")).agg(F.when(seen == 1, F.max("tgt")).otherwise(0).alias("master"))


def circular_mean(df: DataFrame, f: int, angle: str, detector: str = "det") -> DataFrame:
    """Mean angle of each block and detector about the first angle there, so 359 and 1 give 0."""
    keyed = df.select(*[c.alias(n) for c, n in zip(block(f), ("by", "bx"), strict=True)], "y", "x", detector, angle)
    keys = ["by", "bx", detector]
    ref = keyed.where(F.col(angle).isNotNull()).groupBy(*keys).agg(F.min_by(angle, F.struct("y", "x")).alias("ref"))
    turned = keyed.join(ref, keys).groupBy(*keys, "ref").agg(F.avg(about(F.col(angle), F.col("ref"))).alias("m"))
    return turned.select(F.col("by").alias("y"), F.col("bx").alias("x"), detector, around(F.col("m"), F.col("ref")).alias(angle))


def upsample_nearest(df: DataFrame, f: int, value: str) -> DataFrame:
    offsets = F.sequence(F.lit(0), F.lit(f - 1))
    out = df.withColumn("dy", F.explode(offsets)).withColumn("dx", F.explode(offsets))
    return out.select(*place(df)[:-2], (F.col("y") * f + F.col("dy")).alias("y"), (F.col("x") * f + F.col("dx")).alias("x"), value)


def corners(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Each cell (r, c) with its own value and those right, below and both: v00, v01, v10, v11. Each cell goes to
    the four cells that it is a corner of, in one shuffle."""
    places = F.explode(F.array(*[F.struct((F.col("r") - a).alias("r"), (F.col("c") - b).alias("c"), F.lit(2 * a + b).alias("q")) for a in (0, 1) for b in (0, 1)]))
    out = df.select(*keys, value, places.alias("o")).select(*keys, "o.*", value)
    return out.groupBy(*keys, "r", "c").agg(*[F.max(F.when(F.col("q") == q, F.col(value))).alias(n) for q, n in enumerate(("v00", "v01", "v10", "v11"))])


def _with_border(k: str, n: int) -> Column:
    """Places of line k of n in the image with a border of one line (which lines 0 and n + 1 are), with weights: a border
    line goes on linearly, twice the last line less the one before."""
    first = F.struct(F.when(F.col(k).isin(0, 1), F.lit(0)).alias("at"), F.when(F.col(k) == 0, 2.0).otherwise(-1.0).alias("w"))
    last = F.struct(F.when(F.col(k).isin(n - 2, n - 1), F.lit(n + 1)).alias("at"), F.when(F.col(k) == n - 1, 2.0).otherwise(-1.0).alias("w"))
    own = F.struct((F.col(k) + 1).cast("int").alias("at"), F.lit(1.0).alias("w"))
    return F.filter(F.array(own, first, last), lambda p: p["at"].isNotNull())


CORNERS = ("v00", "v01", "v10", "v11")


def bordered_cells(df: DataFrame, values: list[str], rows: int, cols: int) -> DataFrame:
    """Cells (r, c) with four corners of each value (a struct v00, v01, v10, v11 by its name) of an image with a border
    that goes on linearly. Each pixel sends its share to all cells that it is a corner of, all values in one shuffle."""
    by = place(df)[:-2]
    out = df.select(*by, "y", "x", *[F.col(v).cast("double").alias(v) for v in values]).withColumn("p", F.explode(_with_border("y", rows))).withColumn("q", F.explode(_with_border("x", cols)))
    corner = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    out = out.select(*by, *[(F.col("p.w") * F.col("q.w") * F.col(v)).alias(v) for v in values], "p.at", F.col("q.at").alias("to"), corner.alias("k"))
    out = out.select(*by, *values, (F.col("at") - F.col("k.a")).alias("r"), (F.col("to") - F.col("k.b")).alias("c"), (2 * F.col("k.a") + F.col("k.b")).alias("q"))
    four = lambda v: F.struct(*[F.sum(F.when(F.col("q") == q, F.col(v))).alias(n) for q, n in enumerate(CORNERS)])
    return out.groupBy(*by, "r", "c").agg(*[four(v).alias(v) for v in values])


def upsample_bilinear(df: DataFrame, f: int, value: str | list[str], rows: int, cols: int, reflectance: bool = False, azimuth: bool = False, block: int | None = 610) -> DataFrame:
    """Bilinear interpolation of images of rows x cols, of one value or several in one shuffle. Reflectances of 0 count as
    missing and are left out of the sum (weights are not renormalised); azimuths are turned about the first pixel of the
    block of `block` x `block` pixels that a pixel lies in, of the image if block is None, to +-180."""
    off = int(f / 2 + 0.5)
    values, by = [value] if isinstance(value, str) else value, place(df)[:-2]
    cells = bordered_cells(df, values, rows, cols)
    span = lambda k, n: F.explode(F.sequence(F.greatest(F.lit(0), F.col(k) * f - off), F.least(F.lit(n * f - 1), F.col(k) * f - off + f - 1)))
    inside = cells.where(f"r * {f} - {off} <= {rows * f - 1} and c * {f} - {off} <= {cols * f - 1} and r * {f} - {off} + {f - 1} >= 0 and c * {f} - {off} + {f - 1} >= 0")
    out = inside.withColumn("y", span("r", rows)).withColumn("x", span("c", cols))
    if azimuth and block is None:  # a row for each image
        ref = df.where("y = 0 and x = 0").select(*by, *[F.col(v).cast("double").alias(f"ref_{v}") for v in values])
        out = out.join(ref, by) if by else out.crossJoin(F.broadcast(ref))
    elif azimuth:  # a row for each block of an image
        ref = df.where(f"y % {block} = 0 and x % {block} = 0").select(*by, F.expr(f"cast(y div {block} as int)").alias("_by"), F.expr(f"cast(x div {block} as int)").alias("_bx"), *[F.col(v).cast("double").alias(f"ref_{v}") for v in values])
        out = out.withColumns({f"_b{k}": F.expr(f"cast({k} div {f * block} as int)") for k in "yx"}).join(ref, [*by, "_by", "_bx"])
    wy = (F.col("y") - F.col("r") * f + (f / 2 + 0.5)) / f
    wx = (F.col("x") - F.col("c") * f + (f / 2 + 0.5)) / f

    def mixed(v: str) -> Column:
        at = [F.col(f"{v}.{q}") for q in CORNERS]
        at = [about(q, F.col(f"ref_{v}")) for q in at] if azimuth else at
        terms = [(1 - wy) * (1 - wx) * at[0], (1 - wy) * wx * at[1], wy * (1 - wx) * at[2], wy * wx * at[3]]
        if reflectance:
            terms = [F.when(q == 0, 0.0).otherwise(F.coalesce(t, F.lit(0.0))) for q, t in zip(at, terms, strict=True)]
        result = sum(terms[1:], terms[0])
        return F.pmod(result + F.col(f"ref_{v}") + 540.0, F.lit(360.0)) - 180.0 if azimuth else result

    return out.select(*by, "y", "x", *[mixed(v).alias(v) for v in values])


def halo_tiles(df: DataFrame, tile: int, depth: int) -> DataFrame:
    """Each pixel with every tile that holds it within `depth` of its border: columns ty, tx, own."""
    near = lambda k: F.expr(f"sequence(cast(floor(({k} - {depth}) / {tile}) as int), cast(({k} + {depth}) div {tile} as int))")
    out = df.withColumn("ty", F.explode(near("y"))).withColumn("tx", F.explode(near("x"))).where("ty >= 0 and tx >= 0")
    return out.withColumn("own", F.expr(f"ty = y div {tile} and tx = x div {tile}"))


def resample_stack(fine: DataFrame, f: int) -> DataFrame:
    """Reflectance, master detector and flags at the coarse resolution, from one pass over the pixels: the three
    aggregates share one shuffle."""
    v = F.when(F.col("dn") != 0, F.col("dn"))
    mid = (f - 1) // 2
    return fine.groupBy(*block(f)).agg(
        F.coalesce(F.avg(v).cast("int"), F.lit(0)).alias("dn"),
        F.expr("cast(bround(avg(det)) as int)").alias("det"),
        F.max(F.when((F.col("y") % f == mid) & (F.col("x") % f == mid), F.col("fl"))).alias("fl"),
    )
