"""Column functions: flag algebra, packed values, angles, map projection. All stay inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of pixel_classif_flags by name (fixed values).
CLASSIF_BITS = {
    "INVALID": 0, "CLOUD": 1, "CLOUD_AMBIGUOUS": 2, "CLOUD_SURE": 3, "CLOUD_BUFFER": 4, "CLOUD_SHADOW": 5, "SNOW_ICE": 6, "BRIGHT": 7, "WHITE": 8,
    "COASTLINE": 9, "LAND": 10, "CIRRUS_SURE": 11, "CIRRUS_AMBIGUOUS": 12, "CLEAR_LAND": 13, "CLEAR_WATER": 14, "WATER": 15, "BRIGHTWHITE": 16,
    "VEG_RISK": 17, "MOUNTAIN_SHADOW": 18, "POTENTIAL_SHADOW": 19, "CLUSTERED_CLOUD_SHADOW": 20,
}
#: Names of pixel_class values (fixed values).
PIXEL_CLASSES = [
    "NO_DATA", "CLEAR_LAND_OR_VEGETATION", "CLEAR_OCEAN_WATER", "CLEAR_INLAND_WATER", "SNOW_ICE", "CIRRUS", "CLOUD_OR_MOUNTAIN_SHADOW", "AMBIGUOUS_CLOUD", "CLOUD", "AC_OUT_OF_BOUNDS",
]


def bits(*names: str) -> int:
    return sum(1 << CLASSIF_BITS[n] for n in names)


def has_bits(flags: Column, mask: int) -> Column:
    """True if any bit of the mask is set; false for null flags."""
    return F.coalesce(flags.bitwiseAND(F.lit(mask)) != 0, F.lit(False))


def pack_flags(*layers: Column) -> Column:
    """Layer i (0 or 1) becomes bit i."""
    return sum((layer.cast("int") * (1 << i) for i, layer in enumerate(layers)), F.lit(0))


def decode_scaled(dn: Column, scale: float, offset: float, fill: int | None = 0) -> Column:
    """Physical value of a packed number; null where it is the fill value."""
    value = dn * F.lit(scale) + F.lit(offset)
    return value if fill is None else F.when(dn != fill, value)


def encode_scaled(value: Column, scale: float, offset: float, fill: int = 0) -> Column:
    """Packed number of a physical value, truncated toward zero; the fill value for null."""
    return F.coalesce(((value - F.lit(offset)) / F.lit(scale)).cast("int"), F.lit(fill))


def about(angle: Column, reference: Column) -> Column:
    """The angle's difference from a reference, from -180 up to 180 degrees."""
    return F.pmod(angle - reference + 540.0, F.lit(360.0)) - 180.0


def around(angle: Column, reference: Column) -> Column:
    """Undoes about(): 0 up to 360 degrees."""
    return F.pmod(angle + reference + 360.0, F.lit(360.0))


def transition_weight(distance: Column) -> Column:
    """Weight of the inland result at a distance of 0 to 32 pixels from the ocean: a tanh ramp bent to 0 and 1."""
    ramp = lambda d: math.tanh(4 * d / 33 - 2) / 2 * math.tanh(2) + 0.5
    table = [ramp(d) - (32 - d) / 32 * ramp(0) + d / 32 * (1 - ramp(32)) for d in range(33)]
    return F.element_at(F.array(*[F.lit(x) for x in table]), distance.cast("int") + 1)


# WGS84 and the transverse Mercator series (third flattening n, order 3: below a millimetre within a zone)
_A, _FLAT = 6378137.0, 1 / 298.257223563
_N = _FLAT / (2 - _FLAT)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_K0, _EAST = 0.9996, 500000.0
FORWARD = (_N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3, 13 / 48 * _N**2 - 3 / 5 * _N**3, 61 / 240 * _N**3)
INVERSE = (_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3, _N**2 / 48 + _N**3 / 15, 17 / 480 * _N**3)
LATITUDE = (2 * _N - 2 / 3 * _N**2 - 2 * _N**3, 7 / 3 * _N**2 - 8 / 5 * _N**3, 56 / 15 * _N**3)


def _harmonics(first: tuple[Column, Column], last: tuple[Column, Column], sign: int) -> tuple[Column, Column]:
    """sin and cos (sign -1) or sinh and cosh (sign 1) of the sum of two angles, from those of each."""
    (s, c), (t, d) = first, last
    return s * d + c * t, c * d + sign * s * t


def _series(df: DataFrame, coefficients: tuple[float, ...], sign: int) -> DataFrame:
    """Columns _xi and _eta with their Krueger series added (sign 1) or taken off (-1). The multiples of an angle come
    from its first one, so four transcendental functions serve all terms."""
    df = df.withColumns({"_s": F.sin(2 * F.col("_xi")), "_c": F.cos(2 * F.col("_xi")), "_sh": F.sinh(2 * F.col("_eta")), "_ch": F.cosh(2 * F.col("_eta"))})
    df = df.withColumns(dict(zip(("_s2", "_c2"), _harmonics((F.col("_s"), F.col("_c")), (F.col("_s"), F.col("_c")), -1), strict=True)) | dict(zip(("_sh2", "_ch2"), _harmonics((F.col("_sh"), F.col("_ch")), (F.col("_sh"), F.col("_ch")), 1), strict=True)))
    third = _harmonics((F.col("_s2"), F.col("_c2")), (F.col("_s"), F.col("_c")), -1) + _harmonics((F.col("_sh2"), F.col("_ch2")), (F.col("_sh"), F.col("_ch")), 1)
    terms = [(F.col("_s"), F.col("_c"), F.col("_sh"), F.col("_ch")), (F.col("_s2"), F.col("_c2"), F.col("_sh2"), F.col("_ch2")), third]
    xi, eta = F.col("_xi"), F.col("_eta")
    for k, (s, c, sh, ch) in zip(coefficients, terms, strict=True):
        xi, eta = xi + F.lit(sign * k) * s * ch, eta + F.lit(sign * k) * c * sh
    return df.withColumns({"_x": xi, "_e": eta})


def _computed(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The columns to keep and new ones behind a generator of one row, so that a filter on them is not pushed into, and
    computed again by, what they are made of."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _equator(north: bool | Column) -> Column:
    """The northing of the equator."""
    return F.when(north, 0.0).otherwise(10000000.0) if isinstance(north, Column) else F.lit(0.0 if north else 10000000.0)


def to_geographic(df: DataFrame, x: Column, y: Column, zone: int | Column, north: bool | Column = True) -> DataFrame:
    """Adds lat and lon in degrees of a UTM easting and northing; zone and hemisphere may be columns."""
    keep = df.columns
    meridian = zone * 6 - 183.0 if isinstance(zone, Column) else F.lit(zone * 6 - 183.0)
    df = df.withColumns({"_m": meridian, "_xi": (y - _equator(north)) / F.lit(_K0 * _RADIUS), "_eta": (x - F.lit(_EAST)) / F.lit(_K0 * _RADIUS)})
    df = _series(df, INVERSE, -1).withColumn("_chi", F.asin(F.sin("_x") / F.cosh("_e")))
    df = df.withColumns({"_t": F.sin(2 * F.col("_chi")), "_u": F.cos(2 * F.col("_chi"))})
    t, u = F.col("_t"), F.col("_u")
    # sin 4 chi = 2 t u, sin 6 chi = t (4 u^2 - 1)
    lat = F.col("_chi") + t * (F.lit(LATITUDE[0]) + F.lit(2 * LATITUDE[1]) * u + F.lit(LATITUDE[2]) * (4 * u * u - 1))
    lon = F.col("_m") + F.degrees(F.atan2(F.sinh("_e"), F.cos("_x")))
    return _computed(df, keep, lat=F.degrees(lat), lon=lon)


def to_utm(df: DataFrame, lat: Column, lon: Column, zone: int | Column, north: bool | Column = True) -> DataFrame:
    """Adds easting and northing of a latitude and longitude in degrees; zone and hemisphere may be columns."""
    keep = df.columns
    e = 2 * math.sqrt(_N) / (1 + _N)
    df = df.withColumns({"_p": F.sin(F.radians(lat)), "_l": F.radians(lon - (zone * 6 - 183.0 if isinstance(zone, Column) else F.lit(zone * 6 - 183.0)))})
    df = df.withColumn("_q", _equator(north))
    df = df.withColumns({"_t": F.sinh(F.atanh("_p") - F.lit(e) * F.atanh(F.lit(e) * F.col("_p"))), "_k": F.cos("_l")})
    t, k = F.col("_t"), F.col("_k")
    df = df.withColumns({"_xi": F.atan2(t, k), "_eta": F.asinh(F.sin("_l") / F.sqrt(t * t + k * k))})
    df = _series(df, FORWARD, 1)
    return _computed(df, keep, easting=F.lit(_EAST) + F.lit(_K0 * _RADIUS) * F.col("_e"), northing=F.col("_q") + F.lit(_K0 * _RADIUS) * F.col("_x"))


def scaling(metadata: dict, floating: bool) -> tuple[float, float, float | None] | None:
    """(scale, offset, fill) of a band by its metadata: None for bands of real numbers and those without a scale or an
    offset. The fill value is the one under _FillValue."""
    if floating or not ({"scale_factor", "add_offset"} & metadata.keys()):
        return None
    return metadata.get("scale_factor", 1.0), metadata.get("add_offset", 0.0), metadata.get("_FillValue")


def decode_band(df: DataFrame, band: str) -> Column:
    """The band's physical values, by the metadata of its column; unchanged if that has no scaling."""
    field = df.schema[band]
    found = scaling(field.metadata, isinstance(field.dataType, (T.FloatType, T.DoubleType)))
    return decode_scaled(F.col(band), *found).alias(band) if found else F.col(band)
