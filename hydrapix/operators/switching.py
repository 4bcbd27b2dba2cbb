"""Per-pixel classification, choice between atmospheric-correction results, blending, flags, statistics.

Missing values are NULL, so a comparison with one is not taken, as with NaN in arrays. Each operator is one
select or one aggregate without a shuffle of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bits, has_bits, transition_weight

#: Output wavelengths, and the positions among them that each correction supplies (fixed values).
WAVELENGTHS = [443, 490, 560, 665, 705, 740, 783, 842, 865, 945, 1375, 1610, 2190]
C2RCC_AT = {0: "c_b1", 1: "c_b2", 2: "c_b3", 3: "c_b4", 4: "c_b5", 5: "c_b6", 6: "c_b7", 8: "c_b8a"}
ACOLITE_OBSERVED = {**{i: f"a{i}" for i in range(9)}, 10: "a10"}
ACOLITE_INTENDED = {**{i: f"a{i}" for i in range(9)}, 11: "a9", 12: "a10"}
LOW, HIGH, LIMIT = 10.0, 20.0, 0.0005 * math.pi


def tecqua(quality: list[Column]) -> Column:
    """True if any band has one of its four lowest quality bits set."""
    out = F.lit(False)
    for q in quality:
        out = out | has_bits(q, 15)
    return out


def quality_columns(df: DataFrame) -> list[Column]:
    """The packed quality flags that df has: q, or q_<band> of each band."""
    return [df[c] for c in df.columns if c == "q" or c.startswith("q_B")]


def processed_mask(flags: Column) -> Column:
    """1 where the correction for all waters is not to be run: invalid, cloud, shadow, snow, land, cirrus, dry risk."""
    names = ("INVALID", "CLOUD", "CLOUD_AMBIGUOUS", "CLOUD_SURE", "CLOUD_BUFFER", "CLOUD_SHADOW", "SNOW_ICE", "LAND", "CIRRUS_SURE", "CIRRUS_AMBIGUOUS", "VEG_RISK")
    return has_bits(flags, bits(*names)).cast("int")


def all_valid(df: DataFrame, names: list[str]) -> DataFrame:
    """The rows in which each of the bands has a value of 0 or more."""
    good = F.lit(True)
    for n in names:
        good = good & F.coalesce(df[n] >= 0, F.lit(False))
    return df.where(good)


def visible_stats(*bands: Column) -> tuple[Column, Column]:
    """Mean and largest of the bands that are not null."""
    n = sum((b.isNotNull().cast("int") for b in bands), F.lit(0))
    return F.when(n > 0, sum((F.coalesce(b, F.lit(0.0)) for b in bands), F.lit(0.0)) / n), F.greatest(*bands)


def pixel_class(df: DataFrame, scale: float = 1e-4, offset: float = -0.1, wrap_uint16: bool = False) -> Column:
    """Class of a pixel. Rules that come later overrule earlier ones, so the chain tests them in reverse."""
    f, m, a443, a865 = df["pcf"], df["s2wmask"], df["a0"], df["a8"]
    dry = has_bits(f, bits("VEG_RISK"))
    swir = df["b11"] * F.lit(scale) + F.lit(offset)
    mean, most = visible_stats(df["a0"], df["a1"], df["a2"], df["a3"])
    glint = (mean > 0.04 * math.pi) & (most > 0.05 * math.pi) & (swir < 0.12)
    bright = (a443 > 0.025 * math.pi) & (a865 > 0.015 * math.pi) & (a443 > a865) & (swir < 0.12)
    inland = m.between(65, 96)
    first = (
        F.when(has_bits(f, bits("CLOUD_SURE", "CLOUD_BUFFER")), 8)
        .when(has_bits(f, bits("MOUNTAIN_SHADOW", "CLOUD_SHADOW")), 6)
        .when(bright | glint | has_bits(f, bits("SNOW_ICE")), 4)
        .when(has_bits(f, bits("CLOUD_AMBIGUOUS")) & ~has_bits(f, bits("CLOUD_SURE")), 7)
        .when(has_bits(f, bits("CIRRUS_SURE", "CIRRUS_AMBIGUOUS")), 5)
        .when(((m == 64) | inland) & dry, 1)
        .when(((m > 160) | (m == 159)) & ~dry, 3)
        .when((m == 160) & ~dry, 2)
        .when(m == 128, 6)
        .when(inland, 3)
        .when(m == 64, 2)
        .when(m >= 159, 1)
        .otherwise(0)
    )
    difference = F.pmod(df["b2"] - df["b4"], F.lit(65536)) if wrap_uint16 else df["b2"] - df["b4"]
    index = F.try_divide(difference.cast("double"), (df["b2"] + df["b4"]).cast("double"))
    cloudy = has_bits(df["c2f"], 8) & ((index > 0.2) | (swir > 0.04) | has_bits(f, bits("CIRRUS_AMBIGUOUS")))
    final = F.when((first == 2) & F.coalesce(cloudy, F.lit(False)), 8).otherwise(first)
    return F.when(tecqua(quality_columns(df)) | has_bits(f, bits("INVALID")), 0).otherwise(final)


def classify(df: DataFrame, **options) -> DataFrame:
    return df.withColumn("pixel_class", pixel_class(df, **options))


def _positive(c: Column) -> Column:
    return F.when(c > 0, c)


def coastal_switch(df: DataFrame, acolite_index: str = "reference") -> DataFrame:
    """Adds rw_0 ... rw_12, walgo and flags: the choice between two corrections by their band ratio.

    acolite_index="reference" takes ACOLITE's bands by output position, as observed (position 10 holds the band at
    2202 nm, 11 and 12 nothing); "intended" takes them by wavelength."""
    second = ACOLITE_OBSERVED if acolite_index == "reference" else ACOLITE_INTENDED
    none = F.lit(None).cast("double")
    b3, b4 = df["c_b3"], df["c_b4"]
    ref = _positive(df["c_b8a"])
    # the second ratio of a zero denominator is an infinity of the numerator's sign
    above = F.when(b3 == 0, b4 > 0).otherwise(F.try_divide(b4, b3) > 1.1)
    below = F.when(b3 == 0, b4 < 0).otherwise(F.try_divide(b4, b3) < 1.1)
    # shared terms become columns of their own, so that no band repeats their code
    out = df.withColumns({"_ref": ref, "_ratio": _positive(b3 / ref), "_above": above, "_below": below})
    ref, ratio = out["_ref"], out["_ratio"]
    branch = (
        F.when(~out["pixel_class"].isin(2, 3), 0)
        .when((ratio <= LOW) & (ref >= LIMIT), 3)
        .when((ratio <= LOW) & out["_above"], 4)
        .when((ratio > LOW) & (ratio < HIGH) & (ref >= LIMIT), 2)
        .when(ratio >= HIGH, 1)
        .when((ref < LIMIT) & out["_below"], 1)
        .otherwise(0)
    )
    f1, f2 = F.log(ratio / LOW) / math.log(HIGH / LOW), F.log(F.lit(HIGH) / ratio) / math.log(HIGH / LOW)
    negative = F.lit(False)
    for i in range(9):
        negative = negative | F.coalesce(df[second[i]] <= 0, F.lit(False))
    out = out.withColumns({"_branch": branch, "_f1": f1, "_f2": f2, "_negative": negative})
    bands = {}
    for i in range(13):
        one = _positive(out[C2RCC_AT[i]]) if i in C2RCC_AT else none
        two = _positive(out[second[i]]) if i in second else none
        both = two * out["_f2"] + one * out["_f1"]
        bands[f"rw_{i}"] = F.when(out["_branch"] >= 3, two).when(out["_branch"] == 2, both).when(out["_branch"] == 1, one)
    # a blend without a value at 865 nm counts as no algorithm
    lost = (out["_branch"] == 2) & (_positive(out[second[8]]).isNull() | _positive(out["c_b8a"]).isNull())
    out = out.withColumns({**bands, "walgo": F.when(lost, 0).otherwise(out["_branch"])})
    w = out["walgo"]
    flags = (
        F.when(has_bits(out["c2f"], 32775) & w.isin(1, 2), 1).otherwise(0)
        + F.when(out["_negative"] & (w >= 2), 2).otherwise(0)
        + F.when(w.isin(1, 2), 8).otherwise(0)
        + F.when(w >= 2, 16).otherwise(0)
    )
    return out.withColumn("flags", flags).drop("_ref", "_ratio", "_above", "_below", "_branch", "_f1", "_f2", "_negative")


def inland_switch(df: DataFrame) -> DataFrame:
    """Puts POLYMER results into inland water and blends them with distance from the ocean in transition zones."""
    m = df["s2wmask"]
    zone = F.when(m.isin(96, 192, 159), 1).when(((m > 64) & (m < 96)) | ((m > 160) & (m < 192)), 2).otherwise(0)
    df = df.withColumns({"_zone": F.when(df["pixel_class"] == 3, zone).otherwise(0), "_s": transition_weight(F.when(m.between(65, 95), m - 64).when(m.between(161, 191), m - 160))})
    inland, mixed, s = df["_zone"] == 1, df["_zone"] == 2, df["_s"]
    out = {f"rw_{i}": F.when(inland, df[f"p{i}"]).when(mixed, s * df[f"p{i}"] + (1.0 - s) * df[f"rw_{i}"]).otherwise(df[f"rw_{i}"]) for i in range(13)}
    flags = F.when(inland, df["flags"].bitwiseOR(F.lit(32)).bitwiseAND(F.lit(255 - 27))).when(mixed, df["flags"].bitwiseOR(F.lit(32))).otherwise(df["flags"])
    flags = F.when(has_bits(flags, 32) & has_bits(df["bm"], 1023), flags.bitwiseOR(F.lit(4))).otherwise(flags)
    done = df.withColumns({**out, "flags": flags})
    done = done.drop("_zone", "_s")
    return done.withColumn("pixel_class", F.when((done["pixel_class"] > 0) & has_bits(done["flags"], 7), 9).otherwise(done["pixel_class"]))


def format_l2w(df: DataFrame, copy_inputs: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The product's layers; with copy_inputs also the corrections' own bands (_c, _a, _p); other columns to keep."""
    cols = [F.col(f"rw_{i}").alias(f"Rw{w}") for i, w in enumerate(WAVELENGTHS)]
    if copy_inputs:
        cols += [F.col(c).alias(f"Rw{WAVELENGTHS[i]}_c") for i, c in C2RCC_AT.items()]
        cols += [F.col(c).alias(f"Rw{WAVELENGTHS[i]}_a") for i, c in ACOLITE_INTENDED.items()]
        cols += [F.col(f"p{i}").alias(f"Rw{w}_p") for i, w in enumerate(WAVELENGTHS)]
    return df.select("pid", "y", "x", *cols, "pixel_class", F.col("flags").alias("water_flags"), F.col("pcf").alias("pixel_classif_flags"), *keep)


def l2w(stack: DataFrame, acolite_index: str = "reference", copy_inputs: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The whole chain: classify, switch at the coast, switch inland, format. One pass, no shuffle."""
    return stack.transform(classify).transform(coastal_switch, acolite_index).transform(inland_switch).transform(format_l2w, copy_inputs, keep)


def scene_statistics(df: DataFrame) -> DataFrame:
    """Thirteen counts of classes by mask zone in one aggregate."""
    c, m = F.col("pixel_class"), F.col("s2wmask")
    zones = {"ocean": m.isin(64, 128), "inland_water": (m > 64) & (m <= 96), "land": m >= 159}
    clear = {"ocean": 2, "inland_water": 3, "land": 1}
    counts = {f"stat_clear_{z}_count": c == k for z, k in clear.items()}
    counts |= {f"stat_snow_ice_{z}_count": (c == 4) & own for z, own in zones.items()}
    counts |= {f"stat_cloud_{z}_count": (c >= 5) & own for z, own in zones.items()}
    counts |= {f"stat_valid_{z}_count": (c == clear[z]) | ((c >= 4) & own) for z, own in zones.items()}
    counts["stat_valid_count"] = c > 0
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in counts.items()])


def mask_zone_counts(df: DataFrame) -> DataFrame:
    m = F.col("s2wmask")
    return df.agg(F.count_if(m >= 128).alias("land"), F.count_if(m.between(65, 127)).alias("inland"), F.count_if(m <= 64).alias("ocean"))


def legacy_class(df: DataFrame, rhos: list[str]) -> Column:
    """The older value-coded class: the first rule that holds, else 99."""
    f = df["pcf"]
    negative = F.lit(False)
    for r in rhos:
        negative = negative | F.coalesce(df[r] < 0, F.lit(False))
    return (
        F.when(has_bits(f, 1), 1)
        .when(has_bits(df["c2f"], 3) & negative & has_bits(df["bm"], 8 + 16 + 32 + 64 + 128 + 2048 + 4096), 9)
        .when(has_bits(f, 2048 + 4096), 5)
        .when(has_bits(f, 4) & ~has_bits(f, 8), 7)
        .when(has_bits(f, 2 + 8 + 16), 8)
        .when(has_bits(f, 32 + 262144), 6)
        .when(has_bits(f, 64), 4)
        .when(has_bits(f, 8192 + 131072), 1)
        .when(has_bits(f, 16384) & (df["watermask"] == 2), 2)
        .when(has_bits(f, 16384), 3)
        .otherwise(99)
    )


def legacy_masks(df: DataFrame, rhos: list[str], clear_water: int = 16348) -> Column:
    """The older sum of masks. 16348 is the value in use there; 16384 is the bit that was meant."""
    f, w = df["pcf"], df["watermask"]
    negative, good = F.lit(False), F.lit(True)
    for r in rhos:
        negative = negative | F.coalesce(df[r] < 0, F.lit(False))
        good = good & F.coalesce(df[r] >= 0, F.lit(False))
    bad = has_bits(df["bm"], 8 + 16 + 32 + 64 + 128 + 2048 + 4096)
    terms = [
        has_bits(df["c2f"], 3),
        negative,
        bad,
        has_bits(f, clear_water) & has_bits(w, 2) & ~has_bits(df["c2f"], 3),
        has_bits(f, clear_water) & has_bits(w, 2) & good,
        has_bits(f, clear_water) & has_bits(w, 1) & ~bad,
    ]
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(terms)), F.lit(0))


#: ACOLITE's band names by sensor (fixed values; the first one tells the sensor).
SENSOR_BANDS = {
    "S2A": ["rhos_443", "rhos_492", "rhos_560", "rhos_665", "rhos_704", "rhos_740", "rhos_783", "rhos_833", "rhos_865", "rhos_1614", "rhos_2202"],
    "S2B": ["rhos_442", "rhos_492", "rhos_559", "rhos_665", "rhos_704", "rhos_739", "rhos_780", "rhos_833", "rhos_864", "rhos_1610", "rhos_2186"],
    "S2C": ["rhos_444", "rhos_489", "rhos_561", "rhos_667", "rhos_707", "rhos_741", "rhos_785", "rhos_835", "rhos_866", "rhos_1612", "rhos_2191"],
}


def resolve_sensor_bands(df: DataFrame) -> DataFrame:
    """Names the bands a0 ... a10 whatever the sensor; a missing band is null throughout. A table without the first
    band of any sensor is an error."""
    found = next((names for names in SENSOR_BANDS.values() if names[0] in df.columns), None)
    if found is None:
        raise ValueError(f"no sensor has its first band here: {', '.join(n[0] for n in SENSOR_BANDS.values())}")
    others = [c for c in df.columns if not c.startswith("rhos_")]
    return df.select(*others, *[(F.col(n) if n in df.columns else F.lit(None).cast("double")).alias(f"a{i}") for i, n in enumerate(found)])
