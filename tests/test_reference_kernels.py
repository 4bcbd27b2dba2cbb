"""The kernels on literal inputs, with the values published for them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hydrapix.functions import columns as C
from hydrapix.operators import granule, interpolate, masks, resample, switching


def image(spark, rows):
    return spark.createDataFrame([(y, x, float(v)) for y, r in enumerate(rows) for x, v in enumerate(r)], "y int, x int, v double")


def values(df, name="v"):
    return {(r["y"], r["x"]): r[name] for r in df.collect()}


def test_bilinear_upsampling_is_exact_at_source_centres(spark):
    out = values(resample.upsample_bilinear(image(spark, [[1, 2, 3], [2, 4, 8]]), 3, "v", 2, 3))
    assert len(out) == 6 * 9
    assert (out[1, 1], out[4, 4], out[4, 7]) == (1.0, 4.0, 8.0)


def test_mean_downsampling(spark):
    out = values(resample.downsample(image(spark, [[6 * y + x for x in range(6)] for y in range(6)]), "mean", 2, "v"))
    assert out[1, 2] == (16 + 17 + 22 + 23) / 4


def test_all_missing_block_is_zero(spark):
    out = values(resample.downsample(image(spark, [[0, 0, 5, 0], [0, 0, 0, 8]]), "mean", 2, "v", reflectance=True))
    assert out == {(0, 0): 0, (0, 1): 6}


def test_unknown_mode_is_refused(spark):
    with pytest.raises(NotImplementedError):
        resample.downsample(image(spark, [[1]]), "flagmedianand", 1, "v")


def test_tie_points_lie_on_the_plane(spark):
    grid = spark.createDataFrame([(r, c, 1.0 + r + 2.0 * c) for r in range(3) for c in range(3)], "r int, c int, v double")
    out = values(interpolate.tie_points(interpolate.pixel_grid(spark, 166, 166), grid, "v"))
    assert len(out) == 166 * 166
    assert out[10, 20] == pytest.approx(1 + (10 * 60 + 30) / 5000 + 2 * (20 * 60 + 30) / 5000)


#: Corner of detector 5's angle grids (fixed values).
ZENITH = [[3.27412, 2.97148], [3.17559, 2.87897], [3.0787, 2.78875], [2.98385, None], [2.8911, None]]
AZIMUTH = [[141.848, 146.264], [143.167, 147.864], [144.567, 149.568], [146.061, None], [147.652, None]]


def test_angles_of_a_detector(spark):
    cells = [(5, r, c, ZENITH[r][c] if c < 2 else None, AZIMUTH[r][c] if c < 2 else None) for r in range(5) for c in range(5)]
    grid = interpolate.fill_by_plane(spark.createDataFrame(cells, "det int, r int, c int, vz double, va double"))
    pixels = interpolate.pixel_grid(spark, 24, 24).withColumn("det", F.lit(5))
    out = values(interpolate.angles_by_detector(pixels, grid, "vz", res=600), "vz")
    assert out[1, 1] == pytest.approx(3.2021043, abs=0.001)
    assert values(interpolate.angles_by_detector(pixels, grid, "va", res=600, azimuth=True), "va")[1, 1] == pytest.approx(142.8894, abs=0.001)
    both = granule.viewing_angles(pixels.withColumnRenamed("det", "master_detfoo"), {"B2": grid}, 600).where("y = 1 and x = 1").first()
    assert (both["view_zenith_mean"], both["view_azimuth_B2"]) == (pytest.approx(3.2021043, abs=0.001), pytest.approx(142.8894, abs=0.001))


def test_azimuths_cross_north(spark):
    row = spark.range(1).select(C.around(C.about(F.lit(1.0), F.lit(359.0)), F.lit(359.0)).alias("a"), interpolate.mean_angle(F.lit(350.0), F.lit(10.0), azimuth=True).alias("m")).first()
    assert row["a"] == pytest.approx(1.0)
    assert row["m"] == pytest.approx(0.0)


def test_transition_weights(spark):
    got = [r[0] for r in spark.range(33).select(C.transition_weight(F.col("id"))).orderBy("id").collect()]
    for d, w in {0: 0, 1: 0.007001, 2: 0.015212, 8: 0.110406, 16: 0.473147, 24: 0.868534, 31: 0.991789, 32: 1}.items():
        assert got[d] == pytest.approx(w, abs=1e-6)


def test_projection_round_trip(spark):
    pts = spark.createDataFrame([(48.1, 8.2), (53.7, 11.3), (60.0, 9.0)], "lat double, lon double")
    utm = C.to_utm(pts, F.col("lat"), F.col("lon"), 32)
    back = C.to_geographic(utm.select(F.col("lat").alias("la"), F.col("lon").alias("lo"), "easting", "northing"), F.col("easting"), F.col("northing"), 32)
    for r in back.select("la", "lo", "lat", "lon").collect():
        assert r[2] == pytest.approx(r[0], abs=1e-8)
        assert r[3] == pytest.approx(r[1], abs=1e-8)


def test_dilation_does_not_depend_on_the_tiling(spark, monkeypatch):
    import random

    r = random.Random(4)
    cells = [(y, x, r.choice([64, 96, 96, 96, 192])) for y in range(40) for x in range(45)]
    grid = spark.createDataFrame(cells, "y long, x long, code int")
    one = masks.dilate(grid, (64, 64), 96, 160, 6).collect()
    monkeypatch.setattr(masks, "TILE", 11)
    many = masks.dilate(grid, (64, 64), 96, 160, 6).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_dilation_counts_inserted_values_as_sources(spark):
    grid = spark.createDataFrame([(0, x, c) for x, c in enumerate([64, 96, 96, 96, 96, 160])], "y long, x long, code int")
    assert [r["code"] for r in masks.dilate(grid, (64, 64), 96, 160, 1).orderBy("x").collect()] == [64, 160, 96, 96, 160, 160]
    assert [r["code"] for r in masks.dilate(grid, (64, 64), 96, 160, 1, insert_grows=False).orderBy("x").collect()] == [64, 160, 96, 96, 96, 160]


def test_later_class_rules_overrule_earlier_ones(spark):
    base = {"s2wmask": 64, "pcf": 0, "c2f": 0, "q": 0, "b2": 1000, "b4": 1000, "b11": 2500, "a0": 0.0, "a1": 0.0, "a2": 0.0, "a3": 0.0, "a8": 0.0}
    cases = [({}, 2), ({"pcf": 131072}, 1), ({"s2wmask": 159}, 3), ({"s2wmask": 128}, 6), ({"pcf": 64}, 4), ({"pcf": 64 | 8}, 8), ({"pcf": 8 | 1}, 0), ({"q": 4}, 0), ({"c2f": 8}, 8), ({"c2f": 8, "b11": 1000}, 2), ({"pcf": 4}, 7), ({"pcf": 12}, 8)]
    df = spark.createDataFrame([tuple((base | c).values()) for c, _ in cases], ", ".join(f"{k} {'double' if k[0] == 'a' else 'int'}" for k in base))
    got = [r[0] for r in df.select(switching.pixel_class(df)).collect()]
    assert got == [want for _, want in cases]


def test_dilation_until_stable(spark, monkeypatch):
    """A way over several tiles."""
    way = [(0, x) for x in range(30)] + [(1, 29), (2, 29)] + [(2, x) for x in range(29)]
    grid = spark.createDataFrame([(y, x, 64 if (y, x) == (0, 0) else 96 if (y, x) in way else 192) for y in range(4) for x in range(31)], "y long, x long, code int")
    whole = masks.map_blocks
    monkeypatch.setattr(masks, "map_blocks", lambda *a, **k: whole(*a, **k, tile=8))
    got = masks.dilate(grid, (64, 64), 96, 160, 0)
    assert got.where("code = 160").count() == len(way) - 1 and got.where("code = 96").count() == 0
    none = masks.dilate(grid, (7, 7), 96, 160, 0, insert_grows=False)
    assert none.where("code = 96").count() == len(way) - 1


def test_halo_wider_than_a_tile(spark):
    one = spark.createDataFrame([(9, 9)], "y int, x int")
    got = {(r["ty"], r["tx"]) for r in resample.halo_tiles(one, 2, 5).collect()}
    assert got == {(a, b) for a in range(2, 8) for b in range(2, 8)}


@pytest.mark.parametrize("sensor", ["S2A", "S2B", "S2C"])
def test_bands_of_every_sensor(spark, sensor):
    names = switching.SENSOR_BANDS[sensor]
    df = spark.createDataFrame([tuple(float(i) for i in range(11))], ", ".join(f"{n} double" for n in names))
    assert list(switching.resolve_sensor_bands(df).first()) == [float(i) for i in range(11)]


def test_unknown_sensor_is_refused(spark):
    with pytest.raises(ValueError, match="no sensor"):
        switching.resolve_sensor_bands(spark.createDataFrame([(1.0,)], "rhos_999 double"))


def test_named_masks_are_all_there():
    assert len(granule.mask_expressions()) == 12 + 13 * 8 + 3 and len(granule.mask_expressions(detector_filter=False)) == 13 * 12 + 13 * 8 + 3
    assert granule.mask_expressions(merge_flags=False)["msi_lost_B8A"] == "B_msi_lost_B8A <> 0"


def test_missing_sensor_band_is_null(spark):
    df = spark.createDataFrame([(1, 0.5)], "pid int, rhos_442 double")
    row = switching.resolve_sensor_bands(df).first()
    assert row["a0"] == 0.5 and row["a5"] is None
