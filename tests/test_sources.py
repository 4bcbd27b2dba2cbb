from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from hydrapix import pipeline
from hydrapix.functions import columns
from hydrapix.operators import granule, scenes
from hydrapix.plans import fixtures
from hydrapix.sources import granules, rasters
from hydrapix.streaming import tiles

XML = """<t xmlns:n1="psd-14"><Sun_Angles_Grid><Zenith><Values_List><VALUES>1 2</VALUES></Values_List></Zenith></Sun_Angles_Grid>
<Viewing_Incidence_Angles_Grids bandId="8" detectorId="5"><Azimuth><Values_List><VALUES>3 NaN</VALUES></Values_List></Azimuth></Viewing_Incidence_Angles_Grids></t>"""
WANT = [("sun_zenith", None, None, 0, 0, 1.0), ("sun_zenith", None, None, 0, 1, 2.0), ("view_azimuth", "B8A", 5, 0, 0, 3.0), ("view_azimuth", "B8A", 5, 0, 1, None)]


def test_angle_source(spark, tmp_path):
    spark.dataSource.register(rasters.GranuleSource)
    (tmp_path / "MTD_TL.xml").write_text(XML)
    got = spark.read.format("granule_angles").load(f"{tmp_path}/*.xml").drop("path").collect()
    assert [tuple(r) for r in got] == WANT
    got = rasters.read_angles(spark, str(tmp_path)).drop("path").collect()
    assert [tuple(r) for r in got] == WANT


def test_product_metadata(spark):
    xml = "<p x='psd-15'><QUANTIFICATION_VALUE>10000</QUANTIFICATION_VALUE><RADIO_ADD_OFFSET>-1000</RADIO_ADD_OFFSET></p>"
    row = spark.createDataFrame([(xml,)], "x string").select(rasters.radiometry(F.col("x")).alias("r"), rasters.product_version(F.col("x")).alias("v")).first()
    assert row["v"] == 15 and row["r"]["scale"] == 1e-4 and row["r"]["offsets"] == [pytest.approx(-0.1)]
    with pytest.raises(Exception, match="unknown product"):
        spark.createDataFrame([("<p/>",)], "x string").select(rasters.product_version(F.col("x"))).collect()


def test_product_files(spark, tmp_path):
    xml = """<n1:P xmlns:n1="https://psd-14/x"><PRODUCT_START_TIME>2023-09-29T10:38:21.024Z</PRODUCT_START_TIME><PRODUCT_STOP_TIME>2023-09-29T10:38:22.024Z</PRODUCT_STOP_TIME>
<SPACECRAFT_NAME>Sentinel-2A</SPACECRAFT_NAME><QUANTIFICATION_VALUE>10000</QUANTIFICATION_VALUE><RADIO_ADD_OFFSET>-1000</RADIO_ADD_OFFSET>
<Special_Values><SPECIAL_VALUE_TEXT>NODATA</SPECIAL_VALUE_TEXT><SPECIAL_VALUE_INDEX>7</SPECIAL_VALUE_INDEX></Special_Values>
<Special_Values><SPECIAL_VALUE_TEXT>SATURATED</SPECIAL_VALUE_TEXT><SPECIAL_VALUE_INDEX>65535</SPECIAL_VALUE_INDEX></Special_Values></n1:P>"""
    (tmp_path / "MTD_MSIL1C.xml").write_text(xml)
    got = rasters.read_products(spark, str(tmp_path)).select("product.*").first()
    assert (got["version"], got["fill"], got["spacecraft"], str(got["start"]), str(got["stop"])) == (14, 7, "Sentinel-2A", "2023-09-29 10:38:21", "2023-09-29 10:38:22")


def test_scaling_of_a_band(spark):
    df = spark.createDataFrame([(10, 1.5, 3), (0, 2.5, 4)], "a int, b double, c int")
    df = df.select(F.col("a").alias("a", metadata={"scale_factor": 0.5, "_FillValue": 0}), F.col("b").alias("b", metadata={"scale_factor": 0.5}), F.col("c").alias("c", metadata={"add_offset": 1.0}))
    got = [tuple(r) for r in df.select(*[columns.decode_band(df, n) for n in "abc"]).collect()]
    assert got == [(5.0, 1.5, 4.0), (None, 2.5, 5.0)]


def test_ancillary_metadata(spark):
    df = spark.createDataFrame([(1, 2.0)], "i int, tco3 double").select("i", F.col("tco3").alias("tco3", metadata={"GRIB_x": 1, "_FillValue": 0, "units": "kg"}))
    got = granule.select_ancillary(df, ["tco3"], 60).schema["tco3"].metadata
    assert got == {"units": "kg", "coordinates": "tp_lat tp_lon", "offset_y": 0.0, "offset_x": 0.0, "subsampling_y": 228.75, "subsampling_x": 228.75}


def test_attributes_and_counts(spark, tmp_path):
    name = "S2A_MSIL1C_20230929T103821_N0509_R008_T32UME_20230929T141112"
    a = spark.createDataFrame([(name,)], "name string").select(scenes.product_attributes(copy_inputs=True, contact="me").alias("a")).first()["a"]
    assert a["id"].startswith("S2A_MSIL2W_20230929T103821_N0509_R008_T32UME_") and len(a["tracking_id"]) == 36 and a["contact"] == "me"
    assert a["start_date"] == "2023-Sep-29 10:38:21.000000" and a["product_version"] == "05.09" and a["parameters"] == "--copyinputs"
    counts = spark.createDataFrame([(1, 2, 3)], "land long, inland long, ocean long")
    for p in ("a", "b"):
        rasters.append_counts(counts, str(tmp_path / "c"), p)
    assert sorted(x.value for x in spark.read.text(str(tmp_path / "c")).collect()) == ["a\t3\t2\t1", "b\t3\t2\t1"]


def test_window_reads_one_tile(spark):
    assert scenes.window_of((50.0, 60.0), (170.0, -170.0), 180, 360) == [(30, 40, 350, 360), (30, 40, 0, 10)]
    assert scenes.window_of((-1.5, 1.5), (0.0, 3.0), 180, 360) == [(88, 92, 180, 183)]


def test_whole_chain(spark, tmp_path):
    """Three images to 60 m, corrections joined, switched and written; the classes are those of the switching alone."""
    px = spark.range(36 * 36).selectExpr("cast(id div 36 as int) y", "cast(id % 36 as int) x")
    layers = lambda names: [f"cast(1000 + (y * 37 + x * 11 + {i}) % 900 as int) as {b}" for i, b in enumerate(names)] + [x for b in names for x in (f"5 as det_{b}", f"0 as q_{b}")]
    images = {10: px.selectExpr("y", "x", *layers(["B2", "B4"])), 20: px.where("y < 18 and x < 18").selectExpr("y", "x", *layers(["B11"])), 60: px.where("y < 6 and x < 6").selectExpr("y", "x", *layers(["B1"]), "0 as cloud_ice")}
    ac = fixtures.stack(spark, "/root/testdata/sf0.001").limit(36).drop("y", "x", "pid", "s2wmask", "b2", "b4", "b11", "q")
    rows = [tuple(r) for r in ac.collect()]
    ac = spark.createDataFrame([(i // 6, i % 6, *r) for i, r in enumerate(rows)], "y int, x int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ac.schema))
    grid = fixtures.tpd(spark)
    done = pipeline.process(images, (6, 6), [ac], str(tmp_path), "P", angles={"B2": grid, "B11": grid}, sun={"sun_zenith": fixtures.tp(spark).select("r", "c", F.col("zenith").alias("sun_zenith"))}, downsampling="detectormean")
    assert done.count() == 36 and spark.read.parquet(f"{tmp_path}/statistics").count() == 13
    assert done.where("s2wmask = 64").count() == 36 and done.select("pixel_class").distinct().count() > 1


def test_band_names(spark):
    df = spark.createDataFrame([("a/T32_B01.jp2",), ("a/T32_B8A.jp2",), ("a/x.xml",)], "p string")
    assert [r[0] for r in df.select(rasters.band_of(F.col("p"))).collect()] == ["B1", "B8A", None]


def test_polygons(spark, tmp_path):
    (tmp_path / "p.json").write_text('{\n"type": "FeatureCollection",\n{ "type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0,0],[3,0],[3,3]]]} },\n{ "type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[1,1],[2,2]]]]} }\n]}\n')
    got = rasters.read_polygons(spark, str(tmp_path / "p.json"))
    assert got.groupBy("ring").count().count() == 2 and got.count() == 5


def test_tiles_prune_and_overwrite(spark, tmp_path):
    path, px = str(tmp_path / "t"), spark.range(400).selectExpr("cast(id div 20 as int) y", "cast(id % 20 as int) x", "id v")
    rasters.write_tiles(px, path, 10)
    rasters.write_tiles(px.where("y < 10 and x < 10").withColumn("v", F.lit(-1).cast("long")), path, 10)
    back = spark.read.parquet(path)
    assert back.count() == 400 and back.where("v = -1").count() == 100
    win = rasters.read_window(spark, path, (3, 12), (0, 5), 10)
    assert win.count() == 60
    assert "tile_y" in win._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def test_region_stream(spark, tmp_path):
    schema, path = "y int, x int, v long", str(tmp_path / "out")
    spark.range(100).selectExpr("cast(id div 10 as int) y", "cast(id % 10 as int) x", "id v").write.parquet(str(tmp_path / "in"))
    tiles.keep_region_table(spark, str(tmp_path / "in"), schema, path, str(tmp_path / "c"), 5).awaitTermination()
    spark.range(25).selectExpr("cast(id div 5 as int) y", "cast(id % 5 as int) x", "-1L v").write.mode("append").parquet(str(tmp_path / "in"))
    tiles.keep_region_table(spark, str(tmp_path / "in"), schema, path, str(tmp_path / "c"), 5).awaitTermination()
    spark.catalog.clearCache()
    assert spark.read.parquet(path).count() == 100 and spark.read.parquet(path).where("v = -1").count() == 25


def test_product_chain(spark, tmp_path):
    done = pipeline.switch(fixtures.stack(spark, "/root/testdata/sf0.001"), str(tmp_path), "P", tile=50)
    assert done.count() == 1500
    stats = {r["name"]: r["value"] for r in spark.read.parquet(f"{tmp_path}/statistics").collect()}
    assert len(stats) == 13 and stats["stat_valid_count"] == done.where("pixel_class > 0").count()


def test_static_mask_falls_back_to_ocean(spark):
    px = spark.createDataFrame([(0, 0), (0, 1), (0, 2)], "y int, x int")
    m1 = spark.createDataFrame([(0, 0, 192)], "y int, x int, code int")
    m2 = spark.createDataFrame([(0, 0, 96), (0, 1, 96)], "y int, x int, code int")
    assert [r["s2wmask"] for r in pipeline.static_mask(m1, m2, px).orderBy("x").collect()] == [192, 96, 64]
    assert pipeline.static_mask(None, None, px).where("s2wmask = 64").count() == 3


def test_region_arrives_in_parts(spark, tmp_path):
    """Two batches for one tile keep both; absent tiles read as zeros, and nothing is stored for them."""
    path, shape = str(tmp_path / "r"), (10, 12)
    tiles_of = spark.createDataFrame([(y, x) for y in range(2) for x in range(3)], "tile_y int, tile_x int")
    read = lambda: {(r["y"], r["x"]): (r["v"], r["land"]) for r in rasters.read_region(spark, path, tiles_of, "v long, land boolean", 5, shape).collect()}
    assert len(read()) == 120 and set(read().values()) == {(0, False)}
    first = spark.createDataFrame([(0, 0, 5, True), (0, 1, 6, True), (9, 11, 7, True)], "y int, x int, v long, land boolean")
    rasters.write_region(first, path, 5, shape)
    rasters.write_region(spark.createDataFrame([(0, 1, 8, False), (4, 4, 9, True)], "y int, x int, v long, land boolean"), path, 5, shape)
    got = read()
    assert len(got) == 120 and {k: v for k, v in got.items() if v != (0, False)} == {(0, 0): (5, True), (0, 1): (8, False), (4, 4): (9, True), (9, 11): (7, True)}
    spark.catalog.clearCache()
    assert spark.read.parquet(path).count() == 25 + 5 * 2  # two tiles, one of them cut by the image's edge
    rasters.write_region(first, path, 5, shape)
    assert read()[0, 1] == (6, True) and read()[4, 4] == (9, True)


def test_appends_that_are_repeated(spark, tmp_path):
    stats = lambda n: spark.createDataFrame([(n, 2)], "a long, b int")
    for product, n in (("P", 1), ("Q", 5), ("P", 3), ("P", 3)):
        rasters.append_statistics(stats(n), str(tmp_path / "s"), product)
        rasters.append_counts(stats(n).selectExpr("a as ocean", "b as inland", "0 as land"), str(tmp_path / "c"), product)
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "s")).select("product", "name", "value").collect()) == [("P", "a", 3), ("P", "b", 2), ("Q", "a", 5), ("Q", "b", 2)]
    assert sorted(x.value for x in spark.read.text(str(tmp_path / "c")).collect()) == ["P\t3\t2\t0", "Q\t5\t2\t0"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_read_their_tiles_alone(spark, tmp_path):
    path = str(tmp_path / "g")
    rasters.write_tiles(spark.range(180 * 360).selectExpr("cast(id div 360 as int) y", "cast(id % 360 as int) x", "id % 7 as code"), path, 30)
    boxes = spark.createDataFrame([("a", 60.0, 62.0, 10.0, 15.0), ("b", -3.5, 2.5, 177.0, -176.0), ("c", 64.0, 70.0, 179.0, -178.0)], "granule string, lat_min double, lat_max double, lon_min double, lon_max double")
    mask = spark.read.parquet(path)
    out = scenes.subsets(mask, boxes, 180, 360, 30)
    assert "dynamicpruning" in plan_of(out)
    got = {}
    for r in out.collect():
        got.setdefault(r["granule"], []).append((r["y"], r["x"]))
    assert sorted(got["a"]) == [(y, x) for y in (28, 29) for x in range(190, 195, 2)]
    assert sorted(got["b"]) == sorted((y, x % 360) for y in range(87, 94) for x in range(357, 364))
    assert sorted(got["c"]) == sorted((y, x % 360) for y in range(20, 26) for x in range(359, 362, 2))
    for name, lat, lon in (("a", (60.0, 62.0), (10.0, 15.0)), ("b", (-3.5, 2.5), (177.0, -176.0)), ("c", (64.0, 70.0), (179.0, -178.0))):
        assert sorted((r["y"], r["x"]) for r in scenes.subset(mask, lat, lon, 180, 360).collect()) == sorted(got[name])


def test_windows_meet_columns_of_tiles_and_not_their_pixels(spark, tmp_path):
    path = str(tmp_path / "g")
    rasters.write_tiles(spark.range(180 * 360).selectExpr("cast(id div 360 as int) y", "cast(id % 360 as int) x", "id % 7 as code"), path, 30)
    boxes = spark.range(6).selectExpr("id as granule", "-60D + id % 7 as lat_min", "60D as lat_max", "170D as lon_min", "-170D + 9 * id as lon_max")
    out = scenes.subsets(spark.read.parquet(path), boxes, 180, 360, 30)
    rows = sum(scenes.subset(spark.read.parquet(path), (r["lat_min"], r["lat_max"]), (r["lon_min"], r["lon_max"]), 180, 360).count() for r in boxes.collect())
    plan = out._jdf.queryExecution().executedPlan()
    assert out.count() == rows == len(plan.executeCollect())
    nodes, joined = [plan.executedPlan()], []
    while nodes:
        node = nodes.pop()
        node = node.plan() if "QueryStage" in node.nodeName() else node
        nodes += [node.children().apply(k) for k in range(node.children().size())]
        if "Join" in node.nodeName() and "LeftSemi" not in node.toString().split("\n")[0]:
            joined.append(node.metrics().apply("numOutputRows").value())
    assert joined and max(joined) < rows / 5


def test_angle_files_lie_in_folders_of_one_task(spark):
    from hydrapix.plans import catalogue

    out = catalogue.QUERIES["angle_files"](spark, "/root/testdata/sf0.01")
    found = [re.search(r"/part=(\d+)/granule=(\d+)/(part-\d+)-", f) for f in out.inputFiles()]
    assert len(found) == out.select("granule").distinct().count() and all(found)
    assert all(int(m[1]) == int(m[2]) // 128 for m in found)
    assert len({m[1] for m in found}) == len({(m[1], m[3]) for m in found})


def test_windows_are_not_broadcast_with_a_row_for_each_tile(spark, tmp_path):
    path = str(tmp_path / "g")
    rasters.write_tiles(spark.range(400 * 20).selectExpr("cast(id div 20 as int) y", "cast(id % 20 as int) x", "id % 7 as code"), path, 10)
    mask = spark.read.parquet(path)
    lon = "cast(id * 37 % 340 - 170 as double) as lon_min", "cast((id * 37 + 30 + id % 90) % 340 - 170 as double) as lon_max"
    boxes = spark.range(200).selectExpr("id as granule", "-85D + id % 60 as lat_min", "-84D + id % 60 + id * 7 % 110 as lat_max", *lon)
    out = scenes.subsets(mask, boxes, 400, 20, 10)
    at = scenes.windows(boxes, 400, 20)
    met = mask.join(at, F.expr("y >= y0 and y < y1 and x >= x0 and x < x1 and (x - x0 + base) % step = 0"))
    tall = at.selectExpr("y1 - y0 as h", "step").agg(F.min("h"), F.max("h"), F.max("step")).first()
    assert tall[0] < 10 and tall[1] > 200 and tall[2] > 2  # windows of many heights, some of them thinned
    plan = out._jdf.queryExecution().executedPlan()
    assert len(plan.executeCollect()) == met.count() > 0
    assert sorted(out.collect()) == sorted(met.select("granule", "y", "x", "code").collect())
    nodes, sent = [plan.executedPlan()], []
    while nodes:
        node = nodes.pop()
        node = node.plan() if "QueryStage" in node.nodeName() else node
        nodes += [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName() == "BroadcastExchange":
            sent.append(node.metrics().apply("numOutputRows").value())
    assert sent and max(sent) <= 40 * 2  # keys of tiles, and not windows times the tiles under them


def test_stored_layers_meet_without_a_shuffle(spark, tmp_path):
    px = spark.range(3 * 400).selectExpr("id % 3 as granule", "cast(id div 3 div 20 as int) y", "cast(id div 3 % 20 as int) x", "id as v")
    layers = {"one": px, "two": px.withColumnRenamed("v", "w"), "three": px.withColumnRenamed("v", "u")}
    out = rasters.zipped(rasters.save_layers(layers, f"file://{tmp_path}/l", 7))
    assert "Exchange" not in plan_of(out) and "SortMergeJoin" in plan_of(out)
    assert out.where("v = w and w = u").count() == 1200
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def test_angles_of_all_bands_are_one_lookup(spark):
    px = fixtures.hi(spark, "/root/testdata/sf0.001").selectExpr("y", "x", "det as master_detfoo")
    names = F.array(*[F.lit(b) for b in granule.RESOLUTIONS])
    grids = fixtures.tpb(spark, "/root/testdata/sf0.001").withColumn("band", names[F.col("band").cast("int")])
    out = granule.viewing_angles(px, grids, 600)
    assert plan_of(out).count("Exchange ") <= 4 and plan_of(out).count("Join") == 1
    own = granule.viewing_angles(px.select("y", "x", *[F.col("master_detfoo").alias(f"det_{b}") for b in granule.RESOLUTIONS]), grids, 600, None)
    cols = ["y", "x", "view_zenith_B12", "view_azimuth_mean"]
    assert sorted(map(str, out.select(cols).collect())) == sorted(map(str, own.select(cols).collect()))


def test_polygons_with_holes_and_overlaps(spark):
    square = lambda p, ring, a, b: [(p, ring, n, y, x) for n, (y, x) in enumerate(((a, a), (a, b), (b, b), (b, a)))]
    rows = square(1, 0, 2.0, 12.0) + square(1, 1, 5.0, 9.0) + square(2, 0, 8.0, 14.0) + square(3, 0, 30.0, 30.4) + [(4, 0, 0, 20.0, 1.0), (4, 0, 1, 25.0, 6.0), (4, 0, 2, 25.0, 1.0)]
    df = spark.createDataFrame(rows, "polygon int, ring int, n int, y double, x double")
    got = sorted(map(tuple, scenes.rasterized(df, 4).collect()))
    inside = lambda y, x, a, b: a <= y < b and a <= x < b
    want = {(y, x) for y in range(20) for x in range(20) if (inside(y, x, 2, 12) and not inside(y, x, 5, 9)) or inside(y, x, 8, 14)}
    want |= {(y, x) for y in range(20, 25) for x in range(1, 6) if 1 <= x + 0.5 < 1 + (y + 0.5 - 20)}
    assert got == sorted(want) and scenes.rasterized(df.limit(0), 4).count() == 0


def test_features_are_written_to_their_tiles(spark, tmp_path):
    rings = spark.createDataFrame([("f", 0, 0, 1.0, 1.0), ("f", 0, 1, 8.0, 1.0), ("f", 1, 0, 1.0, 1.0), ("f", 1, 1, 1.5, 1.0), ("g", 0, 0, 7.0, 2.0), ("g", 0, 1, 7.5, 2.0)], "feature string, ring int, n int, lon double, lat double")
    at = scenes.feature_tiles(rings)
    assert sorted(map(tuple, at.collect())) == [(29, 60, "f"), (29, 61, "f"), (29, 62, "f"), (29, 62, "g")]
    features = spark.createDataFrame([("f", "a lake"), ("g", "an island")], "feature string, what string")
    for _ in range(2):
        scenes.write_feature_tiles(features, at, str(tmp_path / "t"))
    assert sorted((r["i"], r["what"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(60, "a lake"), (61, "a lake"), (62, "a lake"), (62, "an island")]


def product(folder, name, offset, bands=("B01", "B8A")):
    at = folder / f"{name}.SAFE"
    tile = at / "GRANULE" / "L1C_T"
    for sub in ("IMG_DATA", "QI_DATA", "AUX_DATA"):
        (tile / sub).mkdir(parents=True)
    (at / "MTD_MSIL1C.xml").write_text(f"""<n1:P xmlns:n1="https://psd-14/x"><PRODUCT_START_TIME>2023-09-29T10:38:21.024Z</PRODUCT_START_TIME><SPACECRAFT_NAME>Sentinel-2A</SPACECRAFT_NAME>
<QUANTIFICATION_VALUE>10000</QUANTIFICATION_VALUE>{f"<RADIO_ADD_OFFSET>{offset}</RADIO_ADD_OFFSET>" * 13}<S><SPECIAL_VALUE_TEXT>NODATA</SPECIAL_VALUE_TEXT><SPECIAL_VALUE_INDEX>0</SPECIAL_VALUE_INDEX></S></n1:P>""")
    (tile / "MTD_TL.xml").write_text(XML)
    for b in bands:
        for f in (f"IMG_DATA/T32UME_{b}.jp2", f"QI_DATA/MSK_DETFOO_{b}.jp2", f"QI_DATA/MSK_QUALIT_{b}.jp2"):
            (tile / f).write_bytes(b"")
    (tile / "QI_DATA/MSK_CLASSI_B00.jp2").write_bytes(b"")
    (tile / "AUX_DATA/AUX_ECMWFT").write_bytes(b"")


def test_granule_source(spark, tmp_path):
    """Two products; conditions decide which files are opened at all."""
    product(tmp_path, "one", -1000)
    product(tmp_path, "two", 0)
    (tmp_path / "two.SAFE/GRANULE/L1C_T/MTD_TL.xml").write_text("no xml")
    parts = granules.open_granules(spark, f"{tmp_path}/*.SAFE")
    with pytest.raises(Exception, match="(?s).*syntax error"):
        parts.collect()
    pruned = parts.where("part = 'angles' and product = 'one'")
    assert sorted((r["name"], r["band"], r["c"], r["value"]) for r in pruned.collect() if r["value"]) == [("sun_zenith", None, 0, 1.0), ("sun_zenith", None, 1, 2.0), ("view_azimuth", "B8A", 0, 3.0)]
    own = parts.where("product in ('one', 'two') and part = 'product' and name = 'add_offset' and band = 'B1'").collect()
    assert sorted((r["product"], r["value"]) for r in own) == [("one", pytest.approx(-0.1)), ("two", 0.0)]
    files = parts.where("part in ('image', 'detectors', 'quality', 'classes', 'auxiliary')")
    assert sorted((r["part"], r["band"], r["value"]) for r in files.where("product = 'two'").collect() if r["part"] in ("image", "classes")) == [("classes", None, 60.0), ("image", "B1", 60.0), ("image", "B8A", 20.0)]
    assert files.count() == 2 * (3 * 2 + 2) and files.where("band = 'B8A'").count() == 6
    assert files.where("band = 'B8A'").rdd.getNumPartitions() == 6 and pruned.rdd.getNumPartitions() == 1
    (tmp_path / "two.SAFE/GRANULE/L1C_T/MTD_TL.xml").write_text(XML)
    assert {(r["granule"], r["band"], r["det"], r["va"]) for r in granules.viewing_grids(parts).collect()} == {(p, "B8A", 5, v) for p in ("one", "two") for v in (3.0, None)}
    assert {(r["granule"], r["c"], r["sun_zenith"]) for r in granules.sun_grid(parts).collect()} == {(p, c, c + 1.0) for p in ("one", "two") for c in (0, 1)}


def test_unknown_product_version():
    with pytest.raises(ValueError, match="unknown product version"):
        list(granules.product_rows(b"<p/>"))
