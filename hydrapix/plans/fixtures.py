"""Pixel views over the test tables. The same expressions serve Spark and the SQL counterparts; only the sign of
integer division differs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PX = {
    "pid": "o_orderkey", "y": "o_orderkey {d} 150", "x": "o_orderkey % 150",
    "s2wmask": "CASE WHEN o_custkey % 16 = 0 THEN 192 WHEN o_custkey % 16 = 1 THEN 160 WHEN o_custkey % 16 = 2 THEN 159 WHEN o_custkey % 16 = 3 THEN 128 WHEN o_custkey % 16 = 4 THEN 96 WHEN o_custkey % 16 = 5 THEN 0 WHEN o_custkey % 16 IN (6, 7) THEN 65 + o_orderkey % 31 WHEN o_custkey % 16 IN (8, 9) THEN 161 + o_orderkey % 31 ELSE 64 END",
    "pcf": " + ".join(f"CASE WHEN o_orderkey % {m} = 0 THEN {v} ELSE 0 END" for m, v in ((3, 131072), (41, 1), (17, 2048), (53, 4096), (19, 4), (38, 8), (23, 64), (29, 32), (59, 262144), (31, 16), (13, 16384), (43, 8192))),
    "c2f": "CASE WHEN o_orderkey % 7 = 0 THEN 8 ELSE 0 END + CASE WHEN o_orderkey % 11 = 0 THEN 4 ELSE 0 END + CASE WHEN o_orderkey % 37 = 0 THEN 32768 ELSE 0 END + CASE WHEN o_orderkey % 21 = 0 THEN 1 ELSE 0 END",
    "q": "CASE WHEN o_orderkey % 47 = 0 THEN 2 ELSE 0 END + CASE WHEN o_orderkey % 5 = 0 THEN 128 ELSE 0 END",
    "b2": "1000 + (13 * o_orderkey) % 4000", "b4": "900 + (29 * o_orderkey) % 3500", "b11": "1000 + (17 * o_orderkey) % 2500",
    "watermask": "o_orderkey % 4",
}
AC = {
    "pid": "o_orderkey",
    **{f"c_b{n}": f"CAST(({m} * o_orderkey) % {w} - {o} AS DOUBLE) / CAST(10000 AS DOUBLE)" for n, m, w, o in (("1", 41, 450, 15), ("2", 47, 480, 15), ("3", 53, 500, 20), ("4", 71, 400, 10), ("5", 59, 300, 10), ("6", 61, 250, 10), ("7", 67, 220, 10), ("8a", 37, 200, 10))},
    **{f"a{i}": f"CASE WHEN o_orderkey % 43 = 0 THEN CAST(2000 AS DOUBLE) / CAST(10000 AS DOUBLE) ELSE CAST(({91 + i} * o_orderkey) % 700 - 15 AS DOUBLE) / CAST(10000 AS DOUBLE) END" for i in range(11)},
    **{f"p{i}": f"CASE WHEN o_orderkey % 13 <> 0 THEN CAST(({103 + i} * o_orderkey) % 600 AS DOUBLE) / CAST(10000 AS DOUBLE) END" for i in range(13)},
    "bm": "CASE WHEN o_orderkey % 10 = 0 THEN 8 ELSE 0 END + CASE WHEN o_orderkey % 25 = 0 THEN 1024 ELSE 0 END",
}
HI = {
    "y": "event_id {d} 60", "x": "event_id % 60",
    "dn": "CAST(CASE WHEN event_id % 11 = 0 OR ((event_id {d} 60) {d} 2 % 7 = 0 AND (event_id % 60) {d} 2 % 7 = 0) THEN 0 ELSE 100 + (event_id * 37 + user_id * 101) % 4000 END AS INT)",
    "det": "CAST(5 + ((event_id % 60 + (event_id {d} 60) {d} 2) {d} 20) % 8 AS INT)",
    "fl": "CAST(event_id % 8 AS INT)",
    "az": "CAST((3500 + event_id % 60 * 7 + (event_id {d} 60) * 3) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE)",
}
GRID = {
    "y": "o_orderkey {d} 150", "x": "o_orderkey % 150",
    "code": "CAST(CASE WHEN o_orderkey % 150 < 20 + (o_orderkey {d} 150) % 17 THEN 64 WHEN o_orderkey % 150 BETWEEN 60 AND 66 OR (o_orderkey {d} 150) % 100 BETWEEN 40 AND 44 THEN 96 ELSE 192 END AS INT)",
    "alt": "CAST(CASE WHEN o_custkey % 5 = 0 THEN 0 WHEN o_custkey % 5 = 1 THEN 1 WHEN o_custkey % 5 = 2 THEN 2 WHEN o_custkey % 5 = 3 THEN 3 ELSE 4 END AS INT)",
}
GEO = {
    "event_id": "event_id",
    "lon": "CAST(-1800 + (37 * user_id + event_id) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "lat": "CAST(800 - event_id % 1600 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "cls": "CAST(CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 4 = 0 THEN 80 ELSE 10 + event_id % 7 * 10 END AS INT)",
}
TP = {"r": "i {d} 23", "c": "i % 23", "zenith": "CAST(3000 + 5 * (i {d} 23) + 3 * (i % 23) AS DOUBLE) / CAST(100 AS DOUBLE)", "azimuth": "CAST((3500 + 9 * (i {d} 23) + 4 * (i % 23)) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE)"}
TPD = {
    "det": "5 + i {d} 529", "r": "(i % 529) {d} 23", "c": "i % 23",
    "vz": "CASE WHEN abs(i % 23 - 2 * (i {d} 529)) <= 2 THEN CAST(200 + 10 * (i {d} 529) + 3 * ((i % 529) {d} 23) + 5 * (i % 23) AS DOUBLE) / CAST(100 AS DOUBLE) END",
    "va": "CASE WHEN abs(i % 23 - 2 * (i {d} 529)) <= 2 THEN CAST((3400 + 60 * (i {d} 529) + 2 * ((i % 529) {d} 23) + 7 * (i % 23)) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE) END",
}
ANC = {"i": "k {d} 9", "j": "k % 9", "lat": "CAST(540 - k {d} 9 AS DOUBLE) / CAST(10 AS DOUBLE)", "lon": "CAST(900 + 15 * (k % 9) AS DOUBLE) / CAST(100 AS DOUBLE)", "value": "CAST(10 + k {d} 9 + 2 * (k % 9) AS DOUBLE)"}

#: Detector grids of many granules: each 4232 events are the eight detectors of one, numbered on.
TPE = {
    "det": "5 + event_id % 4232 {d} 529 + 16 * (event_id {d} 4232)", "r": "event_id % 4232 % 529 {d} 23", "c": "event_id % 4232 % 529 % 23",
    "vz": "CASE WHEN abs(event_id % 4232 % 529 % 23 - 2 * (event_id % 4232 {d} 529)) <= 2 THEN CAST(200 + user_id % 5 + 10 * (event_id % 4232 {d} 529) + 3 * (event_id % 4232 % 529 {d} 23) + 5 * (event_id % 4232 % 529 % 23) AS DOUBLE) / CAST(100 AS DOUBLE) END",
    "va": "CASE WHEN abs(event_id % 4232 % 529 % 23 - 2 * (event_id % 4232 {d} 529)) <= 2 THEN CAST((3400 + user_id % 5 + 60 * (event_id % 4232 {d} 529) + 2 * (event_id % 4232 % 529 {d} 23) + 7 * (event_id % 4232 % 529 % 23)) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE) END",
}
#: Viewing angle grids of thirteen bands (rows of nation up to the twelfth), each of its own, the azimuths about north.
TPB = {
    "band": "n_nationkey", "det": "5 + i {d} 529", "r": "(i % 529) {d} 23", "c": "i % 23",
    "vz": "CASE WHEN abs(i % 23 - 2 * (i {d} 529)) <= 2 THEN CAST(200 + 11 * n_nationkey + 10 * (i {d} 529) + 3 * ((i % 529) {d} 23) + 5 * (i % 23) AS DOUBLE) / CAST(100 AS DOUBLE) END",
    "va": "CASE WHEN abs(i % 23 - 2 * (i {d} 529)) <= 2 THEN CAST((3400 + 17 * n_nationkey + 60 * (i {d} 529) + 2 * ((i % 529) {d} 23) + 7 * (i % 23)) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE) END",
}
#: Ancillary grids of many granules, 81 events each.
ANE = {
    "granule": "event_id {d} 81", "i": "event_id % 81 {d} 9", "j": "event_id % 81 % 9", "lat": "CAST(540 - event_id % 81 {d} 9 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "lon": "CAST(900 + 15 * (event_id % 81 % 9) AS DOUBLE) / CAST(100 AS DOUBLE)", "value": "CAST(10 + user_id % 3 + event_id % 81 {d} 9 + 2 * (event_id % 81 % 9) AS DOUBLE)",
}
_TWO = lambda v: f"lpad(CAST({v} AS STRING), 2, '0')"
_STAMP = f"CAST(2015 + o_orderkey % 10 AS STRING) || {_TWO('1 + o_orderkey % 12')} || {_TWO('1 + o_custkey % 28')} || 'T' || {_TWO('o_orderkey % 24')} || {_TWO('o_custkey % 60')} || {_TWO('o_orderkey % 60')}"
#: A scene for each order, its geographic transform, a tile's name.
SCN = {
    "pid": "o_orderkey",
    "name": f"'S2' || substr('ABC', CAST(o_orderkey % 3 AS INT) + 1, 1) || '_MSIL1C_' || {_STAMP} || '_N05' || {_TWO('o_custkey % 12')} || '_R' || lpad(CAST(o_orderkey % 143 AS STRING), 3, '0') || '_T' || {_TWO('1 + o_custkey % 60')} || 'UME_' || {_STAMP}",
    "ending": "CASE WHEN o_orderkey % 2 = 0 THEN '.zip' ELSE '.SAFE' END",
    "left_edge": "CAST(300000 + 60 * (o_orderkey % 1830) AS STRING)", "top_edge": "CAST(5900040 - 60 * (o_custkey % 1830) AS STRING)",
    "corner": f"CASE WHEN o_orderkey % 2 = 0 THEN 'N' ELSE 'S' END || {_TWO('o_orderkey * 3 % 81')} || CASE WHEN o_custkey % 2 = 0 THEN 'E' ELSE 'W' END || lpad(CAST(o_orderkey * 7 % 180 AS STRING), 3, '0')",
}
#: Three granules from one image: pixel k of it belongs to granule k % 3.
HI3 = {"granule": "(y * 60 + x) % 3", "y": "(y * 60 + x) {d} 3 {d} 60", "x": "(y * 60 + x) {d} 3 % 60", "dn": "dn", "det": "det", "fl": "fl"}
#: Extents of granules, some across the antimeridian.
BOX = {
    "granule": "s_suppkey", "lat_min": "CAST((s_suppkey * 37) % 130 - 66 AS DOUBLE)", "lat_max": "CAST((s_suppkey * 37) % 130 - 57 + s_suppkey % 7 AS DOUBLE)",
    "lon_min": "CAST((s_suppkey * 53 + 150) % 360 - 180 AS DOUBLE)", "lon_max": "CAST((s_suppkey * 53 + 171 + s_suppkey % 11) % 360 - 180 AS DOUBLE)",
}


def _spark(exprs: dict) -> list[str]:
    return [f"{e.replace('{d}', 'div')} AS {n}" for n, e in exprs.items()]


def _sql(exprs: dict, source: str, where: str = "") -> str:
    return "SELECT " + ", ".join(f"{e.replace('{d}', '//')} AS {n}" for n, e in exprs.items()) + f" FROM {source}" + (f" WHERE {where}" if where else "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def px(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(*_spark(PX))


def ac(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(*_spark(AC))


def stack(spark: SparkSession, d: str) -> DataFrame:
    """Pixels with all correction results: the join on the pixel's key."""
    return px(spark, d).join(ac(spark, d), "pid")


def hi(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id").selectExpr(*_spark(HI))


def image(spark: SparkSession, d: str, value: str) -> tuple[DataFrame, int]:
    """The pixels (y, x, value) and the number of rows; what the last row lacks is 0."""
    px = hi(spark, d).select("y", "x", F.col(value).cast("double").alias(value))
    last = px.agg(F.max(F.struct("y", "x")).alias("m")).select("m.*").first()
    if last["y"] is None:
        return px, 0
    gap = spark.range(last["x"] + 1, 60).selectExpr(f"{last['y']}L as y", "id as x", f"0D as {value}")
    return px.unionByName(gap), last["y"] + 1


def grid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(*_spark(GRID))


def geo(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr(*_spark(GEO))


def tp(spark: SparkSession) -> DataFrame:
    return spark.range(529).withColumnRenamed("id", "i").selectExpr(*_spark(TP))


def tpd(spark: SparkSession) -> DataFrame:
    return spark.range(8 * 529).withColumnRenamed("id", "i").selectExpr(*_spark(TPD))


def tpe(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id").selectExpr(*_spark(TPE))


def tpb(spark: SparkSession, d: str) -> DataFrame:
    bands = table(spark, d, "nation").where("n_nationkey < 13").select("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(4231))).alias("i"))
    return bands.selectExpr(*_spark(TPB))


def ane(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id").selectExpr(*_spark(ANE))


def scenes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").selectExpr(*_spark(SCN))


def hi3(spark: SparkSession, d: str) -> DataFrame:
    return hi(spark, d).selectExpr(*_spark(HI3))


def boxes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey").selectExpr(*_spark(BOX))


def anc(spark: SparkSession) -> DataFrame:
    return spark.range(81).withColumnRenamed("id", "k").selectExpr(*_spark(ANC))


VIEWS = {
    "px": _sql(PX, "orders"),
    "ac": _sql(AC, "orders"),
    "hi": _sql(HI, "events"),
    "grid": _sql(GRID, "orders"),
    "geo": _sql(GEO, "events"),
    "tp": _sql(TP, "range(529) t(i)"),
    "tpd": _sql(TPD, "range(4232) t(i)"),
    "anc": _sql(ANC, "range(81) t(k)"),
    "tpe": _sql(TPE, "events"),
    "tpb": _sql(TPB, "nation, range(4232) t(i)", "n_nationkey < 13"),
    "ane": _sql(ANE, "events"),
    "scn": _sql(SCN, "orders"),
    "hi3": _sql(HI3, "hi"),
    "box": _sql(BOX, "supplier"),
}


def sql(body: str, *views: str, recursive: bool = False) -> str:
    """SQL over some of the views (name=view for one under another name); body may go on with further common tables after a
    comma."""
    head = ", ".join(f"{v.split('=')[0]} AS ({VIEWS[v.split('=')[-1]]})" for v in views)
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}{body if body.lstrip().startswith(',') else ' ' + body}"
