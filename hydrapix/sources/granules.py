"""Products on disk as one table: every part of a granule's metadata and the files that hold its layers.

spark.read.format("granule_parts").load(pattern) has a row for each value of each part of the products that the pattern
matches. Conditions on product, part and band reach the source: files of other parts are not opened, and products or
bands that are not asked for are neither opened nor listed. There is a task for each file. The files have to lie where all
tasks see them; what is decoded from images and models comes as tables.
"""

from __future__ import annotations

import glob
import os
import xml.etree.ElementTree as ET
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ..operators.granule import RESOLUTIONS
from ..operators.resample import place
from .rasters import BAND_NAMES, BANDS, angle_rows

SCHEMA = "product string, part string, name string, band string, detector int, r int, c int, value double, text string"
#: Parts of a product and where its files lie below its folder (fixed values).
PARTS = {
    "product": "MTD_MSIL1C.xml",
    "image": "GRANULE/*/IMG_DATA/*_B??.jp2",
    "detectors": "GRANULE/*/QI_DATA/MSK_DETFOO_*.jp2",
    "quality": "GRANULE/*/QI_DATA/MSK_QUALIT_*.jp2",
    "classes": "GRANULE/*/QI_DATA/MSK_CLASSI_B00.jp2",
    "auxiliary": "GRANULE/*/AUX_DATA/AUX_??????",
    "angles": "GRANULE/*/MTD_TL.xml",
}


class File(InputPartition):
    def __init__(self, product: str, part: str, path: str, bands: tuple[str, ...] | None):
        self.product, self.part, self.path, self.bands = product, part, path, bands


def product_rows(xml: bytes) -> Iterator[tuple]:
    """(name, band, value, text) of a product's metadata: version, scale, add-offsets by band, fill value, times, spacecraft."""
    version = next((v for v in (14, 15) if f"psd-{v}".encode() in xml), None)
    if version is None:
        raise ValueError("unknown product version")
    root = ET.fromstring(xml)
    texts = lambda tag: [e.text for e in root.iter() if e.tag.rsplit("}")[-1] == tag]
    yield "version", None, float(version), None
    scale = 1.0 / int(texts("QUANTIFICATION_VALUE")[0])
    yield "scale", None, scale, None
    offsets = texts("RADIO_ADD_OFFSET") or ["0"] * len(BANDS)
    for band, offset in zip(BANDS, offsets, strict=False):
        yield "add_offset", band, int(offset) * scale, None
    for kind, index in zip(texts("SPECIAL_VALUE_TEXT"), texts("SPECIAL_VALUE_INDEX"), strict=True):
        if kind == "NODATA":
            yield "fill_value", None, float(index), None
    for name, tag in (("start", "PRODUCT_START_TIME"), ("stop", "PRODUCT_STOP_TIME"), ("spacecraft", "SPACECRAFT_NAME")):
        for text in texts(tag)[:1]:
            yield name, None, None, text


def band_in(path: str) -> str | None:
    code = os.path.basename(path).removesuffix(".jp2").rsplit("_", 1)[-1]
    return BAND_NAMES.get(code)


class PartsReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.wanted = path, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equalities on product, part and band; gives the others back."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute in (("product",), ("part",), ("band",)):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                key = f.attribute[0]
                self.wanted[key] = self.wanted[key] & own if key in self.wanted else own
            else:
                yield f

    def partitions(self) -> list[File]:
        has = lambda key, v: key not in self.wanted or v in self.wanted[key]
        bands = tuple(sorted(self.wanted["band"])) if "band" in self.wanted else None
        out = []
        for folder in sorted(glob.glob(self.path)):
            product = os.path.basename(folder.rstrip("/")).removesuffix(".SAFE")
            for part in PARTS if has("product", product) else ():
                if not has("part", part) or (bands is not None and part in ("classes", "auxiliary")):
                    continue
                for path in sorted(glob.glob(os.path.join(folder, PARTS[part]))):
                    if part in ("image", "detectors", "quality") and not (band_in(path) and has("band", band_in(path))):
                        continue
                    out.append(File(product, part, path, bands))
        return out

    def read(self, file: File) -> Iterator[tuple]:
        head = (file.product, file.part)
        own = lambda band: file.bands is None or band in file.bands
        if file.part in ("product", "angles"):
            with open(file.path, "rb") as f:
                content = f.read()
            if file.part == "product":
                yield from ((*head, name, band, None, None, None, value, text) for name, band, value, text in product_rows(content) if own(band))
            else:
                yield from ((*head, kind, band, det, r, c, v, None) for kind, band, det, r, c, v in angle_rows(content) if own(band))
        else:
            band = band_in(file.path) if file.part not in ("classes", "auxiliary") else None
            resolution = RESOLUTIONS.get(band, 60.0 if file.part == "classes" else None)
            yield (*head, os.path.basename(file.path), band, None, None, None, None if resolution is None else float(resolution), file.path)


class GranuleParts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "granule_parts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PartsReader(self.options["path"])


def open_granules(spark: SparkSession, pattern: str) -> DataFrame:
    """All parts of the products that the pattern matches, in a session of its own that lets conditions reach the source."""
    session = spark.newSession()
    session.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    session.dataSource.register(GranuleParts)
    return session.read.format("granule_parts").load(pattern)


def viewing_grids(parts: DataFrame) -> DataFrame:
    """(granule, band, det, r, c, vz, va): the viewing angle grids of all products, as viewing_angles() takes them."""
    own = parts.where("part = 'angles' and band is not null")
    value = lambda kind: F.max(F.when(F.col("name") == kind, F.col("value")))
    return own.groupBy(F.col("product").alias("granule"), "band", F.col("detector").alias("det"), "r", "c").agg(value("view_zenith").alias("vz"), value("view_azimuth").alias("va"))


def sun_grid(parts: DataFrame) -> DataFrame:
    """(granule, r, c, sun_zenith, sun_azimuth) of all products, as with_tie_points() takes them."""
    own = parts.where("part = 'angles' and band is null")
    value = lambda kind: F.max(F.when(F.col("name") == kind, F.col("value")))
    return own.groupBy(F.col("product").alias("granule"), "r", "c").agg(value("sun_zenith").alias("sun_zenith"), value("sun_azimuth").alias("sun_azimuth"))


def merged(*tables: DataFrame) -> DataFrame:
    """Layers (granule, y, x, ...) in one table. Of layers with one name that of the last table counts, as a whole: where the
    last one has no pixel the layer is null. A pixel of any table is kept."""
    out = None
    for t in tables:
        key = place(t)
        if out is not None:
            out = out.drop(*[c for c in t.columns if c not in key]).join(t, key, "full")
        else:
            out = t
    return out
