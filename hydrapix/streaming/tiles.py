"""Incremental region writes: pixels that arrive go into their own region of a tiled table, nothing else changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.rasters import write_region


def keep_region_table(spark: SparkSession, incoming: str, schema: str, path: str, checkpoint: str, tile: int = 610):
    """Starts a query that merges each arriving batch of pixels into its tiles: a tile may arrive in parts. A batch that is
    run again after a failure puts the same pixels there again, so the table stays right. Absent tiles are 0 to
    read_region()."""

    def put(batch: DataFrame, _: int) -> None:
        write_region(batch, path, tile)

    stream = spark.readStream.schema(schema).parquet(incoming)
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
