"""Exact dedup by an extendible-hash index on shared files. DataFrame functions only.

Every text (A-Z folded, null as empty) has a 64-bit key. A directory of 2^depth slots maps a key's leading bits to a
bucket. It starts with one bucket; while a bucket holds more keys than its capacity, the directory doubles and each
overfull bucket is split in two by one bit more (its local depth). Documents are placed into their buckets through
the directory. There copies combine: entries of a bucket that share a key are compared by their bytes, equal ones
become one entry with the largest doc_id and the size of the group. Owner tasks take ranges of buckets and keys and
chain the entries whose keys collide. A document then probes the index: its slot names the bucket, its key the
entry; only where a chain has several entries, the text's digest picks one of them.

Copies are combined before anything is shuffled (partial aggregation), so a text with very many copies sends
one row from each task. Cases: a null or empty text is the empty text, equal to other empty ones; of ties on
the largest doc_id (repeated rows) all rows stay; an empty table gives an empty result; other columns of the
input, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, fold_ascii, written

#: Doublings at most: the directory has no more than 65,536 rows of three numbers (2 MB), so it can be broadcast.
MAX_DEPTH = 16


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """(doc_id, norm, key): the text with A-Z folded and its key, of which `bits` bits are used."""
    out = docs.select(F.col(id_col).alias("doc_id"), fold_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    h = F.xxhash64("norm")
    return out.withColumn("key", h if bits == 64 else F.shiftleft(F.shiftrightunsigned(h, 64 - bits), 64 - bits))


def slot_of(key: str, depth: int):
    """The directory's slot of a key: its `depth` leading bits."""
    return F.shiftrightunsigned(key, 64 - depth).cast("int") if depth else F.lit(0)


def directory(keys: DataFrame, capacity: int = 50_000) -> tuple[DataFrame, int]:
    """(slot, bucket, local_depth) and the depth, after the doublings that the distinct keys need.

    Each round counts what the buckets hold and splits the overfull ones by their next bit. The counts go over
    a table of the keys' first MAX_DEPTH bits, so a round reads 65,536 rows at most. A bucket at the last depth may
    stay overfull: owner tasks still split it by key."""
    held = keys.select(slot_of("key", MAX_DEPTH).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    cells = written(held.select("cell", "n", F.lit(0).alias("local_depth"), F.lit(0).alias("bucket")), "cells")
    depth = 0
    while depth < MAX_DEPTH:
        full = cells.groupBy("bucket").agg(F.sum("n").alias("total")).where(F.col("total") > capacity)
        if full.isEmpty():
            break
        depth += 1
        split = cells.join(full, "bucket", "left").withColumn("local_depth", F.when(F.col("total").isNotNull(), depth).otherwise(F.col("local_depth")))
        # a bucket is named by its leading bits, the others 0
        bucket = F.expr(f"shiftleft(shiftright(cell, {MAX_DEPTH} - local_depth), {MAX_DEPTH} - local_depth)")
        after = written(split.withColumn("bucket", bucket).select("cell", "n", "local_depth", "bucket"), "cells")
        dropped(cells)
        cells = after
    slots = cells.select(F.shiftright("cell", MAX_DEPTH - depth).alias("slot"), "bucket", "local_depth").distinct()
    return slots, depth


def placed(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """Rows with a key, each with the bucket that the directory names."""
    return rows.withColumn("slot", slot_of("key", depth)).join(F.broadcast(slots), "slot").drop("slot")  # 65,536 rows at most


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 50_000, bits: int = 64) -> tuple[DataFrame, DataFrame, int]:
    """The index as a table in the shared folder (bucket, local_depth, key, chain, chained, sha256, keep_id,
    group_size), its directory and the depth of that."""
    rows = keyed(docs, id_col, text_col, bits)
    keys = written(rows.select("key").distinct(), "keys")
    slots, depth = directory(keys, capacity)
    slots = written(slots, "directory")
    entries = (
        placed(rows, slots, depth)
        .groupBy("bucket", "local_depth", "key", "norm")  # equality of bytes: texts with one key but other bytes are other entries
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("bucket", "local_depth", "key", F.sha2("norm", 256).alias("sha256"), "keep_id", "group_size")
    )
    entries = written(entries, "entries")
    owned = entries.repartitionByRange("bucket", "key")  # an owner task has a range of keys
    chain = Window.partitionBy("bucket", "key")
    chained = owned.withColumn("chain", F.row_number().over(chain.orderBy("sha256"))).withColumn("chained", F.count("*").over(chain))
    index = written(chained.select("bucket", "local_depth", "key", "chain", "chained", "sha256", "keep_id", "group_size"), "index")
    for x in (keys, entries):
        dropped(x)
    return index, slots, depth


def probed(rows: DataFrame, index: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """Rows (doc_id, norm, key) with the entries that they find: their bucket's entry of the key, or the one of the
    chain that has the text's digest."""
    asked = placed(rows.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256")), slots, depth)
    found = asked.join(index, ["bucket", "key"]).where("chained = 1 or sha256 = text_sha256")
    return found.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 50_000, bits: int = 64) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, text_sha256."""
    return probed(keyed(docs, id_col, text_col, bits), *build_index(docs, id_col, text_col, capacity, bits))


ORACLE_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents),
     g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm
"""
