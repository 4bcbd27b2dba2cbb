"""What several operators share: tables in the shared folder, text folding, word hashes, components."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Letters that the contracts fold; everything else keeps its case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Spark's switch for removing a query's shuffle files as soon as the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, named by spark.checkpoint.dir. Where that is unset and
    all runs in one process (tests), a temporary folder is made once; on a cluster it has to be set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("hydrapix.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="hydrapix-")
        atexit.register(shutil.rmtree, made, True)
        found = f"file://{made}"
        spark.conf.set("hydrapix.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends here and a lost executor loses nothing. The shuffle files
    of this write are removed when it ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/hydrapix/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.hydrapix_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Empties a table made by written() that nothing reads any more."""
    if path := getattr(df, "hydrapix_path", None):
        df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path)


def fold_ascii(text: Column) -> Column:
    """Lower-cases A-Z only. For pure ASCII texts lower() is the same and far cheaper."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_rule(column: str, modulus: int, held: int) -> Column:
    """True where crc32 of the id as text falls into the held-out class."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus == held


class WordIds(dict):
    """Word (bytes) to its 64-bit hash, remembered; emptied when full, as it only saves time."""

    def __init__(self, most: int = 1 << 19):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, text: bytes | None) -> np.ndarray:
        """Hashes of the words [^\\x20\\x09-\\x0D]+ of a text, with A-Z folded (bytes.lower and
        bytes.split know just these)."""
        if not text:
            return np.empty(0, np.uint64)
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles in order; of the whole sequence as one if it is shorter."""
    if not len(ids):
        return np.empty(0, np.uint64)
    n = min(n, len(ids))
    acc = np.full(len(ids) - n + 1, np.uint64(n))
    for i in range(n):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + ids[i : len(ids) - n + 1 + i]
        acc = acc ^ (acc >> np.uint64(32))
    return mixed(acc)


def columns_of(batch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def pieces(batches: Iterator, rows: int = 256, size: int = 4 << 20) -> Iterator:
    """Arrow batches cut small, by rows and by bytes of text, so that long texts never stand in memory together."""
    for batch in batches:
        held = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                held += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(held), 0
        while at < batch.num_rows:
            fits = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
            stop = min(at + rows, max(at + 1, fits), batch.num_rows)
            yield batch.slice(at, stop - at)
            at = stop


def run_parts(batches: Iterator, most: int = 1 << 20) -> Iterator:
    """Of batches sorted by their first column: (part, starts of its runs, whether its first and its last run may have
    rows elsewhere). Runs that go on in another task, or are longer than `most` rows, come in several parts."""
    held, open_ = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            own = key[:cut]
            yield batch.slice(0, cut), np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])), open_, False
            open_ = False
        held = batch.slice(cut)
        if held.num_rows > most:
            yield held, np.zeros(1, np.int64), open_, True
            held, open_ = None, True
    if held is not None:
        yield held, np.zeros(1, np.int64), open_, True


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v) of longs: rows (node, root), root the smallest node id.

    Alternating large-star and small-star steps: every node points its neighbours at the smallest one.
    All steps are joins and partial minima on the cluster, so a hub with very many neighbours is split
    like any skewed join key. Each round is written to the shared folder; rounds go on until nothing changes (their
    number grows with the square of the logarithm of the nodes at most).
    """
    spark = edges.sparkSession
    now = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "cc"
    )
    while True:
        # done when every node points at one root and no root points anywhere
        ends = now.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            now.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        )
        ends = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if ends.where("out > 1 or (out = 1 and into = 1)").isEmpty():
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u > v").unionByName(small.where("u < v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        after = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        dropped(now)
        now = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, rows: int) -> DataFrame:
    """(doc_id, text as bytes, y): at most about `rows` labelled training rows, the same on each run.

    Rows are taken by a hash of doc_id against a threshold, so documents are filtered in the scan, before the
    join; of equal texts one is kept. Rows whose id is held out, null or has no label are never read."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~split_rule("doc_id", modulus, held))
    n = known.count()
    mark = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, rows / max(n, 1)))
    texts = docs.where(mark & F.col("text").isNotNull()).select("doc_id", F.col("text").cast("binary").alias("text"))
    known = known.where(mark).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    out = texts.join(known, "doc_id")
    first = out.groupBy(F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("doc_id"))
    return out.join(first.select("doc_id").distinct(), "doc_id", "left_semi")
