"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are taken from a bounded, hash-chosen sample of the vectors; their number grows with the
square root of the vectors, up to 32 MB of them. No two pivots are within twice the linking angle, so a group of
near copies has one or a few of them, whatever its size. Each vector is described by its nearest pivots in order (more of
them where there are more pivots). If
these hold all pivots that are at most twice the linking angle further off than the first one, only those count.

Two vectors are candidates if the first pivot of each is among the other's pivots: they share two pivots, or have the
same first one. So the inverted lists are kept by pairs of pivots (own first pivot, other pivot), and each candidate
pair meets in one list only. If both descriptions are complete in the sense above, every pair that links is such a
pair (triangle inequality); members of dense groups are such vectors.

A list of no more than `chunk` vectors is one block. Within a longer one vectors lie in bins of their angle to the list's pivot, an eighth of the linking angle wide. Bins that
are further apart than the linking angle hold no link. Bins whose angles together stay within it are linked throughout
(triangle inequality again): their links are counted from the bins' sizes, so a tight group of near copies costs one
row a member and not the square. All other bins are cut into chunks of at most `chunk` rows, and pairs of chunks
are decided by cosine in double precision: no list stands in one task. Equal vectors are one node with a multiplicity.
Chunks return counts of links and a spanning star for each of their components, never the pairs.

The index is approximate for vectors whose description is not complete (recall against brute force is measured in the
tests); no pair below the threshold is linked. Cases: vectors that are null, zero, of another length, or hold null or
non-finite components, and rows without label or vec_id, link with nothing; a null vec_id has component_id and kept
null; rows that repeat a vec_id count as other vectors; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns_of, components, dropped, pieces, run_parts, written

#: Bins to the linking angle, and a margin for rounding in angles.
BINS, MARGIN = 8, 1e-6
#: Below this linking angle bins stay as wide as for it, and none is linked throughout.
LEAST = 0.01


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def spread(sample: np.ndarray, count: int, threshold: float) -> np.ndarray:
    """At most count of the unit vectors, first come first, none within twice the linking angle of another."""
    most, kept = max(2 * threshold**2 - 1, -1.0) if threshold > 0 else -1.0, []
    open_ = np.ones(len(sample), bool)
    for i in range(len(sample)):
        if open_[i]:
            kept.append(i)
            if len(kept) == count:
                break
            open_ &= sample @ sample[i] < most
    return sample[kept]


def described(x: np.ndarray, pivots: np.ndarray, nearest: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pivots that describe each of the unit vectors x, nearest first (-1 fills short rows), and angles to all."""
    near = x @ pivots.T
    k = min(nearest, near.shape[1])
    perm = np.argpartition(-near, k - 1, axis=1)[:, :k]
    perm = np.take_along_axis(perm, np.argsort(-np.take_along_axis(near, perm, 1), axis=1, kind="stable"), 1).astype(np.int32)
    angle = np.arccos(np.clip(near, -1, 1))
    within = angle <= angle.min(1)[:, None] + 2 * np.arccos(threshold) + MARGIN
    all_held = within.sum(1) <= k
    perm[all_held[:, None] & ~np.take_along_axis(within, perm, 1)] = -1
    return perm, angle


def nearest_of(pivots: int) -> int:
    """How many pivots describe a vector, so that recall holds as pivots get more (10 of 32, 24 of 2,048)."""
    return max(10, round(2.2 * np.log2(max(pivots, 2))))


def lists_of(perm: np.ndarray, angle: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """(row, a, b, side, bin): the lists in which each vector stands, the pairs of its first pivot with each of its
    pivots in order, on which side (whether its first pivot is a), and its bin by the angle to a."""
    row, place = np.nonzero(perm >= 0)
    first, other = perm[row, 0], perm[row, place]
    a, b = np.minimum(first, other), np.maximum(first, other)
    width = (max(np.arccos(threshold), LEAST) - 2 * MARGIN) / BINS
    return row, a, b, (first != a).astype(np.int32), (angle[row, a] / width).astype(np.int32)


def _described(pivots, nearest: int | None, threshold: float):
    """Rows (label, dim, node, m, a, b, side, bin): a vector in each of its lists."""

    def run(batches: Iterator) -> Iterator:
        table = pivots.value
        for batch in pieces(batches, 512):
            labels, nodes, ms, vectors = columns_of(batch, "label", "node", "m", "vector")
            sizes = np.array([len(v) for v in vectors])
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                x = unit(np.array([vectors[i] for i in own], np.float64))
                row, a, b, side, bin_ = lists_of(*described(x, table[dim], nearest or nearest_of(len(table[dim])), threshold), threshold)
                cols = [pa.array(np.array(c, np.int64)[own][row]) for c in (labels, nodes, ms)]
                flat = [pa.array(c.astype(np.int32)) for c in (np.full(len(row), dim), a, b, side, bin_)]
                yield pa.RecordBatch.from_arrays([*cols, *flat], names=["label", "node", "m", "dim", "a", "b", "side", "bin"])

    return run


def _roots(links: np.ndarray) -> np.ndarray:
    """Smallest index reachable by links, from a boolean matrix with a true diagonal."""
    at = np.arange(len(links))
    while True:
        low = np.where(links, at[None, :], len(links)).min(1)
        low = low[low]
        if (low == at).all():
            return at
        at = low


def _decided(threshold: float):
    """Of rows sorted by block (block, part, node, m, vector), part 0 and 1 against each other or 2 with itself: rows
    (u, v, links) with each linked node, the root of its component in the block, and its links there."""

    def run(batches: Iterator) -> Iterator:
        for rows, start, _, _ in run_parts(batches):
            part, node, m = (rows.column(i).to_numpy() for i in (1, 2, 3))
            flat, out = rows.column(4).flatten().to_numpy().astype(np.float64), []
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(rows.column(4)).to_numpy())])
            for a, b in zip(start, np.append(start[1:], len(node)), strict=True):
                x = unit(flat[at[a] : at[b]].reshape(b - a, -1))
                left = part[a:b] == 0
                links = x @ x.T >= threshold
                if part[a] != 2:
                    links &= left[:, None] != left[None, :]
                np.fill_diagonal(links, False)
                counts = links.astype(np.float64) @ m[a:b].astype(np.float64)
                got = counts > 0
                if got.any():
                    np.fill_diagonal(links, True)
                    out.append((node[a:b][got], node[a:b][_roots(links)[got]], counts[got].astype(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["u", "v", "links"])

    return run


def _links(lists: DataFrame, vectors: DataFrame, threshold: float, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Rows (u, v, links), counted from bins and decided by cosine: links of u in some list or block, and a node v that u
    is linked with (or u itself). The lists hold no vectors; these (node, vector) join what goes into a block."""
    key = ["label", "dim", "a", "b"]
    bins = lists.groupBy(*key, "side", "bin").agg(F.count("*").alias("n"), F.sum("m").alias("m"), F.min("node").alias("low"))
    # a list has no more than two sides with as many bins as fit into half a turn
    table = bins.groupBy(*key).agg(F.collect_list(F.expr(f"struct(side, bin, n, m, low, cast(ceil(n / {chunk}) as int) as chunks)")).alias("bins"), F.sum("n").alias("all"))
    table = table.where("all > 1 and (a = b or exists(bins, x -> x.side <> bins[0].side))")
    rows = lists.join(table, key)
    # a list of no more than a chunk is one block
    short = rows.where(f"all <= {chunk}").select(F.xxhash64(*key).alias("block"), F.expr("if(a = b, 2, side)").alias("part"), "node", "m")
    rows = rows.where(f"all > {chunk}").withColumns(
        {
            "c": F.expr("pmod(xxhash64(node, 5), filter(bins, x -> x.side = side and x.bin = bin)[0].chunks)"),
            "others": F.expr("filter(bins, x -> a = b or x.side <> side)"),
        }
    )
    near = f"bin + x.bin + 2 <= {BINS}" if np.arccos(threshold) > LEAST else "false"
    counted = rows.withColumn("sure", F.expr(f"filter(others, x -> {near})")).where("size(sure) > 0")
    counted = counted.select(
        F.col("node").alias("u"),
        F.expr("array_min(transform(others, x -> struct(x.bin as bin, x.low as low))).low").alias("v"),  # in the lowest bin, so linked with all that count here
        F.expr(f"aggregate(sure, 0L, (s, x) -> s + x.m) - if(a = b and 2 * bin + 2 <= {BINS}, m, 0L)").alias("links"),
    )
    reach = f"filter(others, x -> not ({near}) and abs(bin - x.bin) <= {BINS + 1} and (x.n > 1 or x.bin <> bin or a <> b))"
    each = rows.withColumn("x", F.explode(F.expr(reach))).withColumn("o", F.expr("explode(sequence(0, x.chunks - 1))"))
    each = each.withColumns({"me": F.expr("struct(side as s, bin as t, c as c)"), "you": F.expr("struct(x.side as s, x.bin as t, o as c)")})
    each = each.select(
        F.xxhash64(*key, F.least("me", "you"), F.greatest("me", "you")).alias("block"), F.expr("if(me = you, 2, if(me < you, 0, 1))").alias("part"), "node", "m"
    )
    blocks = short.unionByName(each).join(vectors, "node").select("block", "part", "node", "m", "vector")
    return counted, blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_decided(threshold), "u long, v long, links long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, nearest: int | None = None, most_pivots: int = 16_384, chunk: int = 1024) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    base = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    plain = "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vector, x -> x <> 0)"
    ok = F.coalesce(F.expr(f"vec_id is not null and label is not null and vector is not null and {plain}"), F.lit(False))
    good = base.where(ok)
    nodes = written(good.groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("m")), "nodes")
    held: dict[int, np.ndarray] = {}
    for dim, n in nodes.groupBy(F.size("vector")).count().collect():  # a row for each length of vector
        count = int(min(most_pivots, (32 << 20) // (8 * dim), max(32, 2 ** round(np.log2(n) / 2))))
        picked = nodes.where(F.size("vector") == dim).orderBy(F.xxhash64("vector"), "label").limit(2 * count).select("vector").collect()
        held[dim] = spread(unit(np.array([x["vector"] for x in picked], np.float64)), count, threshold)
    pivots = spark.sparkContext.broadcast(held)
    nodes = nodes.withColumn("id", F.xxhash64("label", "vector"))
    lists = written(
        nodes.select("label", F.col("id").alias("node"), "m", "vector").mapInArrow(
            _described(pivots, nearest, threshold), "label long, node long, m long, dim int, a int, b int, side int, bin int"
        ),
        "lists",
    )
    kind = "array<float>" if vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType(), vectors.schema["embedding"].dataType.containsNull) else "array<double>"
    counted, decided = _links(lists, nodes.select(F.col("id").alias("node"), F.col("vector").cast(kind).alias("vector")), threshold, chunk)
    found = written(counted.unionByName(decided), "found")
    dropped(lists)
    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    labels = components(found.select("u", "v"))
    known = nodes.select("id", "node", "m").join(counts, F.col("id") == F.col("u"), "left").drop("u")
    known = known.join(labels.withColumnRenamed("node", "w"), F.col("id") == F.col("w"), "left").drop("w")
    known = known.withColumn("root", F.coalesce("root", "id"))
    least = known.groupBy("root").agg(F.min("node").alias("component_id"))
    known = known.join(least, "root").select("id", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    out = base.select("vec_id", F.when(ok, F.xxhash64("label", "vector")).alias("id")).join(known, "id", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id")
    )


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
     n AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
           WHERE label IS NOT NULL AND vec_id IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.norm > 0 AND b.norm > 0
           AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
     r AS (SELECT vec_id AS u, vec_id AS root FROM v UNION SELECT l.v, r.root FROM r JOIN l ON l.u = r.u)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.u = v.vec_id) AS n_links, (SELECT min(root) FROM r WHERE r.u = v.vec_id) AS component_id,
       v.vec_id = (SELECT min(root) FROM r WHERE r.u = v.vec_id) AS kept FROM v
"""
