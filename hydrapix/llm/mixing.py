"""Mixing sources to target weights by a time-varying curriculum. DataFrame functions only.

Each source has a target number of words: its weight's share of the budget, stopped at `most` times what the
source has, the excess shared again by weight. A source's documents lie in a fixed pseudo-random order on a
tape that repeats; the mix takes the copies whose middle lies within the target. The weight of a source
changes over training time t in [0, 1] as target * (1 - b + 2 b t), with b by the source's rank. Its integral
is the demand for the source's words up to t; inverting it gives each taken copy its training position, and
the rows are range-sorted by position.

Prefix sums go in two steps (sums of hash buckets, then windows within a bucket), so no source, however
large, stands in one task. Rows alike in id, source and size are counted first and laid out one after the other
later, so an id that very many rows share (null ids too) fills no bucket. Cases: a null text has size 0 and is never taken; a null source is a source of its
own, last in order; repeated rows count each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, most: int = 2) -> DataFrame:
    """Of rows (source, held) (source, source_size, rank, target), one for each source (the windows run over sources only)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("held").alias("source_size"))
    per = per.withColumn("rank", F.row_number().over(order) - 1)
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * most).withColumn("fill", F.col("cap").cast("double") / F.col("w"))
    first = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("fill", "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = per.withColumn("words", (F.lit(budget) * F.sum("source_size").over(every)).cast("double"))
    level = (F.col("words") - F.coalesce(F.sum("cap").over(first), F.lit(0))) / F.sum("w").over(rest)
    per = per.withColumn("full", F.col("w") * level >= F.col("cap"))
    capped = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0))
    share = F.sum(F.when(~F.col("full"), F.col("w"))).over(every)
    per = per.withColumn("lambda", (F.col("words") - capped) / share)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * F.col("lambda"))
    return per.select("source", "source_size", "rank", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, most: int = 2, buckets_hex: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, taken, position, position_2 (of the second copy), sorted by position."""
    assert most == 2, "a document has at most two copies"
    sizes = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    )
    sizes = sizes.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    sizes = sizes.withColumn("bucket", F.substring("h", 1, buckets_hex))
    sizes = written(sizes.groupBy("source", "bucket", "h", "doc_id", "size").agg(F.count("*").alias("rows"), F.sum("size").alias("held")), "sizes")
    targets = source_targets(sizes, weights, budget, most)
    sums = sizes.groupBy("source", "bucket").agg(F.sum("held").alias("held"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("held").over(before), F.lit(0))).drop("held")
    known = sums.join(targets, sums.source.eqNullSafe(targets.source)).drop(targets.source)
    within = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("inner", F.coalesce(F.sum("held").over(within), F.lit(0)))
    # the buckets' table has at most 16^buckets_hex rows for each source; Spark broadcasts it only if small
    placed = placed.join(known, placed.source.eqNullSafe(known.source) & (placed.bucket == known.bucket)).drop(
        known.source, known.bucket
    )
    placed = placed.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1))).withColumn("inner", F.col("inner") + F.col("row") * F.col("size"))
    twice = 2 * (F.col("base") + F.col("inner")) + F.col("size")  # twice the middle of the first copy
    one = (F.col("size") > 0) & (twice <= 2 * F.col("target"))
    two = (F.col("size") > 0) & (twice + 2 * F.col("source_size") <= 2 * F.col("target"))
    slope = F.lit(0.5) - F.lit(0.5) * (F.col("rank") % 3)  # early sources, level ones, late ones

    def when(middle):
        """Inverts target * ((1 - b) t + b t^2) = words before the copy's middle."""
        y = F.least(middle / F.col("target"), F.lit(1.0))
        b, c = -slope, 1 + slope
        root = F.sqrt(F.greatest(c * c + 4 * b * y, F.lit(0.0)))
        return F.round(2 * y / (c + root), 9)

    out = placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * (one.cast("long") + two.cast("long"))).alias("taken"),
        F.when(one, when(twice / 2)).alias("position"),
        F.when(two, when(twice / 2 + F.col("source_size"))).alias("position_2"),
        "h",
    )
    return out.orderBy(F.col("position").asc_nulls_last(), "h").drop("h")


ORACLE_SQL = r"""
WITH sizes AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                      coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
     per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
     r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM per),
     w AS (SELECT *, [3, 1, 2][rnk % 3 + 1] AS w, source_size * 2 AS cap FROM r),
     f AS (SELECT *, CAST(cap AS DOUBLE) / w AS fill, CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE) AS words FROM w),
     l AS (SELECT *, w * ((words - CAST(coalesce(sum(cap) OVER (ORDER BY fill, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
                  / CAST(sum(w) OVER (ORDER BY fill, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE)) >= cap AS is_full FROM f),
     t AS (SELECT source, source_size, rnk, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE w * (
              (words - CAST(coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0) AS DOUBLE)) / CAST(sum(CASE WHEN NOT is_full THEN w END) OVER () AS DOUBLE)) END AS target FROM l),
     p AS (SELECT s.*, t.source_size, t.target, t.rnk, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
           FROM sizes s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
     c AS (SELECT *, size > 0 AND 2 * before + size <= 2 * target AS one, size > 0 AND 2 * before + size + 2 * source_size <= 2 * target AS two,
                  0.5::DOUBLE - 0.5::DOUBLE * (rnk % 3) AS slope, least(((2 * before + size)::DOUBLE / 2) / target, 1::DOUBLE) AS y1,
                  least(((2 * before + size)::DOUBLE / 2 + source_size) / target, 1::DOUBLE) AS y2 FROM p)
SELECT doc_id, size, source_size, target, size * (one::BIGINT + two::BIGINT) AS taken,
       CASE WHEN one THEN round(2 * y1 / ((1 + slope) + sqrt(greatest((1 + slope) * (1 + slope) + 4 * (-slope) * y1, 0))), 9) END AS position,
       CASE WHEN two THEN round(2 * y2 / ((1 + slope) + sqrt(greatest((1 + slope) * (1 + slope) + 4 * (-slope) * y2, 0))), 9) END AS position_2
FROM c
"""
