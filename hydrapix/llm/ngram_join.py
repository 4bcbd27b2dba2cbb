"""N-gram Jaccard self-join of documents: a blocked sparse product of the document by n-gram incidence.

A document is the set of its distinct shingles of `gram` words (64-bit hashes); documents with equal sets are one node.
The figures below are for 4 words and 85 in 100; all bounds follow from the two arguments.
Two nodes link when 100 * |A & B| >= 85 * |A | B|. That bounds the overlap from below by the sizes, so only the
rarest n - ceil(0.85 n) + 2 columns of a row are needed for its product with rows of its size or smaller ones,
and of these smaller ones only their n - ceil(170 n / 185) + 2 rarest: a linked pair has min(2, bound) of them in
common (of the columns that its two sizes leave). The product over these columns accumulates each pair's overlap and
how far it has come in either row; what is left of the shorter rest bounds the overlap from above, and a pair that
stays below its bound is discarded. Of the others, the rest of the columns is multiplied too. Columns are ordered by a
fixed-size frequency sketch (any fixed order is exact; a good one makes blocks small), so passages that very many
documents share come last.

Cells are range-partitioned and sorted by column and row, so one shuffle finds the columns of two rows or more, and a
hot column lies in as many tasks as it needs.

Column blocks of groups of near copies would give all pairs of the group. Instead rounds pair each block's rows
with one hub row only, verify these pairs and merge what links, once at any table and then as long as that halves the
pairs that are left (eight rounds at most); blocks whose rows are one component are left out of later rounds. Afterwards
only rows of one block that still belong to different components are multiplied, all of them. No link between components is lost.
Every product is a join of two shuffled sides, which Spark splits if a column is hot.

Cases: null or empty texts have n_shingles 0 and are their own component; a text of fewer than `gram` words is one
shingle; a null doc_id links with nothing and has component_id null; repeated rows are returned each; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordIds, columns_of, components, dropped, gram_hashes, pieces, run_parts, written

GRAM, PERCENT, COMMON = 4, 85, 2
SKETCH_BITS, BLOCK = 20, 1024
ROUNDS, SLACK = 8, 3


def shingle_set(ids: np.ndarray, gram: int) -> np.ndarray:
    return np.unique(gram_hashes(ids, gram))


def node_of(shingles: np.ndarray) -> int:
    """A set's id: a signed 64-bit hash of its content and size."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles)) - (1 << 63)


def _digests(gram: int):
    """(doc_id, n, node) of each document, then (block, counts) of the sketch of all shingles of the task."""

    def run(batches: Iterator) -> Iterator:
        words, size = WordIds(), 1 << SKETCH_BITS
        sketch, waiting, held = np.zeros(size, np.int64), [], 0

        def row(doc_ids, ns, nodes, blocks, counts):
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), pa.array(blocks, pa.int32()), pa.array(counts, pa.binary())],
                names=["doc_id", "n", "node", "block", "counts"],
            )

        for batch in pieces(batches):
            ids, texts = columns_of(batch, "doc_id", "text")
            ns, nodes = [], []
            for text in texts:
                s = shingle_set(words.of(text), gram)
                ns.append(len(s))
                nodes.append(node_of(s))
                waiting.append((s & np.uint64(size - 1)).astype(np.int64))
                held += len(s)
            if held > 1 << 20:
                sketch += np.bincount(np.concatenate(waiting), minlength=size)
                waiting, held = [], 0
            yield row(ids, ns, nodes, [None] * len(ids), [None] * len(ids))
        if held:
            sketch += np.bincount(np.concatenate(waiting), minlength=size)
        if sketch.any():
            parts = np.minimum(sketch, 2**31 - 1).astype("<i4").reshape(-1, BLOCK)
            none = [None] * len(parts)
            yield row(none, none, none, list(range(len(parts))), [p.tobytes() for p in parts])

    return run


def _summed(batches: Iterator) -> Iterator:
    """Adds up the counts of each block, one row at a time."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(*columns_of(batch, "block", "counts"), strict=True):
            sums[block] = sums.get(block, 0) + np.frombuffer(counts, "<i4").astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([np.minimum(x, 2**31 - 1).astype("<i4").tobytes() for x in sums.values()], pa.binary())],
            names=["block", "counts"],
        )


def _columns_needed(sketch, gram: int, percent: int):
    """The rarest columns of each document: rows (token, node, n, at) with at the column's place by rarity."""

    def run(batches: Iterator) -> Iterator:
        words, seen, counts = WordIds(), set(), sketch.value
        for batch in pieces(batches):
            tokens, nodes, ns, places = [], [], [], []
            for text in columns_of(batch, "text")[0]:
                s = shingle_set(words.of(text), gram)
                n = len(s)
                least = -(-percent * n // 100)
                if 100 * n < percent * (n + 1):  # only an equal set can link
                    continue
                node = node_of(s)
                if node in seen:
                    continue
                if len(seen) > 1 << 19:
                    seen.clear()
                seen.add(node)
                rare = np.argsort(counts[(s & np.uint64(len(counts) - 1)).astype(np.int64)], kind="stable")
                kept = s[rare[: n - least + COMMON]]
                tokens.append(kept)
                nodes.append(np.full(len(kept), node, np.int64))
                ns.append(np.full(len(kept), n, np.int32))
                places.append(np.arange(len(kept), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (nodes, ns, places))],
                    names=["token", "node", "n", "at"],
                )

    return run


def _columns_of_two(batches: Iterator) -> Iterator:
    """Of cells sorted by token and node, those whose token has two nodes or more; each cell once. Runs that may go on
    in another task stay in any case."""
    for part, start, before, after in run_parts(batches):
        token, node = (part.column(i).to_numpy() for i in (0, 1))
        fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
        many = np.add.reduceat(fresh, start) > 1
        many[0] |= before
        many[-1] |= after
        yield part.filter(pa.array(fresh & np.repeat(many, np.diff(np.append(start, len(token))))))


def _sets(bits, gram: int):
    """(node, shingles) of the documents whose id has its bit set in the bitmap; a node once in the task."""

    def run(batches: Iterator) -> Iterator:
        words, wanted, seen = WordIds(), bits.value, set()
        for batch in pieces(batches):
            ids, texts = columns_of(batch, "slot", "text")
            nodes, sets = [], []
            for i, t in zip(ids, texts, strict=True):
                if wanted[i >> 3] >> (i & 7) & 1:
                    s = shingle_set(words.of(t), gram)
                    if (node := node_of(s)) not in seen:
                        if len(seen) > 1 << 19:
                            seen.clear()
                        seen.add(node)
                        nodes.append(node)
                        sets.append(s.tobytes())
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _linked(percent: int):
    def run(batches: Iterator) -> Iterator:
        for batch in pieces(batches, 1024):
            us, vs, left, right = columns_of(batch, "u", "v", "a", "b")
            out = []
            for u, v, x, y in zip(us, vs, left, right, strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(b, a)
                at[at == len(b)] = 0
                both = int((b[at] == a).sum())
                if 100 * both >= percent * (len(a) + len(b) - both):
                    out.append((u, v))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["u", "v"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(_linked(percent), "u long, v long")


def _fits(x: str, y: str, percent: int) -> str:
    return f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"


def _shingle_sets(known: DataFrame, digests: DataFrame, pairs: DataFrame, gram: int) -> DataFrame:
    """(node, shingles) of the nodes in some pairs, from one document of each. A bitmap marks these documents, so the
    others' texts are never shuffled; it has 16 bits for each of them, 2^28 at most (32 MB; marks that coincide only
    cost time, the joins with the pairs drop what is not wanted)."""
    nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    # one row for each node first (copies combine before the shuffle), then the wanted ones
    ids = written(digests.groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(nodes, "node", "left_semi"), "wanted")
    bits = min(28, max(18, (16 * ids.count()).bit_length()))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits))
    marks = ids.select(F.shiftright(h, 15).alias("k"), (h % (1 << 15)).cast("long").alias("bit"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in marks.groupBy("k").agg(F.bitmap_construct_agg("bit").alias("m")).toLocalIterator():
        out[r["k"] << 12 : (r["k"] + 1) << 12] = np.frombuffer(r["m"], np.uint8)
    dropped(ids)
    marked = known.sparkSession.sparkContext.broadcast(out)
    sets = known.select(h.cast("int").alias("slot"), "text").mapInArrow(_sets(marked, gram), "node long, shingles binary")
    # a table, so that the joins shuffle it directly and Spark can split a hub that very many pairs have
    return written(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    first = written(texts.mapInArrow(_digests(gram), "doc_id long, n long, node long, block int, counts binary"), "digests")
    digests = first.where("block is null").select("doc_id", "n", "node")
    sketch = np.zeros(1 << SKETCH_BITS, np.int32)
    blocks = first.where("block is not null").select("block", "counts").repartition("block")
    for r in blocks.mapInArrow(_summed, "block int, counts binary").collect():  # 4 MB at any size of input
        sketch[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], "<i4")
    held = spark.sparkContext.broadcast(sketch)
    known = texts.where("doc_id is not null")
    cells = written(known.mapInArrow(_columns_needed(held, gram, percent), "token long, node long, n int, at int"), "cells")
    cells_in_order = cells.repartitionByRange("token", "node").sortWithinPartitions("token", "node")
    shared = written(cells_in_order.mapInArrow(_columns_of_two, "token long, node long, n int, at int"), "shared")
    dropped(cells)
    # rows that share most of their columns stand in the middle of their group: the best hubs
    degree = shared.groupBy("node").agg(F.expr(f"-count(*) / (first(n) - ceil({percent} * first(n) / 100) + {COMMON})").alias("pri"))
    blocks = written(shared.join(degree, "node").select("token", "node", "n", "at", "pri"), "blocks")
    dropped(shared)
    # each round goes over the cells of columns that were still open in the round before, each with its row's component
    kept, links, labels, before = blocks, None, None, float("inf")
    for r in range(ROUNDS + 1):
        if labels is None:  # every row is a component of its own
            now = kept.withColumn("label", F.col("node"))
        else:
            cells = kept.select("token", "node", "n", "at").join(labels, "node", "left")
            now = written(cells.withColumn("label", F.coalesce("root", "node")).drop("root"), "labelled")
            dropped(kept)
            kept = now
        rank = F.xxhash64("node", F.lit(r)).cast("double") if r else F.col("pri")
        order = F.struct(rank.alias("rank"), F.col("node")).alias("order")
        short = f"at < n - ceil({2 * percent} * n / {100 + percent}) + {COMMON}"
        if labels is None:
            per = now.withColumns({"m": F.lit(1), "s": F.expr(f"int({short})"), "hub": F.struct(order, "n", "label")})
        else:
            per = now.groupBy("token", "label").agg(F.count("*").alias("m"), F.count_if(F.expr(short)).alias("s"), F.min(F.struct(order, "n", "label")).alias("hub"))
        per = per.groupBy("token").agg(
            F.sum("m").alias("m"), (F.sum("m") * F.sum("s") - F.sum(F.col("m") * F.col("s"))).alias("pairs"), F.min("hub").alias("hub"), F.count("*").alias("k")
        )
        open_lists = written(per.where("k > 1 and pairs > 0").select("token", "hub", "pairs", "m"), "lists")
        total = open_lists.agg(F.sum("pairs").alias("p"), F.sum("m").alias("m")).first()
        if not total["m"]:
            dropped(open_lists)
            break
        # hubs come first at any number of pairs, so that small and large tables take the same way
        last = r == ROUNDS or r > 0 and (total["p"] <= SLACK * total["m"] or total["p"] > before / 2)
        before = total["p"]
        if last:
            rows = now.join(open_lists.select("token"), "token").select("token", "node", "n", "label", "at")
            other = rows.where(short).select("token", F.col("node").alias("v"), F.col("n").alias("o"), F.col("label").alias("other"), F.col("at").alias("place"))
            # a pair's own sizes bound the columns that it needs on either side more tightly, and no more than the columns
            # before the common one and the shorter rest behind it can be common too
            needed = f"ceil({percent} * (n + o) / {100 + percent})"
            within = f"at < n - {needed} + {COMMON} and place < o - {needed} + {COMMON} and least(at, place) + least(n - at, o - place) >= {needed}"
            pairs = rows.join(other, "token").where(f"label <> other and (o < n or o = n and node < v) and {_fits('n', 'o', percent)} and {within}")
            pairs = pairs.withColumnRenamed("node", "u")
        else:
            one = open_lists.select("token", F.col("hub.order.node").alias("v"), F.col("hub.n").alias("o"), F.col("hub.label").alias("other"))
            still = written(now.join(one, "token"), "open")
            dropped(kept)
            kept = still
            pairs = kept.where(f"label <> other and {_fits('n', 'o', percent)}").withColumnRenamed("node", "u")
            pairs = pairs.withColumn("place", F.lit(0))
        # common columns lie in the same order in both rows, so after the last one counted no more than the shorter rest
        # can follow (hub rounds see only some of a pair's columns, so there the count alone decides)
        counted = pairs.groupBy("u", "v", "n", "o").agg(F.count("*").alias("c"), F.max("at").alias("x"), F.max("place").alias("y"))
        least = f"ceil({percent} * (n + o) / {100 + percent}.0)"
        rest = f"c + least(n - 1 - x, o - 1 - y) >= {least}" if last else "true"
        counted = counted.where(f"c >= least({COMMON}, {least}) and {rest}").select("u", "v")
        counted = written(counted, "pairs")
        sets = _shingle_sets(known, digests, counted, gram)
        found = written(_verified(counted, sets, percent), "links")
        for x in (open_lists, counted, sets):
            dropped(x)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if last:
            break
    dropped(kept)
    # classes by node, by way of tables, so that the joins shuffle both sides directly and Spark can split a class or a node
    # that very many rows have
    nodes = digests.where("n > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    if labels is not None:
        rooted = written(nodes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
        least = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
        nodes = rooted.join(least, "root").select("node", F.col("component_id").alias("first_id"))
    classes = written(nodes.withColumnRenamed("node", "own"), "classes")
    if labels is not None:
        for x in (rooted, least):
            dropped(x)
    out = digests.withColumn("own", F.when(F.col("n") > 0, F.col("node"))).join(classes, "own", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS ws FROM documents),
     g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                  ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS s FROM w),
     n AS (SELECT w.doc_id, count(g.s) AS n_shingles FROM w LEFT JOIN g USING (doc_id) GROUP BY 1),
     o AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
     e AS (SELECT u, v FROM o JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n_shingles + y.n_shingles - c)),
     r AS (SELECT doc_id AS u, doc_id AS root FROM w UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.u)
SELECT n.doc_id, n.n_shingles, (SELECT min(root) FROM r WHERE r.u = n.doc_id) AS component_id FROM n
"""
