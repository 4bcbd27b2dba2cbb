"""Repeated passages by a sparse suffix array.

Texts are word sequences ([^\\x20\\x09-\\x0D]+, A-Z folded). Suffixes are retained only where a minimiser selects
them: the smallest hash of 16-word seeds in each window of 50 words, so equal passages of 50 words retain equal
suffixes whatever surrounds them. The retained suffixes are range-partitioned and sorted by their words (hashes of the
first 16 and the next 16, ties by text and place, so a seed that very many texts share is spread over tasks).
Neighbours with one seed in different texts are matches. The texts that have some are fetched once each, and every
match is extended: to the left and right of its place, as far as 50-word windows reach whose minimiser it is. The
extensions are sorted by content in the same way, and neighbours that are equal in different texts are repeated;
a text's repeated windows are merged into spans. Neither step groups by a key, so no seed, line or passage, however
common, has to be in one task. A word is repeated if and only if some 50-word window around it occurs in another
document. Words and windows are compared by 64-bit hashes and not by their letters again: of n different windows around
matches about n^2 / 2^65 pairs are taken for equal, one pair at 6 * 10^9 of them, some millions at 10^13.

Equal texts are one text with a multiplicity; with two or more copies the whole text is repeated. Cases: null and
empty texts, and texts under 50 words, have no repeated words; null doc_ids and repeated rows are documents like
others; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordIds, columns_of, dropped, mixed, pieces, run_parts, written

LEAST, SEED = 50, 16


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(0xD6E8FEB86659FD93) ^ (b + np.uint64(0x632BE59BD9B4E019)))


def spans_of(ids: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of all runs of 1, 2, 4, ... 32 words, each from two of half its length."""
    out, n = {1: mixed(ids)}, 1
    while 2 * n <= 32 and len(out[n]) > n:
        out[2 * n] = joined(out[n][:-n], out[n][n:])
        n *= 2
    return out


def windows(runs: dict[int, np.ndarray], n: int) -> np.ndarray:
    """Hashes of the runs of LEAST (50 = 32 + 16 + 2) words of a text of n words."""
    k = n - LEAST + 1
    return joined(joined(runs[32][:k], runs[16][32 : 32 + k]), runs[2][48 : 48 + k])


def minimisers(seeds: np.ndarray, k: int) -> np.ndarray:
    """For each of k windows the place of its smallest seed, the leftmost of equal ones."""
    view = np.lib.stride_tricks.sliding_window_view(seeds, LEAST - SEED + 1)[:k]
    return view.argmin(1) + np.arange(k)


def text_key(ids: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(ids.tobytes(), seed=len(ids)) - (1 << 63)


def _texts(batches: Iterator) -> Iterator:
    words = WordIds()
    for batch in pieces(batches):
        ids, texts = columns_of(batch, "doc_id", "text")
        seqs = [words.of(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([text_key(s) for s in seqs], pa.int64()), pa.array([len(s) for s in seqs], pa.int64())], names=["doc_id", "key", "n_words"]
        )


def _once(batches: Iterator) -> Iterator:
    """(key, text, word hashes) of texts of LEAST words or more, each once in the task."""
    words, seen = WordIds(), set()
    for batch in pieces(batches):
        out = []
        for text in columns_of(batch, "text")[0]:
            ids = words.of(text)
            if len(ids) >= LEAST and (key := text_key(ids)) not in seen:
                if len(seen) > 1 << 19:
                    seen.clear()
                seen.add(key)
                out.append((key, text, ids))
        yield out


def _suffixes(batches: Iterator) -> Iterator:
    """Rows (seed, tail, key, place) of the retained suffixes."""
    for part in _once(batches):
        seeds, tails, keys, places = [], [], [], []
        for key, _, ids in part:
            runs = spans_of(ids)
            at = np.unique(minimisers(runs[SEED], len(ids) - LEAST + 1))
            after = at + SEED
            seeds.append(runs[SEED][at])
            tails.append(np.where(after < len(runs[SEED]), runs[SEED][np.minimum(after, len(runs[SEED]) - 1)], np.uint64(0)))
            keys.append(np.full(len(at), key, np.int64))
            places.append(at.astype(np.int32))
        if seeds:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(seeds).view(np.int64)), pa.array(np.concatenate(tails).view(np.int64)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(places))],
                names=["seed", "tail", "key", "place"],
            )


def _matches(batches: Iterator) -> Iterator:
    """Of sorted suffixes (seed, key, place), rows (key, place) of those whose seed other texts have too. Runs that may
    go on in another task stay in any case; the extension decides."""
    for part, start, before, after in run_parts(batches):
        key = part.column(1).to_numpy()
        many = np.minimum.reduceat(key, start) != np.maximum.reduceat(key, start)
        many[0] |= before
        many[-1] |= after
        yield part.filter(pa.array(np.repeat(many, np.diff(np.append(start, len(key)))))).select(["key", "place"])


def _fetched(batches: Iterator) -> Iterator:
    """Rows (key, text): each text once in the task."""
    for part in _once(batches):
        if part:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in part], pa.int64()), pa.array([x[1] for x in part], pa.binary())], names=["key", "text"])


def _extended(batches: Iterator) -> Iterator:
    """Of texts and the places of their matches, rows (window, key, at): the windows whose minimiser a match is."""
    words = WordIds()
    for batch in pieces(batches):
        hashes, keys, starts = [], [], []
        for key, text, places in zip(*columns_of(batch, "key", "text", "places"), strict=True):
            ids = words.of(text)
            runs, wanted = spans_of(ids), np.zeros(len(ids), bool)
            wanted[places] = True
            at = np.flatnonzero(wanted[minimisers(runs[SEED], len(ids) - LEAST + 1)])
            hashes.append(windows(runs, len(ids))[at])
            keys.append(np.full(len(at), key, np.int64))
            starts.append(at.astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(starts))], names=["window", "key", "at"])


def _repeated(batches: Iterator) -> Iterator:
    """Of sorted windows (window, key, at), rows (window, key, at, lo, hi): with lo null those that another text has
    too; of runs that may go on in another task also one row with their smallest and largest key, and, if that is one
    key, their rows with lo = hi = key to be settled."""
    for part, start, before, after in run_parts(batches):
        key = part.column(1).to_numpy()
        lo, hi = np.minimum.reduceat(key, start), np.maximum.reduceat(key, start)
        size = np.diff(np.append(start, len(key)))
        sure = lo != hi
        edge = np.zeros(len(start), bool)
        edge[0] |= before
        edge[-1] |= after
        rows = part.filter(pa.array(np.repeat(sure | edge, size)))
        own = np.repeat(sure, size)[np.repeat(sure | edge, size)]
        k = rows.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(k, pa.int64(), mask=own), pa.array(k, pa.int64(), mask=own)], names=["window", "key", "at", "lo", "hi"])
        if edge.any():
            none = pa.nulls(int(edge.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(part.column(0).to_numpy()[start[edge]]), none, none.cast(pa.int32()), pa.array(lo[edge]), pa.array(hi[edge])], names=["window", "key", "at", "lo", "hi"])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_words, n_repeated, spans ('start:end,...' in words, end exclusive)."""
    raw = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    texts = written(raw.mapInArrow(_texts, "doc_id long, key long, n_words long"), "texts")
    suffixes = written(raw.select("text").mapInArrow(_suffixes, "seed long, tail long, key long, place int"), "suffixes")
    order = ["seed", "tail", "key", "place"]
    array = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    matches = written(array.select("seed", "key", "place").mapInArrow(_matches, "key long, place int"), "matches")
    dropped(suffixes)
    places = matches.groupBy("key").agg(F.collect_set("place").alias("places"))
    fetched = raw.select("text").mapInArrow(_fetched, "key long, text binary").join(places, "key")
    found = written(fetched.mapInArrow(_extended, "window long, key long, at int"), "windows")
    dropped(matches)
    order = ["window", "key", "at"]
    array = found.repartitionByRange(*order).sortWithinPartitions(*order)
    again = written(array.mapInArrow(_repeated, "window long, key long, at int, lo long, hi long"), "again")
    dropped(found)
    # a run in several tasks is repeated if its parts hold two texts; two rows for each task at most, besides long runs
    both = again.where("key is null").groupBy("window").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).where("l < h")
    open_ = again.where("key is not null and lo is not null").join(both, "window", "left_semi")
    places = again.where("key is not null and lo is null").unionByName(open_).groupBy("key").agg(F.sort_array(F.collect_set("at")).alias("ats"))
    per = texts.groupBy("key").agg(F.count("*").alias("copies"))
    known = per.where("copies > 1").join(places, "key", "full").select("key", "copies", "ats")
    out = texts.join(known, "key", "left")
    # starts of windows in order; one more than 50 words after the last begins a new span
    begins = "filter(ats, (x, i) -> i = 0 or x - ats[i - 1] > {0})"
    ends = "filter(ats, (x, i) -> i = size(ats) - 1 or ats[i + 1] - x > {0})"
    merged = F.expr(f"zip_with({begins}, {ends}, (s, e) -> named_struct('s', s, 'e', e + {{0}}))".format(LEAST))
    whole = F.expr(f"copies > 1 and n_words >= {LEAST}")
    spans = F.when(whole, F.expr("array(named_struct('s', 0, 'e', cast(n_words as int)))")).when(F.col("ats").isNotNull(), merged)
    spans = F.coalesce(spans, F.expr("cast(array() as array<struct<s:int,e:int>>)"))
    out = out.select("doc_id", "n_words", spans.alias("sp"))
    return out.select(
        "doc_id",
        "n_words",
        F.expr("aggregate(sp, 0L, (a, x) -> a + x.e - x.s)").alias("n_repeated"),
        F.expr("concat_ws(',', transform(sp, x -> concat(x.s, ':', x.e)))").alias("spans"),
    )
