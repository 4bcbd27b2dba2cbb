"""Collocations: phrases of two or three words by how often they stand together, for each language.

1. Words are counted exactly. A sketch of 2^48 hashed cells (`bits`), of which only touched ones exist, counts pairs of words, then
   triples whose two pairs may be frequent. A cell's count is an upper bound of each phrase in it.
2. Phrases whose cell reaches `least` are candidates. With a <= bound and the exact counts of their outer words, no
   candidate's score can pass 1000000 a^2 / (l r) for pairs, 1000000 a / max(l, r) for triples.
3. The candidates with the best bounds, their parts, and the triples around them are compiled into pyahocorasick automata
   over words between delimiters. Tasks scan their texts and count all matches, overlapping ones too; counts are summed.
4. Once `top` phrases of a language are known to stay, only candidates whose bound reaches the last of these can come
   before it: they are scanned too, the others need not be. Without so many, all of a language's candidates are.
5. Exact counts decide the threshold, the cuts, what a longer candidate swallows, and the order.

An automaton holds at most `most` phrases or `room` characters (or one phrase); more are scanned by several, one after
the other. The filters of frequent cells that tasks get are bitmaps of 16 bits for each cell, 2^28 at most: marks that
coincide let more phrases through, which a join with the cells themselves takes out again. A task gives a phrase out once
for as long as it remembers the phrase's 64-bit number.

Cases: null text is empty, null lang is `und`; texts and words of any length are read whole; repeated rows count each;
null or repeated ids do not matter; equal phrases have one row; a table without words gives an empty result; extra columns
are not read. Products are decimals of 38 digits, exact for counts up to 10^16.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, dropped, mixed, pieces, written

#: Bytes that end a piece become ".", the tab a space; A-Z are lower-cased. All are ASCII, so UTF-8 stays whole.
TABLE = bytes(46 if chr(b) in ".,;:!?\n\v\f\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
HELD, WORDS_HELD, REMEMBERED = 1 << 21, 1 << 19, 22


def tokens(text: bytes | None) -> list[bytes]:
    """The words of a text in order, and "." between pieces."""
    return text.translate(TABLE).replace(b".", b" . ").split() if text else []


class Ids(dict):
    """Word to a 64-bit number, never 0 but for what is no word; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        h = self[word] = 0 if word == b"." else xxhash.xxh3_64_intdigest(word) | 1
        return h


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")).where("text is not null")


def _words(batches: Iterator) -> Iterator:
    """(lang, word, n): a task's counts, given out when there are many."""
    held: dict[str, Counter] = {}

    def out():
        for lang, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()), pa.array(own.values(), pa.int64())], names=["lang", "word", "n"])
        held.clear()

    for batch in pieces(batches):
        for lang, text in zip(*columns_of(batch, "lang", "text"), strict=True):
            own = held.setdefault(lang, Counter())
            own.update(tokens(text))
            own.pop(b".", None)
        if sum(map(len, held.values())) > WORDS_HELD:
            yield from out()
    yield from out()


def _hashes(ids: np.ndarray, langs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number of the k words from each place on, and whether these are words of one piece."""
    n = max(len(ids) - k + 1, 0)
    acc, inside = langs[:n] ^ np.uint64(k), np.ones(n, bool)
    for i in range(k):
        own = ids[i : i + n]
        acc = mixed(acc * np.uint64(0xD6E8FEB86659FD93) + own)
        inside &= own != 0
    return acc, inside


def _numbered(ids: Ids, batch) -> tuple[list[bytes], np.ndarray, np.ndarray, list[str]]:
    """All words of a batch with "." between texts, their numbers, and the number and name of the language at each place."""
    words, langs, sizes = [], [], []
    for lang, text in zip(*columns_of(batch, "lang", "text"), strict=True):
        own = tokens(text)
        words += own
        words.append(b".")
        langs.append(lang)
        sizes.append(len(own) + 1)
    seeds = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], np.uint64)
    return words, np.fromiter(map(ids.__getitem__, words), np.uint64, len(words)), np.repeat(seeds, sizes), np.repeat(np.array(langs, object), sizes)


def _has(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    at = cells & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _sketch(k: int, bits: int, pairs=None):
    """(cell, n) of the phrases of k words; of triples those whose pairs both may be frequent."""

    def run(batches: Iterator) -> Iterator:
        ids, held, size, mask = Ids(), [], 0, np.uint64((1 << bits) - 1)

        def out():
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(cells), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(cells[at : at + (1 << 16)].astype(np.int64)), pa.array(n[at : at + (1 << 16)])], names=["cell", "n"])

        for batch in pieces(batches):
            _, own, langs, _ = _numbered(ids, batch)
            cells, inside = _hashes(own, langs, k)
            if pairs is not None and len(cells):
                two = _has(pairs.value, _hashes(own, langs, 2)[0] & mask)
                inside &= two[:-1] & two[1:]
            held.append((cells & mask)[inside])
            size += len(held[-1])
            if size > HELD:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    return run


def _bitmap(cells: DataFrame) -> np.ndarray:
    bits = min(28, max(18, (16 * cells.count()).bit_length()))
    at = F.col("cell") % (1 << bits)
    marks = cells.select(F.shiftright(at, 15).alias("k"), (at % (1 << 15)).cast("long").alias("bit"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in marks.groupBy("k").agg(F.bitmap_construct_agg("bit").alias("m")).toLocalIterator():
        out[r["k"] << 12 : (r["k"] + 1) << 12] = np.frombuffer(r["m"], np.uint8)
    return out


def _phrases(two, three, bits: int):
    """(cell, lang, phrase): phrases that may be frequent, each once in a task as far as it remembers: the last one for each
    of 2^22 places of their 64-bit numbers."""

    def run(batches: Iterator) -> Iterator:
        ids, mask = Ids(), np.uint64((1 << bits) - 1)
        before = {k: np.zeros(1 << REMEMBERED, np.uint64) for k in (2, 3)}
        for batch in pieces(batches):
            words, own, seeds, langs = _numbered(ids, batch)
            for k, marks in ((2, two.value), (3, three.value)):
                h, inside = _hashes(own, seeds, k)
                at = np.flatnonzero(inside & _has(marks, h & mask))
                slot = h[at] >> np.uint64(64 - REMEMBERED)
                new = before[k][slot] != h[at]
                before[k][slot] = h[at]
                at = at[new]
                at = at[np.unique(h[at], return_index=True)[1]]
                phrases = [b" ".join(words[i : i + k]) for i in at.tolist()]
                cells = 2 * (h[at] & mask) + np.uint64(k - 2)
                if phrases:
                    yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), pa.array(langs[at], pa.string()), pa.array(phrases, pa.binary())], names=["cell", "lang", "phrase"])

    return run


def _matches(held):
    """(lang, phrase, n): all matches of the automaton's phrases, overlapping ones too, in a task's texts."""

    def run(batches: Iterator) -> Iterator:
        phrases = held.value
        auto = ahocorasick.Automaton()
        for i, p in enumerate(phrases):
            auto.add_word(f" {p.decode('latin-1')} ", i)
        auto.make_automaton()
        counts: dict[str, Counter] = {}
        for batch in pieces(batches):
            for lang, text in zip(*columns_of(batch, "lang", "text"), strict=True):
                line = b" ".join([b"", *tokens(text), b""]).decode("latin-1")
                counts.setdefault(lang, Counter()).update(map(itemgetter(1), auto.iter(line)))
        for lang, own in counts.items():
            if own:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array([phrases[i] for i in own], pa.binary()), pa.array(own.values(), pa.int64())], names=["lang", "phrase", "n"])

    return run


def matched(texts: DataFrame, wanted: DataFrame, most: int, room: int) -> DataFrame:
    """(lang, phrase, n) of the wanted (lang, phrase), counted by automata; a table."""
    spark = texts.sparkSession
    wanted = written(wanted.select("lang", "phrase").distinct(), "wanted")
    size = wanted.select("phrase").distinct().agg(F.count("*").alias("n"), F.sum(F.length("phrase") + 2).alias("c")).first()
    shards = max(1, math.ceil(size["n"] / most), math.ceil((size["c"] or 0) / room))
    parts = []
    for k in range(shards if size["n"] else 0):
        own = wanted.select("phrase").distinct().where(F.pmod(F.xxhash64("phrase"), F.lit(shards)) == k)
        held = spark.sparkContext.broadcast([bytes(r["phrase"]) for r in own.toLocalIterator()])
        parts.append(written(texts.mapInArrow(_matches(held), "lang string, phrase binary, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "matches"))
    found = spark.createDataFrame([], "lang string, phrase binary, n long")
    for p in parts:
        found = found.unionByName(p)
    out = written(wanted.join(found, ["lang", "phrase"], "left").select("lang", "phrase", F.coalesce("n", F.lit(0).cast("long")).alias("n")), "counted")
    for p in [*parts, wanted]:
        dropped(p)
    return out


def _whole(c: str) -> str:
    return f"cast({c} as decimal(19, 0))"


def _score(a: str, le: str, r: str) -> Column:
    return F.expr(f"(cast(1000000 as decimal(7, 0)) * {_whole(a)} * {_whole(a)}) div ({_whole(le)} * {_whole(r)})").cast("long")


def _parts(df: DataFrame) -> DataFrame:
    """w1, w2, w3 (null for pairs), head (w1 w2) and tail (w2 w3) of the phrases of df, as binary."""
    s = F.split(F.col("phrase").cast("string"), " ")
    word = lambda i: F.get(s, F.lit(i)).cast("binary")
    three = F.size(s) == 3
    both = lambda i: F.when(three, F.concat_ws(" ", F.get(s, F.lit(i)), F.get(s, F.lit(i + 1))).cast("binary"))
    return df.withColumns({"w1": word(0), "w2": word(1), "w3": word(2), "head": both(0), "tail": both(1)})


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, trial: int = 3, most: int = 200_000, room: int = 8 << 20, bits: int = 48) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language."""
    spark = docs.sparkSession
    texts = _texts(docs)
    words = written(texts.mapInArrow(_words, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))

    def frequent(k: int, pairs=None) -> DataFrame:
        found = texts.mapInArrow(_sketch(k, bits, pairs), "cell long, n long")
        return written(found.groupBy("cell").agg(F.sum("n").alias("bound")).where(F.col("bound") >= least), f"cells-{k}")

    two = frequent(2)
    marks = spark.sparkContext.broadcast(_bitmap(two))
    three = frequent(3, marks)
    found = texts.mapInArrow(_phrases(marks, spark.sparkContext.broadcast(_bitmap(three)), bits), "cell long, lang string, phrase binary").distinct()
    cells = two.withColumn("cell", 2 * F.col("cell")).unionByName(three.withColumn("cell", 2 * F.col("cell") + 1))  # pairs, triples
    found = _parts(found.join(cells, "cell"))
    last = F.coalesce("w3", "w2")
    ends = [words.where(F.col("n") >= least).select("lang", F.col("word").alias(k), F.col("n").alias(f"n_{k}")) for k in ("w1", "last")]
    found = found.withColumn("last", last).join(ends[0], ["lang", "w1"]).join(ends[1], ["lang", "last"])
    a = F.least("bound", "n_w1", "n_last")
    pair = a.cast("double") * a / (F.col("n_w1").cast("double") * F.col("n_last"))
    best = F.when(F.col("w3").isNull(), pair).otherwise(a / F.greatest("n_w1", "n_last").cast("double")) * 1e6
    candidates = found.select("lang", "phrase", "head", "tail", a.alias("most"), (best * (1 + 1e-9) + 1e-6).alias("best"))
    candidates = written(candidates, "candidates")
    for t in (two, three):
        dropped(t)

    counted = spark.createDataFrame([], "lang string, phrase binary, n long")
    kept, take = None, trial * top
    first = Window.partitionBy("lang").orderBy(F.desc("best"), F.desc("most"), "phrase")
    chosen = candidates.withColumn("k", F.row_number().over(first)).where(F.col("k") <= take).select("lang", "phrase")
    while True:
        chosen = written(chosen, "chosen")
        before = counted
        counted = _counted(texts, candidates, chosen, counted, most, room)
        dropped(before)
        kept = _kept(candidates, chosen, counted, words, least, top)
        # the last place of each language that has all its places; anything is before it where it has not
        bar = kept.where(F.col("rank") == top).select("lang", F.col("score").alias("s"), F.col("a").alias("m"))
        after = F.col("s").isNull() | (F.floor("best") > F.col("s")) | ((F.floor("best") == F.col("s")) & (F.col("most") >= F.col("m")))
        more = candidates.join(F.broadcast(bar), "lang", "left") if bar.count() < 10_000 else candidates.join(bar, "lang", "left")
        more = written(more.where(after).select("lang", "phrase").join(chosen, ["lang", "phrase"], "left_anti"), "more")
        if more.isEmpty():
            break
        before, chosen = chosen, chosen.unionByName(more)
    out = kept.join(sizes, "lang").select("lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")
    out = written(out, "collocations")
    for t in (candidates, chosen, counted, more, words):
        dropped(t)
    return out


def _counted(texts: DataFrame, candidates: DataFrame, chosen: DataFrame, counted: DataFrame, most: int, room: int) -> DataFrame:
    """Exact counts of the chosen phrases, the pairs in them and the triples around them, beside what is counted."""
    around = [candidates.where(F.col(k).isNotNull()).join(chosen.select("lang", F.col("phrase").alias(k)), ["lang", k], "left_semi").select("lang", "phrase") for k in ("head", "tail")]
    wanted = chosen.unionByName(around[0]).unionByName(around[1])
    inner = _parts(wanted).where("head is not null")
    wanted = wanted.unionByName(inner.select("lang", F.col("head").alias("phrase"))).unionByName(inner.select("lang", F.col("tail").alias("phrase")))
    new = matched(texts, wanted.distinct().join(counted, ["lang", "phrase"], "left_anti"), most, room)
    out = written(counted.unionByName(new), "counts")
    dropped(new)
    return out


def _kept(candidates: DataFrame, chosen: DataFrame, counted: DataFrame, words: DataFrame, least: int, top: int) -> DataFrame:
    """The first `top` of the chosen phrases that are frequent and in no longer candidate that keeps half of them."""
    a = counted.withColumnRenamed("n", "a")
    rows = _parts(chosen.join(a, ["lang", "phrase"]).where(F.col("a") >= least))
    of = lambda k, table=counted: table.select("lang", F.col("phrase").alias(k), F.col("n").alias(f"n_{k}"))
    single = words.where(F.col("n") >= least).withColumnRenamed("word", "phrase")
    pairs = rows.where("w3 is null").join(of("w1", single), ["lang", "w1"]).join(of("w2", single), ["lang", "w2"])
    pairs = pairs.select("lang", "phrase", "a", F.col("n_w1").alias("l"), F.col("n_w2").alias("r"), _score("a", "n_w1", "n_w2").alias("score"))
    longer = _parts(a.where(F.col("a") >= least)).where("w3 is not null")
    longer = longer.select("lang", F.explode(F.array("head", "tail")).alias("phrase"), F.col("a").alias("f")).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    pairs = pairs.join(longer, ["lang", "phrase"], "left").where("f is null or 100 * cast(f as decimal(19, 0)) < 50 * cast(a as decimal(19, 0))").drop("f")
    triples = rows.where("w3 is not null")
    for k, table in (("w1", single), ("tail", counted), ("head", counted), ("w3", single)):
        triples = triples.join(of(k, table), ["lang", k])
    early, late = _score("a", "n_w1", "n_tail"), _score("a", "n_head", "n_w3")
    triples = triples.withColumns({"early": early, "late": late}).select(
        "lang", "phrase", "a", F.expr("if(early <= late, n_w1, n_head)").alias("l"), F.expr("if(early <= late, n_tail, n_w3)").alias("r"), F.least("early", "late").alias("score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return written(pairs.unionByName(triples).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long")), "kept")


ORACLE_SQL = """
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM texts),
sizes AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM words, (VALUES (1), (2), (3)) t(k)),
counts AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g),
candidates AS (SELECT * FROM counts WHERE k > 1 AND f >= 10),
split AS (SELECT lang, g, f AS a, cut, g[1:cut] AS g1, g[cut + 1:] AS g2 FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
cuts AS (SELECT c.lang, c.g, a, cut, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM split c JOIN counts x ON x.lang = c.lang AND x.g = g1 JOIN counts y ON y.lang = c.lang AND y.g = g2),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS o FROM cuts),
swallowed AS (SELECT lang, g, max(f) AS f FROM (SELECT lang, g[1:2] AS g, f FROM candidates WHERE k = 3 UNION ALL SELECT lang, g[2:3], f FROM candidates WHERE k = 3) GROUP BY lang, g),
kept AS (SELECT p.lang, array_to_string(p.g, ' ') AS phrase, a, l, r, score FROM lowest p LEFT JOIN swallowed s ON s.lang = p.lang AND s.g = p.g WHERE o = 1 AND (s.f IS NULL OR 100 * s.f < 50 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
