"""Spelling variants: words one edit apart, by an even-partition pigeonhole join, and the frequent form that each stands for.

A word of l letters is indexed under its first l div 2 letters and under the rest. If another word of equal length, or
one longer, is one edit away, one of the two segments stands unchanged in it: at the same place, or the second one a
place further in a longer word. So each word probes the segments of its own length and those of the length below, and
what shares a segment is verified. A pair that shares both segments (an inserted letter between them) counts through
the first one only. The list of a segment that holds more than `crowd` words is not compared pair by pair: the edit
lies in the other segment, so these words are keyed once more for each of its places, with that letter masked or left
out; what meets there is one edit apart. No list is cut, and candidates stay in proportion to words and links.

Cases: null and empty texts have no words; a null doc_id counts as empty text in `<doc_id>:<word>`; repeated rows are
counted each; a text of any length is read whole; of near words with one n the smallest is the form; a table without
words gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, fold_ascii, written

LEAST = 7
KEY = ["size", "part", "segment"]


def corpus_words(docs: DataFrame, every: int = 31, least: int = LEAST) -> DataFrame:
    """(word, n) of words with at least `least` code points and two occurrences. Of a run whose crc32 with the doc_id is
    divisible by `every` one code point is missing."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{least},}})"), F.lit(1))).alias("run"))
    runs = runs.select("doc_id", fold_ascii(F.col("run")).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    runs = runs.select("run", h.alias("h"))
    cut = F.expr("concat(left(run, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")
    words = runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


def _segments(word: Column, size: Column, shift: int) -> Column:
    """The two segments of words of `size` letters, as they stand in a word that is longer by `shift`."""
    half = F.floor(size / 2).cast("int")
    first = F.struct(size.alias("size"), F.lit(1).alias("part"), F.substring(word, F.lit(1), half).alias("segment"))
    second = F.struct(size.alias("size"), F.lit(2).alias("part"), F.substring(word, half + 1 + shift, size).alias("segment"))
    return F.array(first, second)


def near_words(words: DataFrame, crowd: int = 32) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of the distinct words (word, n) that are one edit apart."""
    size = F.length("word")
    rows = [words.select("word", "n", F.lit(shift).alias("shift"), F.explode(_segments(F.col("word"), size - shift, shift)).alias("k")) for shift in (0, 1)]
    rows = rows[0].unionByName(rows[1]).select("word", "n", "shift", "k.*")
    lists = rows.where("shift = 0").groupBy(*KEY).agg(F.count("*").alias("listed"))
    marked = written(rows.join(lists, KEY).withColumn("crowded", F.col("listed") > crowd), "segments")

    few = marked.where("not crowded")
    index = few.where("shift = 0").select(*KEY, F.col("word").alias("a"), F.col("n").alias("an"))
    probe = few.select(*KEY, "shift", F.col("word").alias("b"), F.col("n").alias("bn"))
    first_too = "part = 2 and shift = 1 and left(a, size div 2) = left(b, size div 2)"
    found = index.join(probe, KEY).where(f"(shift = 1 or a < b) and not ({first_too})")
    found = found.where(F.levenshtein("a", "b", 1) == 1).select("a", "an", "b", "bn")

    many = marked.where("crowded")  # the edit lies in the segment that the list does not share
    low, high = F.expr("if(part = 1, size div 2, 0)"), F.expr("if(part = 1, size, size div 2)")
    places = F.sequence(low.cast("int"), (high - 1 + F.col("shift")).cast("int"))
    masked = many.where("shift = 0").select("word", "n", F.explode(F.transform(places, lambda j: F.concat(F.expr("word").substr(F.lit(1), j), F.lit("*"), F.expr("word").substr(j + 2, F.length("word"))))).alias("key"))
    same = masked.select("key", F.col("word").alias("a"), F.col("n").alias("an")).join(masked.select("key", F.col("word").alias("b"), F.col("n").alias("bn")), "key").where("a < b")
    without = F.array_distinct(F.transform(places, lambda j: F.concat(F.expr("word").substr(F.lit(1), j), F.expr("word").substr(j + 2, F.length("word")))))
    longer = many.where("shift = 1").select("size", "part", "shift", F.col("word").alias("b"), F.col("n").alias("bn"), F.explode(without).alias("a"))
    longer = longer.join(words.select(F.col("word").alias("a"), F.col("n").alias("an")), "a").where(f"not ({first_too})")
    pairs = written(found.unionByName(same.select("a", "an", "b", "bn")).unionByName(longer.select("a", "an", "b", "bn")), "near")
    dropped(marked)
    return pairs.selectExpr("stack(2, a, an, b, bn, b, bn, a, an) as (word, n, other, other_n)")


def variants(docs: DataFrame, times: int = 10, crowd: int = 32, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of docs. A form has at least `times` the word's n, so a chain of
    forms has few links; its end is found by doubling the way that each word looks ahead."""
    words = written(corpus_words(docs, **options), "words")
    near = near_words(words, crowd).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w"))).alias("best"))
    enough = -F.col("best.m") >= times * F.col("n")
    out = words.join(near, "word", "left").select(
        "word", F.when(enough, F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, -F.col("best.m")).alias("form_n")
    )
    out = written(out, "forms")
    dropped(words)
    roots = out.where("form is not null").select("word", F.col("form").alias("root"))
    ends = out.agg(F.min("n").alias("low"), F.max("n").alias("high")).first()
    links, ahead = 0, 1
    while ends["low"] and ends["low"] * times ** (links + 1) <= ends["high"]:
        links += 1
    while ahead < links:
        jump = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        before, roots = roots, written(roots.join(jump, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        dropped(before)
        ahead *= 2
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE_SQL = """
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
coded AS (SELECT run, hex(encode(id || ':' || run)) AS x FROM runs WHERE length(run) >= 7),
bytes AS (SELECT run, list_transform(range(length(x) // 2), lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT)) AS b FROM coded),
hashed AS (SELECT run, xor(list_reduce(list_prepend(4294967295, b), lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8)), 4294967295) AS h FROM bytes, crc),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
places AS (SELECT word, n, unnest(range(length(word))) AS j FROM words),
masked AS (SELECT word, n, left(word, j) || '*' || substr(word, j + 2) AS k FROM places),
less AS (SELECT DISTINCT word, n, left(word, j) || substr(word, j + 2) AS k FROM places),
pairs AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM masked a JOIN masked b ON a.k = b.k AND a.word <> b.word
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.k = b.word
  UNION ALL SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.k = b.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r FROM pairs),
forms AS (SELECT w.word, w.n, coalesce(p.n_near, 0) AS n_near, CASE WHEN p.other_n >= 10 * w.n THEN p.other END AS form, CASE WHEN p.other_n >= 10 * w.n THEN p.other_n END AS form_n
  FROM words w LEFT JOIN ranked p ON p.word = w.word AND p.r = 1),
way AS (SELECT word, word AS root, form AS next FROM forms UNION ALL SELECT y.word, f.word, f.form FROM way y JOIN forms f ON f.word = y.next)
SELECT f.word, f.form, y.root, CAST(f.n AS BIGINT) AS n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n FROM forms f JOIN way y ON y.word = f.word AND y.next IS NULL
"""
