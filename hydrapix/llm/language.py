"""Language identification by word-first backoff.

Known words score by their log frequency in each language. A word that the table lacks is scored by its longest
known character n-grams: five letters first, then progressively shorter ones. The model is fitted on a bounded
sample of labelled training rows (about `rows` rows, `room` characters together, no text of over a twentieth of these);
its tables hold all words and n-grams of these, so those bounds are the only ones. Every whole text is scored. A word is a run of letters (Unicode category L).

Cases: null texts and texts without a letter are `und` with score 0; rows whose lang or doc_id is null teach
nothing and are predicted like others; ties go to the language first by code point; repeated rows are returned
each; if nothing can be learned all is `und`; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, dropped, pieces, split_rule, written

WORDS = re.compile(r"[^\W\d_]+")
LETTERS = regex.compile(r"\p{L}+")
LONGEST = 5


def words_of(text: str | None) -> list[str]:
    """Runs of letters. The fast pattern also takes number signs such as a half or a circled two; where it has found
    one, the exact pattern is used."""
    if not text:
        return []
    low = text.lower()
    words = WORDS.findall(low)
    return words if not words or "".join(words).isalpha() else LETTERS.findall(low)


def grams(word: str, n: int) -> list[str]:
    w = f"<{word}>"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def _counted(batches: Iterator) -> Iterator:
    seen: Counter = Counter()

    def flush():
        if seen:
            langs, words = zip(*seen, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words), pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])
        seen.clear()

    for batch in pieces(batches):
        for lang, text in zip(*columns_of(batch, "lang", "text"), strict=True):
            seen.update((lang, w) for w in words_of(text))
        if len(seen) > 1 << 18:
            yield from flush()
    yield from flush()


def _grams(batches: Iterator) -> Iterator:
    for batch in pieces(batches, 4096):
        seen: Counter = Counter()
        for lang, word, n in zip(*columns_of(batch, "lang", "word", "n"), strict=True):
            for k in range(1, LONGEST + 1):
                for g in grams(word, k):
                    seen[lang, g] += n
        langs, words = zip(*seen, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words), pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])


class Table:
    """Log frequencies by language: a key's row in one matrix."""

    def __init__(self, counts: dict[str, dict], langs: list[str], totals: dict[str, int], a: float = 0.5):
        self.at = {k: i for i, k in enumerate(counts)}
        rows = np.array([[c.get(x, 0) for x in langs] for c in counts.values()], np.float64).reshape(-1, len(langs))
        size = np.log(np.array([totals.get(x, 0) + a * len(counts) + 1 for x in langs]))
        self.rows = (np.log(rows + a) - size).astype(np.float32)

    def get(self, key: str) -> np.ndarray | None:
        i = self.at.get(key)
        return None if i is None else self.rows[i]


class Model:
    """Word table first, then tables of n-grams from the longest to single letters."""

    def __init__(self, langs: list[str], words: dict[str, dict], grams: dict[str, dict], totals: dict[str, int], prior: np.ndarray):
        self.langs, self.prior = langs, prior
        self.words, self.grams = Table(words, langs, totals), {}
        for n in range(1, LONGEST + 1):
            own = {g: c for g, c in grams.items() if len(g) == n}
            self.grams[n] = Table(own, langs, {x: sum(c.get(x, 0) for c in own.values()) for x in langs})

    def of(self, word: str) -> np.ndarray:
        got = self.words.get(word)
        if got is not None:
            return got
        for n in range(LONGEST, 0, -1):
            known = [x for g in grams(word, n) if (x := self.grams[n].get(g)) is not None]
            if known:
                return np.sum(known, 0) / n
        return np.zeros(len(self.langs), np.float32)


class Rows(dict):
    """Word to its row of a growing matrix; emptied when full."""

    def __init__(self, model: Model, most: int = 1 << 18):
        self.model, self.at, self.matrix = model, 0, np.zeros((most, len(model.langs)), np.float32)

    def __missing__(self, word: str) -> int:
        i = self[word] = self.at
        self.matrix[i] = self.model.of(word)
        self.at += 1
        return i

    def total(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(self.model.langs))
        for i in range(0, len(words), 1 << 16):
            if self.at + (1 << 16) > len(self.matrix):
                self.clear()
                self.at = 0
            part = words[i : i + (1 << 16)]
            out += self.matrix[np.fromiter(map(self.__getitem__, part), np.int64, len(part))].sum(0, dtype=np.float64)
        return out


def fit(docs: DataFrame, rows: int = 8_000, room: int = 64_000_000) -> Model | None:
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~split_rule("doc_id", 3, 1))
    per = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not per:
        return None
    # a threshold for each language, so that rare ones are seen too
    share = {x: min(1.0, max(rows / sum(per.values()), rows / (4 * len(per) * n))) for x, n in per.items()}
    bound = F.element_at(F.create_map(*[F.lit(v) for x, s in share.items() for v in (x, int(s * (1 << 30)))]), F.col("lang"))
    train = train.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 30)) < bound)
    sample = written(train.select("lang", "text", F.xxhash64("doc_id", F.lit(37)).alias("h"), F.length("text").alias("size")), "sample")
    upto = Window.orderBy("h", "size").rowsBetween(Window.unboundedPreceding, 0)  # over the hashes and sizes of the bounded sample
    fits = sample.where(F.col("size") <= room // 20).select("h", "size").withColumn("all", F.sum("size").over(upto))
    last = fits.where(F.col("all") <= room).agg(F.max(F.struct("h", "size")).alias("m")).first()["m"]
    if last is None:
        return None
    train = sample.where((F.col("size") <= room // 20) & (F.struct("h", "size") <= F.struct(F.lit(last["h"]), F.lit(last["size"]))))
    counts = train.select("lang", "text").mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = written(counts, "counts")

    def table(rows: DataFrame) -> dict[str, dict]:
        out: dict[str, dict] = {}
        got = rows.select("word", "lang", "n").toArrow().sort_by([("word", "ascending"), ("lang", "ascending")])  # of the bounded sample
        for word, lang, n in zip(*(got.column(i).to_pylist() for i in range(3)), strict=True):
            out.setdefault(word, {})[lang] = n
        return out

    known = table(counts)
    small = counts.mapInArrow(_grams, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(per)
    prior = np.log(np.array([per[x] for x in langs], float) / sum(per.values()))
    model = Model(langs, known, table(small), totals, prior)
    dropped(counts)
    dropped(sample)
    return model


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, **options))

    def run(batches: Iterator) -> Iterator:
        model = held.value
        rows = Rows(model) if model else None
        for batch in pieces(batches):
            ids, texts = columns_of(batch, "doc_id", "text")
            langs, scores = [], []
            for text in texts:
                words = words_of(text)
                if not words or model is None:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                x = rows.total(words) + model.prior
                best = int(np.argmax(x))
                langs.append(model.langs[best])
                scores.append(float(1 / np.exp(x - x[best]).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", split_rule("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")
