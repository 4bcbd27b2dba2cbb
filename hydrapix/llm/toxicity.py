"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

Folding lower-cases, maps look-alike letters of other scripts to Latin ones and digits or signs that stand for
letters to these. The lexicon is learned from a bounded sample of labelled training rows (`rows`): words whose
share of toxic documents is surely high (Wilson bound), weighted by log odds. Exception phrases are word pairs
with a lexicon word that occur mostly in documents labelled clean; others can be given. A document's hits,
outside exceptions, are summed, set in relation to its length, and calibrated to a probability.

Every whole text is scored. Cases: null and empty texts score as texts without a hit; a document without a
label or with a null id is scored like any other; repeated rows are returned each; with no labels at all every
score is 0; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, dropped, labelled_sample, pieces, split_rule, written

#: Look-alikes and substitutions (fixed values).
FOLD = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "т": "t", "м": "m", "к": "k", "н": "h", "в": "b",
    "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v", "κ": "k",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "|": "i", "!": "i",
}
FULLWIDTH = {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
TABLE = str.maketrans(FOLD | FULLWIDTH)
WORDS = re.compile(r"[^\W\d_]+")


AFTER = re.compile(r" [^\W\d_]+")


def word_before(s: str, at: int) -> str:
    """The word that ends a space before `at`, whole; empty if there is none."""
    end = at - 1
    start = end
    if end > 0 and s[end] == " ":
        while start and WORDS.match(s, start - 1, start):
            start -= 1
    return s[start:end] if end > 0 else ""


def folded(text: bytes | None) -> str:
    """The folded text. A '!' or '|' after a word is no letter, so those signs fold inside words only."""
    if not text:
        return ""
    s = text.decode("utf-8", "replace").lower()
    s = re.sub(r"[!|]+(?!\w)", " ", s)
    return s.translate(TABLE)


def _word_rows(batches: Iterator) -> Iterator:
    for batch in pieces(batches):
        words, labels = [], []
        for text, y in zip(*columns_of(batch, "text", "y"), strict=True):
            own = set(WORDS.findall(folded(text)))
            words += own
            labels += [y] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.int32())], names=["word", "y"])


def automaton(weights: dict[str, float], exceptions: set[str]):
    out = ahocorasick.Automaton()
    for w, x in weights.items():
        out.add_word(w, (w, x))
    for p in exceptions:
        out.add_word(p, (p, 0.0))
    if len(out):
        out.make_automaton()
    return out


def hits(auto, text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, word, weight) of whole-word matches outside exception phrases."""
    if not len(auto):
        return []
    found = []
    for last, (w, x) in auto.iter(text):
        a, b = last - len(w) + 1, last + 1
        if (a and text[a - 1].isalpha()) or (b < len(text) and text[b].isalpha()):
            continue
        found.append((a, b, w, x))
    free = sorted((a, b) for a, b, _, x in found if x == 0.0)
    starts, reach = [a for a, _ in free], list(accumulate((b for _, b in free), max))

    def inside(a: int, b: int) -> bool:
        """Whether an exception that starts at a or before reaches b."""
        k = bisect_right(starts, a)
        return k > 0 and reach[k - 1] >= b

    return [h for h in found if h[3] > 0 and not inside(h[0], h[1])]


def _doc_features(auto):
    def run(batches: Iterator) -> Iterator:
        for batch in pieces(batches):
            ws, ns, ys, pairs = [], [], [], []
            for text, y in zip(*columns_of(batch, "text", "y"), strict=True):
                s = folded(text)
                found = hits(auto, s)
                ws.append(sum(h[3] for h in found))
                ns.append(len(s.split()))
                ys.append(y)
                near = set()
                for a, b, w, _ in found:
                    if before := word_before(s, a):
                        near.add(f"{before} {w}")
                    if m := AFTER.match(s, b):
                        near.add(w + m[0])
                pairs.append(sorted(near))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ws, pa.float64()), pa.array(ns, pa.int64()), pa.array(ys, pa.int32()), pa.array(pairs, pa.list_(pa.string()))], names=["w", "n", "y", "pairs"]
            )

    return run


def design(w: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Features of the calibration: the weight of the hits, for each 100 words and in all."""
    w, n = np.asarray(w, float), np.maximum(np.asarray(n, float), 1)
    return np.stack([np.ones_like(w), np.log1p(100 * w / n), np.log1p(w)], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps; ridge on all but the first coefficient."""
    b = np.zeros(x.shape[1])
    pen = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b = b + np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + pen, x.T @ (y - p) - pen @ b)
    return b


def fit(docs: DataFrame, labels: DataFrame, rows: int = 12_000, surely: float = 0.55, exceptions: tuple[str, ...] = ()) -> dict:
    """The lexicon, exceptions and calibration, from a sample of about `rows` labelled rows that is written once."""
    train = written(labelled_sample(docs, labels, "toxic", 3, 1, rows).select("text", "y"), "train")
    model = _fitted(train, surely, exceptions)
    dropped(train)
    return model


def _fitted(train: DataFrame, surely: float, exceptions: tuple[str, ...]) -> dict:
    counts = train.mapInArrow(_word_rows, "word string, y int").groupBy("word").agg(F.count("*").alias("n"), F.sum("y").alias("t"))
    total = train.agg(F.count("*").alias("n"), F.sum("y").alias("t")).first()
    size, toxic = total["n"], total["t"] or 0
    model = {"weights": {}, "exceptions": set(exceptions), "beta": np.array([-30.0, 0, 0])}
    if not toxic or toxic == size:
        return model
    z = 1.96
    share = F.col("t") / F.col("n")
    wilson = (share + z * z / (2 * F.col("n")) - z * F.sqrt(share * (1 - share) / F.col("n") + z * z / (4 * F.col("n") * F.col("n")))) / (1 + z * z / F.col("n"))
    # a word makes a lexicon entry if its documents are surely toxic, well beyond the base rate
    chosen = counts.where((F.col("t") >= 4) & (F.length("word") >= 3)).withColumn("sure", wilson).where(F.col("sure") >= max(surely, min(0.9, 2 * toxic / size)))
    for r in chosen.orderBy(F.desc("sure"), "word").collect():
        odds = math.log((r["t"] + 0.5) / (toxic - r["t"] + 0.5)) - math.log((r["n"] - r["t"] + 0.5) / (size - toxic - r["n"] + r["t"] + 0.5))
        if odds > 0:
            model["weights"][r["word"]] = odds
    seen = train.mapInArrow(_doc_features(automaton(model["weights"], model["exceptions"])), "w double, n long, y int, pairs array<string>")
    phrases = seen.select("y", F.explode("pairs").alias("p")).groupBy("p").agg(F.count("*").alias("n"), F.sum("y").alias("t"))
    for r in phrases.where("n >= 8 and t <= 0.1 * n").orderBy(F.desc("n"), "p").collect():
        model["exceptions"].add(r["p"])
    seen = train.mapInArrow(_doc_features(automaton(model["weights"], model["exceptions"])), "w double, n long, y int, pairs array<string>")
    got = seen.select("w", "n", "y").toPandas()  # as many rows as the bounded sample has
    model["beta"] = logistic(design(got["w"], got["n"]), got["y"].to_numpy(float))
    return model


def scored(texts: list, auto, beta: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Scores and hits of some texts."""
    ws, ns, ks = [], [], []
    for text in texts:
        s = folded(text)
        found = hits(auto, s)
        ws.append(sum(h[3] for h in found))
        ks.append(len(found))
        ns.append(len(s.split()))
    return 1 / (1 + np.exp(-np.clip(design(ws, ns) @ beta, -30, 30))), ks


def clean(docs: DataFrame, model: dict, threshold: float = 0.7) -> DataFrame:
    """The rows of docs that do not score as toxic, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator) -> Iterator:
        m = held.value
        auto = automaton(m["weights"], m["exceptions"])
        for batch in pieces(batches):
            texts = [t and t.encode() for t in batch.column(at).to_pylist()]
            keep = scored(texts, auto, m["beta"])[0] < threshold
            yield batch.filter(pa.array(keep, pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # mapInArrow reads no names with dots
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, n_hits of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        m = held.value
        auto = automaton(m["weights"], m["exceptions"])
        for batch in pieces(batches):
            ids, texts = columns_of(batch, "doc_id", "text")
            p, ks = scored(texts, auto, m["beta"])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(p, pa.float64()), pa.array(ks, pa.int64())], names=["doc_id", "score", "n_hits"])

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, score double, n_hits long")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits."""
    out = score(docs, fit(docs, labels, **options))
    return out.select(
        "doc_id", split_rule("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits"
    )
