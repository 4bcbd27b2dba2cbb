"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words, all of them. Each passage is encoded (shares of kinds of
characters, repetition, hashed words, then a learned layer); gated attention weighs the passages, and the
weighted representation gives the document's score. Only document labels are used for training, in numpy, on a
bounded sample of labelled training rows (`rows` of them, `most` passages in all, documented parameters); every whole
text is scored.

Cases: null and empty texts are a bag of one empty passage; documents without a label are scored like others;
repeated rows are returned each; with no labels, or all alike, every score is that share of good ones (0.5 with
none); an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordIds, columns_of, gram_hashes, labelled_sample, pieces, split_rule, written

PASSAGE, HASHED = 64, 32
#: Kinds of bytes that a passage's shares are taken of (fixed values).
KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"!", b"|", b"%&*#$", b",", b".", b"\n", b"@<>{}[]=/\\_", b"\"'():;-?"]
KIND = np.full(256, len(KINDS) + 1, np.int64)
KIND[128:] = len(KINDS)
for _k, _chars in enumerate(KINDS):
    KIND[list(_chars)] = _k
WIDTH = len(KINDS) + 2 + 5 + HASHED


def passages(text: bytes | None, words: WordIds) -> np.ndarray:
    """Features of each passage of a whole text."""
    ids = words.of(text)
    n = len(ids)
    if not n:
        return np.zeros((1, WIDTH), np.float32)
    raw = np.frombuffer(text, np.uint8)
    solid = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    starts = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    first = np.arange(0, n, PASSAGE)
    k = len(first)
    which = np.arange(n) // PASSAGE
    begin = starts[first]
    begin[0] = 0
    size = np.diff(np.append(begin, len(raw)))
    held = np.diff(np.append(first, n))
    kinds = np.bincount(np.repeat(np.arange(k), size) * (len(KINDS) + 2) + KIND[raw], minlength=k * (len(KINDS) + 2)).reshape(k, -1)
    again = np.concatenate([[False], ids[1:] == ids[:-1]])
    pair = ids * np.uint64(0x9E3779B97F4A7C15) + which.astype(np.uint64)
    fresh = np.zeros(n, bool)
    fresh[np.unique(pair, return_index=True)[1]] = True
    g = gram_hashes(ids, 4)
    seen = np.ones(len(g), bool)
    seen[np.unique(g, return_index=True)[1]] = False
    seen = np.concatenate([seen, np.zeros(n - len(g), bool)])
    share = lambda x: np.add.reduceat(x.astype(np.float64), first) / held
    hashed = np.bincount(which * HASHED + ((ids >> np.uint64(7)) % np.uint64(HASHED)).astype(np.int64), minlength=k * HASHED).reshape(k, -1)
    return np.concatenate(
        [
            kinds / np.maximum(size, 1)[:, None],
            np.stack([np.log1p(size / held), share(again), share(fresh), share(seen), held / PASSAGE], 1),
            hashed / held[:, None],
        ],
        1,
    ).astype(np.float32)


class GatedMil:
    """Encoder, gated attention and classifier; trained with Adam on bags given as stacked rows and offsets."""

    def __init__(self, width: int, hidden: int = 16, gate: int = 8, seed: int = 7):
        r = np.random.default_rng(seed)
        init = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"W": init(width, hidden), "b": np.zeros(hidden), "V": init(hidden, gate), "U": init(hidden, gate), "w": init(gate), "c": init(hidden), "d": np.zeros(1)}
        self.mean, self.std = np.zeros(width), np.ones(width)

    def forward(self, x: np.ndarray, at: np.ndarray) -> tuple:
        p = self.p
        bag = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(x))))
        x = (x - self.mean) / self.std
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (v * u) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, at)[bag])
        a = e / np.add.reduceat(e, at)[bag]
        z = np.add.reduceat(a[:, None] * h, at)
        return x, bag, h, v, u, a, z, 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"][0], -30, 30)))

    def step(self, x: np.ndarray, at: np.ndarray, y: np.ndarray) -> dict:
        p = self.p
        x, bag, h, v, u, a, z, q = self.forward(x, at)
        dl = (q - y) / len(y)
        dz = dl[:, None] * p["c"]
        dh = a[:, None] * dz[bag]
        da = (h * dz[bag]).sum(1)
        de = a * (da - np.add.reduceat(a * da, at)[bag])
        dv, du = de[:, None] * u * p["w"] * (1 - v * v), de[:, None] * v * p["w"] * u * (1 - u)
        dh = (dh + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ de, "c": z.T @ dl, "d": np.array([dl.sum()])}

    def train(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 5e-3, decay: float = 1e-4, seed: int = 11) -> GatedMil:
        rows = np.concatenate(bags)
        self.mean, self.std = rows.mean(0), rows.std(0) + 1e-3
        m, s, t = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        r = np.random.default_rng(seed)
        for _ in range(epochs):
            order = r.permutation(len(bags))
            for i in range(0, len(order), batch):
                part = order[i : i + batch]
                own = [bags[j] for j in part]
                at = np.concatenate([[0], np.cumsum([len(b) for b in own])[:-1]])
                g = self.step(np.concatenate(own), at, y[part])
                t += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**t) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8) + decay * self.p[k])
        return self


def fit(docs: DataFrame, labels: DataFrame, rows: int = 6_000, most: int = 200_000):
    """A trained model, or a constant share if the labels are all alike. The sample's bags are whole documents, in the
    order of a hash, as many as have `most` passages together (64 MB); a document with over a twentieth of these is left out."""
    train = written(labelled_sample(docs, labels, "quality", 4, 2, rows), "train")
    bags = train.select("doc_id", F.xxhash64("doc_id", F.lit(13)).alias("h"), (F.regexp_count(F.decode("text", "UTF-8"), F.lit(r"[^\x20\x09-\x0D]+")) / PASSAGE + 1).alias("size"))
    upto = Window.orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # over the bounded sample
    train = train.join(bags.where(F.col("size") <= most // 20).withColumn("all", F.sum("size").over(upto)).where(F.col("all") <= most).select("doc_id"), "doc_id", "left_semi")

    def run(batches: Iterator) -> Iterator:
        words = WordIds()
        for batch in pieces(batches):
            ids, texts, ys = columns_of(batch, "doc_id", "text", "y")
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([passages(t, words).tobytes() for t in texts], pa.binary()), pa.array(ys, pa.int32())], names=["doc_id", "x", "y"]
            )

    got = train.select("doc_id", "text", "y").mapInArrow(run, "doc_id long, x binary, y int").collect()  # the bounded sample
    got = sorted(got, key=lambda r: (r["doc_id"], bytes(r["x"])))
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    return GatedMil(WIDTH).train([np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH) for r in got], y)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **options))

    def run(batches: Iterator) -> Iterator:
        model, words = held.value, WordIds()
        for batch in pieces(batches):
            ids, texts = columns_of(batch, "doc_id", "text")
            bags = [passages(t, words) for t in texts]
            at = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]]).astype(np.int64)
            q = np.full(len(bags), model) if isinstance(model, float) else model.forward(np.concatenate(bags), at)[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(q, pa.float64()), pa.array([len(b) for b in bags], pa.int64())], names=["doc_id", "score", "n_passages"]
            )

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = texts.mapInArrow(run, "doc_id long, score double, n_passages long")
    return out.select("doc_id", split_rule("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_passages")
