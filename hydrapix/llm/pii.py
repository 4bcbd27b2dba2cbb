"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions on top.

Base spans (email, ip, card, phone) come from fixed patterns with their checks. The network is trained in numpy
on labelled spans: `windows` windows of the base spans and of other stretches of about `rows` sampled texts, taken
by hash from whole texts, and 5 windows to each 2 of these with a made-up span set into them, also in forms that the patterns
miss (phone numbers without a plus). So most of its spans are made up. Of `epochs` rounds, the one is kept after which the
spans of windows that were held back come out best (F1).

Whole texts are laid out in overlapping windows whose scores are reconciled per character. All four kinds need a digit
or an @, so windows that hold neither hold no span and are not scored. Where no tag can win against "no personal data"
the text has none; the stretches around all other characters are decoded by Viterbi together. A decoded span is added
if it is sure, holds a digit or an @, and touches neither a base span nor a candidate that a base check has refused.

n_email ... n_phone count base spans, n_added the rest; spans lists all. Offsets are code points, end exclusive.
Cases: null and empty texts have no spans; repeated rows are returned each; null ids are values like others; an
empty table gives an empty result; extra columns are not read; very long texts are read stretch by stretch, so memory
does not grow with them.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, pieces

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[@0-9]")
NUMBER = re.compile(r"[0-9][0-9() .-]{5,}[0-9]")
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
TAUGHT = 96  # characters of a window in training
WINDOW, STRIDE, MARGIN = 256, 192, 32
STRETCH, CONTEXT = 1024 * STRIDE, 4 * STRIDE
LEAST = 7  # characters of an added span
ALPHABET = {c: i for i, c in enumerate(map(chr, range(32, 127)), 2)}  # 0: beyond the text, 1: any other
SIZE = len(ALPHABET) + 2
CODE = np.ones(0x110000, np.int16)
CODE[list(map(ord, ALPHABET))] = list(ALPHABET.values())
NEEDED = np.zeros(SIZE, np.int64)
NEEDED[[ALPHABET[c] for c in "0123456789@"]] = 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ so that long runs cost no more than their length."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> tuple[list[list[tuple[int, int]]], list[tuple[int, int]]]:
    """Spans of each kind, and candidates that failed their check."""
    found: list[list[tuple[int, int]]] = [[], [], [], []]
    refused = []
    if "@" in text:
        found[0] = emails(text)
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            (found[1] if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split(".")) else refused).append(m.span())
        for m in CARD.finditer(text):
            d = re.sub("[ -]", "", m[0])
            (found[2] if 16 <= len(d) <= 19 and luhn(d) else refused).append(m.span())
        for m in PHONE.finditer(text):
            d = sum(c.isdigit() for c in m[0])
            (found[3] if 8 <= d <= 15 else refused).append(m.span())
    # refused candidates shorter than a phone number or card are no evidence against other kinds
    return found, [(a, b) for a, b in refused if sum(map(str.isdigit, text[a:b])) >= 12]


def coded(text: str) -> np.ndarray:
    return CODE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


class Tagger:
    """Embedding E, one LSTM each way (X, H, c; first axis: direction), a linear layer (O, o) and CRF transitions
    (T, s, e); gradients by hand."""

    def __init__(self, width: int = 12, hidden: int = 16, seed: int = 3):
        r = np.random.default_rng(seed)
        g = lambda *s: r.normal(0, 1 / np.sqrt(s[-2]), s).astype(np.float32)
        self.h = hidden
        bias = np.zeros((2, 1, 4 * hidden), np.float32)
        bias[:, :, hidden : 2 * hidden] = 1
        zero = lambda *s: np.zeros(s, np.float32)
        # inside tags follow tags of their kind only
        inside = np.arange(TAGS)
        self.never = np.where((inside[None, :] > 0) & (inside[None, :] % 2 == 0) & ((inside[:, None] + 1) // 2 != inside[None, :] // 2), -1e4, 0.0).astype(np.float32)
        self.p = {"E": g(SIZE, width) * np.float32(np.sqrt(SIZE) / 2), "X": g(2, width, 4 * hidden), "H": g(2, hidden, 4 * hidden), "c": bias, "O": g(2 * hidden, TAGS), "o": zero(TAGS), "T": zero(TAGS, TAGS), "s": zero(TAGS), "e": zero(TAGS)}

    def states(self, x: np.ndarray, keep: bool = False) -> tuple:
        """Hidden states (t + 1, 2, n, h) of windows x (n, t), the second direction from right to left; with keep
        also cells and gates (input, forget, output, candidate)."""
        p, h, (n, t) = self.p, self.h, x.shape
        sign = np.repeat(np.array([-1, 1], p["X"].dtype), [3 * h, h])  # the gates' exponents come with their sign
        table, turn = (p["E"] @ p["X"] + p["c"]) * sign, p["H"] * sign
        both = np.stack([x.T, x.T[::-1]], 1)
        hs = np.zeros((t + 1, 2, n, h), table.dtype)
        cs, gates = (np.zeros_like(hs), np.empty((t, 2, n, 4 * h), table.dtype)) if keep else (None, None)
        c, way, a = np.zeros_like(hs[0]), np.arange(2)[:, None], np.empty((2, n, 4 * h), table.dtype)
        for i in range(t):
            np.matmul(hs[i], turn, out=a)
            a += table[way, both[i]]
            s = a[..., : 3 * h]
            np.exp(s, out=s)
            s += 1
            np.reciprocal(s, out=s)
            np.tanh(a[..., 3 * h :], out=a[..., 3 * h :])
            c *= a[..., h : 2 * h]
            c += a[..., :h] * a[..., 3 * h :]
            np.tanh(c, out=hs[i + 1])
            hs[i + 1] *= a[..., 2 * h : 3 * h]
            if keep:
                cs[i + 1], gates[i] = c, a
        return hs, cs, gates

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self._scores(self.states(x)[0])

    def _scores(self, hs: np.ndarray) -> np.ndarray:
        """(t, n, tags)"""
        return np.concatenate([hs[1:, 0], hs[:0:-1, 1]], 2) @ self.p["O"] + self.p["o"]

    def posteriors(self, em: np.ndarray) -> tuple:
        """Probabilities of tags (t, n, k) given emissions (t, n, k), and expected counts of transitions."""
        p = {k: self.p[k].astype(float) for k in "Tse"}
        step, e = np.exp(p["T"] + self.never), np.exp(em.astype(float) - em.max(2, keepdims=True))
        al, be = np.empty_like(e), np.empty_like(e)
        al[0], be[-1] = np.exp(p["s"] + self.never[0]) * e[0], np.exp(p["e"])
        for i in range(1, len(e)):
            al[i - 1] /= al[i - 1].sum(1, keepdims=True)
            al[i] = (al[i - 1] @ step) * e[i]
        for i in range(len(e) - 2, -1, -1):
            x = (e[i + 1] * be[i + 1]) @ step.T
            be[i] = x / x.sum(1, keepdims=True)
        q = al * be
        q /= q.sum(2, keepdims=True)
        pairs = np.zeros_like(step)
        for i in range(1, len(e)):
            right = e[i] * be[i]
            z = ((al[i - 1] @ step) * right).sum(1, keepdims=True)
            pairs += (al[i - 1] / z).T @ right * step
        return q, pairs

    def grads(self, x: np.ndarray, y: np.ndarray) -> dict:
        """Gradients of the mean negative log likelihood of tags y of windows x."""
        p, h, (n, t) = self.p, self.h, x.shape
        hs, cs, gates = self.states(x, keep=True)
        q, pairs = self.posteriors(self._scores(hs))
        d = q - np.eye(TAGS)[y.T]
        np.add.at(pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        g = {"s": d[0].sum(0), "e": d[-1].sum(0), "T": pairs, "o": d.sum((0, 1))}
        d = d.astype(p["O"].dtype)
        both = np.concatenate([hs[1:, 0], hs[:0:-1, 1]], 2)
        g["O"] = both.reshape(-1, 2 * h).T @ d.reshape(-1, TAGS)
        dboth = d @ p["O"].T
        dh_all = np.stack([dboth[..., :h], dboth[::-1, :, h:]], 1)
        dh, dc = np.zeros_like(hs[0]), np.zeros_like(hs[0])
        das = np.empty_like(gates)
        g["H"] = np.zeros_like(p["H"])
        back = p["H"].transpose(0, 2, 1)
        for i in range(t - 1, -1, -1):
            ig, fg, og, cg = (gates[i][..., k * h : (k + 1) * h] for k in range(4))
            dh = dh + dh_all[i]
            tc = np.tanh(cs[i + 1])
            dc = dc + dh * og * (1 - tc * tc)
            da = np.concatenate([dc * cg * ig * (1 - ig), dc * cs[i] * fg * (1 - fg), dh * tc * og * (1 - og), dc * ig * (1 - cg * cg)], 2)
            das[i] = da
            g["H"] += hs[i].transpose(0, 2, 1) @ da
            dh, dc = da @ back, dc * fg
        one = np.eye(SIZE, dtype=das.dtype)
        codes = np.stack([x.T, x.T[::-1]], 1)
        dx = np.stack([one[codes[:, k].ravel()].T @ das[:, k].reshape(-1, 4 * h) for k in (0, 1)])
        g["X"], g["c"] = p["E"].T @ dx, dx.sum(1, keepdims=True)
        g["E"] = (dx @ p["X"].transpose(0, 2, 1)).sum(0)
        return {k: v / n for k, v in g.items()}

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 14, batch: int = 64, rate: float = 0.02, seed: int = 5, enough: float = 0.999) -> Tagger:
        """Adam on seven of eight windows; of the last three quarters of the rounds, the one that gets the spans of the other
        windows right most often is kept."""
        r = np.random.default_rng(seed)
        order = r.permutation(len(x))
        held, own = order[: len(x) // 8], order[len(x) // 8 :]
        m, s, t = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        steps, best = epochs * -(-len(own) // batch), (-1.0, self.p)
        for e in range(epochs):
            own = r.permutation(own)
            for i in range(0, len(own), batch):
                part = own[i : i + batch]
                g = self.grads(x[part], y[part])
                norm = np.sqrt(sum((v.astype(float) ** 2).sum() for v in g.values()))
                t += 1
                for k in self.p:
                    v = g[k] * min(1.0, 10 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.995 * s[k] + 0.005 * v * v
                    now = rate * min(1.0, t / 10) * (1 - t / (steps + 1))
                    self.p[k] = (self.p[k] - now * m[k] / (1 - 0.9**t) / (np.sqrt(s[k] / (1 - 0.995**t)) + 1e-8)).astype(self.p[k].dtype)
            if e >= epochs // 4 and len(held):
                best = max(best, (self.f1(x[held], y[held]), dict(self.p)), key=lambda q: q[0])
                if best[0] >= enough:
                    break
        self.p = best[1] if best[0] >= 0 else self.p
        return self

    def f1(self, x: np.ndarray, y: np.ndarray) -> float:
        """F1 of whole spans."""
        n, t = x.shape
        tags = self.decode(self.emissions(x).transpose(1, 0, 2), np.full(n, t))
        got = {(i, *q) for i, z in enumerate(tags) for q in spans_in(z)}
        want = {(i, *q) for i, z in enumerate(y) for q in spans_in(z)}
        return 2 * len(got & want) / max(1, len(got) + len(want))

    def decode(self, em: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The best tags (n, t) of stretches with emissions em (n, t, k), of which the first `size` characters count."""
        p, (n, t, k) = self.p, em.shape
        back, score, step = np.empty((t, n, k), np.int8), p["s"] + self.never[0] + em[:, 0], p["T"] + self.never
        for i in range(1, t):
            x = score[:, :, None] + step
            on = (i < size)[:, None]
            back[i] = np.where(on, x.argmax(1), np.arange(k))
            score = np.where(on, x.max(1) + em[:, i], score)
        out = np.zeros((n, t), np.int8)
        now = (score + p["e"]).argmax(1)
        for i in range(t - 1, -1, -1):
            out[:, i] = np.where(i < size, now, 0)
            if i:
                now = back[i, np.arange(n), now]
        return out


def spans_in(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the spans in a row of tags that begin with a B tag."""
    kind = np.where(tags > 0, (tags - 1) // 2, -1)
    new = np.flatnonzero((tags % 2 == 1) | (np.diff(kind, prepend=-1) != 0))
    ends = [*new[1:], len(tags)][: len(new)]
    return [(int(kind[a]), int(a), int(b)) for a, b in zip(new, ends, strict=True) if tags[a] % 2 == 1]


def tag(text_len: int, spans: list[list[tuple[int, int]]]) -> np.ndarray:
    y = np.zeros(text_len, np.int64)
    for k, own in enumerate(spans):
        for a, b in own:
            y[a:b] = 2 + 2 * k
            y[a] = 1 + 2 * k
    return y


def invented(r: random.Random) -> tuple[int, str]:
    """A made-up span of some kind; half of them phone numbers, whose forms differ most."""
    kind = r.choice((0, 1, 2, 3, 3, 3))
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    w = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
    if kind == 0:
        return 0, w() + r.choice(["", ".", "_", "-"]) + r.choice(["", n(2), w()]) + "@" + w() + r.choice(["", n(1), "." + w()]) + "." + r.choice(["com", "org", "net", "de", "fr", "io"])
    if kind == 1:
        return 1, ".".join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        d = r.choice("3456") + n(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = r.choice(["", "", " ", "-"])
        return 2, sep.join(d[i : i + 4] for i in range(0, 16, 4))
    area, a, b = n(3), n(3), n(4)
    return 3, r.choice([f"+1 ({area}) {a}-{b}", f"+{n(2)} {n(3)} {n(7)}", f"({area}) {a}-{b}", f"{area}-{a}-{b}", f"{area}-{a}-{b}", f"+{n(11)}"])


def windows_of(text: str) -> list[tuple[str, str]]:
    """Windows of a whole text with their tags as digits: around each base span, around numbers that are none, and
    one of plain text. A window that holds a long number without a label teaches nothing and is left out."""
    r = random.Random(text)
    found, refused = base_spans(text)
    known = sorted(x for own in found for x in own)
    tags = tag(len(text), found)
    at = [max(0, a - r.randrange(8, TAUGHT // 2)) for a, _ in known]
    at += [max(0, m.start() - r.randrange(8, TAUGHT // 2)) for m in re.finditer(r"[^\s]*[0-9@][^\s]*", text) if not tags[m.start() : m.end()].any()][:: 1 + len(text) // 2000]
    at += [r.randrange(max(1, len(text) - TAUGHT))]
    out = []
    for a in at:
        part = text[a : a + TAUGHT]
        y = tags[a : a + TAUGHT]
        cut = a and y[0] > 0 and y[0] % 2 == 0  # begins within a span
        odd = any(not y[m.start() : m.end()].any() and (a + m.start(), a + m.end()) not in refused for m in NUMBER.finditer(part))
        if not cut and not odd:
            out.append((part, "".join(map(str, y))))
    return out


def training(windows: list[tuple[str, str]], seed: int = 9, made: int = 3000) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags: the given windows, and `made` ones in which a made-up span, or a number that is no personal data,
    stands in plain text."""
    r = random.Random(seed)
    xs, ys = [], []

    def add(text: str, y: np.ndarray) -> None:
        x, z = np.zeros((2, TAUGHT), np.int64)
        part = coded(text[:TAUGHT])
        x[: len(part)], z[: len(part)] = part, y[:TAUGHT]
        xs.append(x)
        ys.append(z)

    for text, y in windows:
        add(text, np.array(list(y), np.int64))
    plain = [t for t, y in windows if len(t) == TAUGHT and not y.strip("0") and not TRIGGER.search(t)]
    plain = plain or ["lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore"]
    for _ in range(made):
        c = r.choice(plain)
        if r.random() < 0.2:  # words of no language
            c = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.choice((1, 2, 4, 7)))) for _ in range(40))[:TAUGHT]
        cut = r.randrange(0, 56)
        if r.random() < 0.25:  # numbers of other kinds: hex strings, years, amounts, decimals
            junk = r.choice(['"' + "".join(r.choice("0123456789abcdef") for _ in range(40)) + '"', str(r.randint(1, 9999)), f"in {r.randint(1900, 2030)}", f"{r.randint(1, 99)}.{r.randint(0, 99)}", f"{r.randint(1, 31)}.{r.randint(1, 12)}.20{r.randint(10, 29)}", f"{r.randint(0, 23)}:{r.randint(10, 59)}", "@" + c[:5], f"v{r.randint(1, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}"])
            text = c[:cut] + " " + junk + " " + c[cut:]
            add(text, np.zeros(len(text), np.int64))
            continue
        kind, span = invented(r)
        text = c[:cut] + " " + span + r.choice([" ", ". ", ", ", "!! ", "*** "]) + c[cut:]
        spans: list[list[tuple[int, int]]] = [[], [], [], []]
        spans[kind] = [(cut + 1, cut + 1 + len(span))]
        add(text, tag(len(text), spans))
    return np.array(xs), np.array(ys)


def fit(docs: DataFrame, rows: int = 1_500, windows: int = 1_200, epochs: int = 14) -> Tagger:
    """Trained on windows of about `rows` texts with a digit or @, both taken by hash, so equal ones count once."""
    some = docs.where(F.col("text").rlike("[@0-9]")).select("text")
    n = some.count()
    mark = F.pmod(F.xxhash64("text", F.lit(29)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, rows / max(n, 1)))

    def cut(batches: Iterator) -> Iterator:
        for batch in pieces(batches):
            got = [w for text in columns_of(batch, "text")[0] for w in windows_of(text)]
            yield pa.RecordBatch.from_arrays([pa.array([w[i] for w in got], pa.string()) for i in (0, 1)], names=["window", "tags"])

    got = some.where(mark).mapInArrow(cut, "window string, tags string").distinct()
    got = got.orderBy(F.xxhash64("window", F.lit(31)), "window", "tags").limit(windows).collect()
    return Tagger().train(*training([tuple(r) for r in got], made=5 * windows // 2), epochs=epochs)


def stretches(texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """(text, start, end, kept from, kept to) of stretches of bounded length with some context on either side."""
    for i, text in enumerate(texts):
        for a in range(0, len(text), STRETCH):
            yield i, max(0, a - CONTEXT), min(len(text), a + STRETCH + CONTEXT), a, a + STRETCH


def scores(codes: list[np.ndarray], model: Tagger) -> list[np.ndarray]:
    """Emissions of each character, reconciled over the windows that hold it: weights fall towards a window's ends."""
    weight = (1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])).astype(np.float32)[:, None]
    places = []
    for j, c in enumerate(codes):
        seen = np.concatenate([[0], np.cumsum(NEEDED[c])])
        at = np.arange(0, max(len(c) - WINDOW, 0) + STRIDE, STRIDE)
        at = at[at < len(c)]
        places += [(j, int(x)) for x in at[seen[np.minimum(at + WINDOW, len(c))] > seen[at]]]
    # windows of one size go together, so short texts cost no more than their length
    places.sort(key=lambda x: -min(WINDOW, len(codes[x[0]]) - x[1]))
    total = [np.zeros((len(c), TAGS), np.float32) for c in codes]
    norm = [np.zeros((len(c), 1), np.float32) for c in codes]
    for k in range(0, len(places), 256):
        part = places[k : k + 256]
        size = [min(WINDOW, len(codes[j]) - s) for j, s in part]
        x = np.zeros((len(part), max(size)), np.int64)
        for r, ((j, s), n) in enumerate(zip(part, size, strict=True)):
            x[r, :n] = codes[j][s : s + n]
        em = model.emissions(x)
        for r, ((j, s), n) in enumerate(zip(part, size, strict=True)):
            total[j][s : s + n] += em[:n, r] * weight[:n]
            norm[j][s : s + n] += weight[:n]
    for t, n in zip(total, norm, strict=True):
        t[:, 0] += n[:, 0] == 0  # not scored: no personal data
        t[:, 1:][n[:, 0] == 0] = -1e3
        t /= np.maximum(n, 1)
    return total


def added_spans(texts: list[str], known: list, model: Tagger, sure: float = 0.8) -> list[list[tuple[int, int, int]]]:
    """Spans that the network adds to each text: (kind, start, end), of LEAST characters or more, with a mean probability of
    `sure` or more, a digit or an @, and no character of a base span or a refused candidate."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    waiting, held = [], 0
    for job in stretches(texts):
        waiting.append(job)
        held += job[2] - job[1]
        if held >= STRETCH:
            _decoded(texts, waiting, model, known, sure, out)
            waiting, held = [], 0
    _decoded(texts, waiting, model, known, sure, out)
    return out


def _decoded(texts: list[str], jobs: list, model: Tagger, known: list, sure: float, out: list, least: int = LEAST) -> None:
    p = model.p
    gain = float((p["T"] - p["T"][0, 0]).max())  # what transitions can add to another tag at most
    taken = {i: Taken(known[i]) for i in {job[0] for job in jobs}}
    parts = []
    for job, em in zip(jobs, scores([coded(texts[i][a:b]) for i, a, b, _, _ in jobs], model), strict=True):
        # a span that is added has only characters that may get another tag and that no base span has
        open_ = np.flatnonzero((em[:, 1:].max(1) - em[:, 0] + gain > 0) & ~taken[job[0]].mask(job[1], job[2]))
        if len(open_):
            new = np.flatnonzero(np.diff(open_, prepend=-3 * MARGIN) > 2 * MARGIN)
            for x, y in zip(open_[new], open_[[*(new[1:] - 1), len(open_) - 1]], strict=True):
                x, y = max(0, x - MARGIN), min(len(em), y + MARGIN + 1)
                parts.append((job, x, em[x:y]))
    parts.sort(key=lambda q: len(q[2]))
    for k in range(0, len(parts), 256):
        group = parts[k : k + 256]
        size = np.array([len(em) for _, _, em in group])
        block = np.zeros((len(group), size.max(), TAGS), np.float32)
        for row, (_, _, em) in zip(block, group, strict=True):
            row[: len(em)] = em
        for ((i, a, _, lo, hi), x, em), tags in zip(group, model.decode(block, size), strict=True):
            prob = None
            for kind, s, e in spans_in(tags[: len(em)]) if tags.any() else ():
                start, end = a + x + s, a + x + e
                if lo <= start < hi and end - start >= least and TRIGGER.search(texts[i], start, end) and taken[i].free(start, end):
                    prob = model.posteriors(em[:, None, :])[0][:, 0] if prob is None else prob
                    if prob[np.arange(s, e), tags[s:e]].mean() >= sure:
                        out[i].append((kind, start, end))


class Taken:
    """The places of a text that base spans and refused candidates have."""

    def __init__(self, known: tuple):
        found, refused = known
        spans = sorted(x for own in (*found, refused) for x in own)
        self.starts = [a for a, _ in spans]
        self.reach = list(accumulate((b for _, b in spans), max))

    def free(self, start: int, end: int) -> bool:
        """Whether none of them meets [start, end): of those that start before its end none reaches beyond its start."""
        k = bisect_left(self.starts, end)
        return k == 0 or self.reach[k - 1] <= start

    def mask(self, start: int, end: int) -> np.ndarray:
        """Which characters of [start, end) some of them has."""
        out = np.zeros(end - start, bool)
        for k in range(bisect_right(self.reach, start), bisect_left(self.starts, end)):
            out[max(self.starts[k] - start, 0) : self.reach[k] - start] = True  # up to where those before it reach, too
        return out


def personal_data(docs: DataFrame, sure: float = 0.8, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added. The network's spans need a mean probability of
    `sure`; options are those of fit()."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, **options))

    def run(batches: Iterator) -> Iterator:
        model = held.value
        for batch in pieces(batches):
            ids, texts = columns_of(batch, "doc_id", "text")
            texts = [t or "" for t in texts]
            known = [base_spans(t) for t in texts]
            more = added_spans(texts, known, model, sure)
            shas, spans = [], []
            for (found, _), extra in zip(known, more, strict=True):
                base = [(k, a, b) for k, own in enumerate(found) for a, b in own]
                shas.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base).encode()).hexdigest())
                spans.append(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(base + extra)))
            counts = [pa.array([len(found[k]) for found, _ in known], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *counts, pa.array(shas), pa.array(spans), pa.array(list(map(len, more)), pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
