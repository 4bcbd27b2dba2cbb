"""Queries with an SQL form against it; the others against brute force or held-out labels."""

from __future__ import annotations

import glob
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hydrapix.llm import (
    common, exact_dedup, language, mixing, ngram_join, pii, pivot_index, quality, queries, sentencepieces, suffix_dedup, toxicity,
)

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{SMALL}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    df = queries.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    want = c.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(x) for x in cols]
    assert sorted(tuple(map(plain, r)) for r in df.select(*cols).collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def brute_pieces(table, text):
    best_of = {p: (i, s) for p, i, s in table.rows}
    if not text:
        return []
    s = sentencepieces.SPACE + text.replace(" ", sentencepieces.SPACE)
    best = [(0.0, [])]
    for e in range(1, len(s) + 1):
        top = None
        for n in range(1, min(table.longest, e) + 1):
            p = s[e - n : e]
            if p not in best_of and n > 1:
                continue
            i, x = best_of[p] if p in best_of else (-1 - ord(p), table.unknown_score)
            if top is None or best[e - n][0] + x > top[0]:
                top = (best[e - n][0] + x, best[e - n][1] + [i])
        best.append(top)
    return table.expand(best[-1][1])


@pytest.mark.parametrize("hot", [3, 1 << 18])
def test_pieces_equal_brute_force(spark, hot):
    table = sentencepieces.Pieces()
    rows = [(1, "Hello world, this is a test."), (2, None), (3, ""), (4, "  a  b\n\n\tc 日本語 ጀ \U0001f600 end "), (5, "aaaa" * 60), (None, "x"), (1, "same id"), (1, "same id"), (6, " "), (7, "ab\n cd"), (8, "x" * 3 + "ÄÖÜß…" * 20)]
    got = sentencepieces.encode(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).collect()
    assert sorted((str(r["doc_id"]), list(r["token_ids"])) for r in got) == sorted((str(i), brute_pieces(table, t)) for i, t in rows)
    assert all(r["round_trip"] for r in got)
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in got)


def test_long_text_without_spaces_is_cut(spark):
    text = "".join(random.Random(1).choice("0123456789abcdefABCDEF+/") for _ in range(60_000))
    row = sentencepieces.encode(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["round_trip"]


def worth(table, ids):
    """The sum of the ids' scores."""
    score = {i: x for _, i, x in table.rows}
    return sum(score[i] for i in ids)


def best_worth(table, text):
    """The largest sum of scores, by a plain pass over the text."""
    best_of = {p: x for p, _, x in table.rows}
    s = sentencepieces.SPACE + text.replace(" ", sentencepieces.SPACE)
    best = [0.0]
    for e in range(1, len(s) + 1):
        best.append(max(best[e - n] + best_of[s[e - n : e]] for n in range(1, min(table.longest, e) + 1) if s[e - n : e] in best_of))
    return best[-1]


def test_runs_that_no_cut_divides(spark):
    """Runs of letters in which pieces chain, as long as 100,000 letters."""
    table, r = sentencepieces.Pieces(), random.Random(8)
    rows = [(i, "".join(r.choice("acgt") for _ in range(n))) for i, n in enumerate((254, 255, 256, 257, 270, 383, 384, 385, 400, 1000, 2001))]
    rows += [(100, "a" * 100_000), (101, "the" * 500), (102, "x" + "ab" * 3000 + " and the end")]
    got = sentencepieces.encode(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(x["round_trip"] for x in got)
    text = dict(rows)
    for x in got:
        assert worth(table, x["token_ids"]) == best_worth(table, text[x["doc_id"]])
        if len(text[x["doc_id"]]) < 256:
            assert list(x["token_ids"]) == brute_pieces(table, text[x["doc_id"]])


@pytest.mark.parametrize("doc_id", [7, None])
def test_rows_that_repeat_ten_thousand_times(spark, doc_id):
    table, text = sentencepieces.Pieces(), " ".join(f"word{i}x" for i in range(200))
    one = spark.createDataFrame([(doc_id, text)], "doc_id long, text string")
    rows = spark.range(10_000, numPartitions=8).join(F.broadcast(one)).select("doc_id", "text")
    got = sentencepieces.encode(rows, hot=3)
    n = len(brute_pieces(table, text))
    assert got.where(f"round_trip and n_tokens = {n}").count() == 10_000


def brute_repeats(docs, least=50):
    words = {i: (t or "").encode().lower().split() for i, t in docs}
    seen: dict = {}
    for i, w in words.items():
        for s in range(len(w) - least + 1):
            seen.setdefault(tuple(w[s : s + least]), set()).add(i)
    out = {}
    for i, w in words.items():
        spans = []
        for s in range(len(w) - least + 1):
            if len(seen[tuple(w[s : s + least])]) > 1:
                if spans and spans[-1][1] >= s:
                    spans[-1][1] = s + least
                else:
                    spans.append([s, s + least])
        out[i] = (len(w), sum(b - a for a, b in spans), ",".join(f"{a}:{b}" for a, b in spans))
    return out


def test_repeated_passages_equal_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    r = random.Random(2)
    passage = " ".join(f"w{r.randrange(900)}" for _ in range(70))
    docs += [(9001, "one two " + passage), (9002, passage + " three"), (9003, "x " * 30 + passage + " y" * 30), (9004, "again " * 300), (9005, "Again " * 80 + "end"), (9006, " ".join(passage.split()[:49]))]
    got = suffix_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {x["doc_id"]: (x["n_words"], x["n_repeated"], x["spans"]) for x in got.collect()} == brute_repeats(docs)


def test_a_passage_that_very_many_texts_share(spark):
    """One passage in 400 texts, over more partitions than one task holds."""
    r = random.Random(4)
    passage = " ".join(f"p{r.randrange(900)}" for _ in range(60))
    docs = [(i, " ".join(f"w{r.randrange(9999)}" for _ in range(r.randrange(0, 40))) + " " + passage + " " + " ".join(f"v{r.randrange(9999)}" for _ in range(r.randrange(0, 80)))) for i in range(400)]
    docs += [(1000 + i, "again and " * 60 + f"x{i}") for i in range(5)] + [(2000, "solo " * 500)]
    got = suffix_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(16))
    assert {x["doc_id"]: (x["n_words"], x["n_repeated"], x["spans"]) for x in got.collect()} == brute_repeats(docs)


@pytest.mark.parametrize("most", [3, 1 << 20])
def test_runs_over_several_parts(most):
    """Parts hold all rows in order; inner runs are whole."""
    keys = [1, 1, 1, 2, 3, 3, 3, 3, 3, 3, 3, 4, 4, 5]
    table = pa.table({"k": pa.array(keys, pa.int64()), "i": pa.array(range(len(keys)), pa.int64())})
    parts = list(common.run_parts(iter(table.to_batches(max_chunksize=2)), most))
    assert [x for p, *_ in parts for x in p.column(1).to_pylist()] == list(range(len(keys)))
    assert parts[0][2] and parts[-1][3]
    for part, start, before, after in parts:
        runs = [part.column(0).to_pylist()[a] for a in start]
        whole = runs[1 if before else 0 : len(runs) - (1 if after else 0)]
        for k in whole:
            assert part.column(0).to_pylist().count(k) == keys.count(k)


def naive_base(text):
    """The patterns as the contract has them, with plain re."""
    def luhn(d):
        t = [int(c) for c in d][::-1]
        return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(t)) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    return [
        [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))],
        [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15],
    ]


def test_base_patterns_equal_plain_ones(spark):
    r = random.Random(3)
    made = ["".join(r.choice("a@.1+ 29-(") for _ in range(40)) for _ in range(3000)]
    texts = made + [t[0] for t in spark.read.parquet(f"{MORE}/documents.parquet").select("text").collect()]
    for t in texts:
        assert pii.base_spans(t)[0] == naive_base(t), t


PLAIN = "and the thing was ent on to be for a the ther in of it and so on with them "


@pytest.fixture(scope="module")
def tagger():
    return pii.Tagger().train(*pii.training(pii.windows_of(PLAIN * 30) * 30))


def test_network_learns_and_adds_spans(tagger):
    long = PLAIN * 6_000
    cases = {
        "please call (743) 555-3824 before noon": [(3, "(743) 555-3824")],
        "nothing to see in 2024 here": [],
        "x " * 80 + "or at 212-555-1234 there": [(3, "212-555-1234")],
        PLAIN * 5: [],
        long + "call 212-555-1234 now " + long: [(3, "212-555-1234")],  # far into a text of several stretches
    }
    for text, want in cases.items():
        got = pii.added_spans([text], [pii.base_spans(text)], tagger)[0]
        assert [(k, text[a:b]) for k, a, b in got] == want, text[:100]


def test_added_spans_do_not_depend_on_the_batch(tagger):
    r = random.Random(1)
    texts = [PLAIN * r.randrange(9) + f" ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)} " + PLAIN * r.randrange(9) for _ in range(40)] + ["", "a"]
    known = [pii.base_spans(t) for t in texts]
    one = [pii.added_spans([t], [k], tagger)[0] for t, k in zip(texts, known, strict=True)]
    assert pii.added_spans(texts, known, tagger) == one
    assert sum(map(len, one)) >= 36


def test_words_beside_a_hit_are_whole():
    long = "x" * 300
    s = f"one {long} bad {long} two_bad 3 bad"
    at = s.index("bad")
    assert toxicity.word_before(s, at) == long and toxicity.AFTER.match(s, at + 3)[0] == " " + long
    assert [toxicity.word_before(s, i) for i in (0, 1, s.rindex("bad"), s.rindex("_bad"))] == ["", "", "", ""]


def test_a_huge_text_does_not_fill_the_samples(spark):
    """A text of very many passages is no sample; the others are."""
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(("good", "fine", "nice") if i % 2 else ("poor", "weak", "dull")) for _ in range(60)), i % 2, "ab"[i % 2]) for i in range(400)]
    rows += [(1000 + i, "huge text " * 60_000, i % 2, "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, lang string")
    got = {x["doc_id"]: x["score"] for x in quality.quality(df.select("doc_id", "text"), df.select("doc_id", "quality"), most=20_000).collect()}
    assert sum((got[i] > 0.5) == (i % 2 == 1) for i in range(400)) > 380
    model = language.fit(df, room=200_000)
    assert set(model.langs) == {"a", "b"} and model.words.get("huge") is None and model.words.get("good") is not None


def test_places_of_base_spans():
    """Bisection against a plain look at all spans, nested and overlapping ones too."""
    r = random.Random(6)
    for _ in range(200):
        spans = [(a, a + r.randrange(1, 20)) for a in (r.randrange(90) for _ in range(r.randrange(6)))]
        taken = pii.Taken(([spans[::2], [], spans[1::2], []], []))
        lo = r.randrange(60)
        hi = lo + r.randrange(1, 50)
        assert taken.mask(lo, hi).tolist() == [any(a <= i < b for a, b in spans) for i in range(lo, hi)]
        assert taken.free(lo, hi) == all(hi <= a or lo >= b for a, b in spans)


def test_gradients_of_the_network():
    x, y = pii.training([("some words stand here for the test of it all and more of them come along the way to the end", "0" * 91)], made=6)
    m = pii.Tagger()
    m.p = {k: v.astype(float) for k, v in m.p.items()}
    g = m.grads(x, y)

    def lse(v, axis):
        top = v.max(axis, keepdims=True)
        return np.log(np.exp(v - top).sum(axis)) + np.squeeze(top, axis)

    def loss():
        p, total = m.p, 0.0
        for e, t in zip(m.emissions(x).transpose(1, 0, 2), y, strict=True):
            a = p["s"] + m.never[0] + e[0]
            for i in range(1, len(e)):
                a = lse(a[:, None] + p["T"] + m.never, 0) + e[i]
            total += lse(a + p["e"], 0) - (p["s"][t[0]] + e[np.arange(len(e)), t].sum() + p["T"][t[:-1], t[1:]].sum() + p["e"][t[-1]])
        return total / len(x)

    for k, i in (("X", (0, 2, 5)), ("X", (1, 3, 40)), ("H", (1, 3, 20)), ("O", (5, 1)), ("T", (0, 1)), ("c", (1, 0, 7)), ("s", (0,)), ("e", (2,)), ("E", (int(x[0, 3]), 1))):
        v = m.p[k][i]
        m.p[k][i] = v + 1e-5
        a = loss()
        m.p[k][i] = v - 1e-5
        b = loss()
        m.p[k][i] = v
        assert g[k][i] == pytest.approx((a - b) / 2e-5, abs=1e-4), k


def test_spans_at_the_border_of_a_stretch(tagger):
    """A text of several stretches gives what a short one gives, wherever the span lies."""
    for at in (pii.STRETCH - 12, pii.STRETCH - 5, pii.STRETCH, pii.STRETCH + 3, 2 * pii.STRETCH - 1):
        text = (PLAIN * 9000)[: at - 1] + " 212-555-1234 " + PLAIN * 40
        assert [(k, text[a:b]) for k, a, b in pii.added_spans([text], [pii.base_spans(text)], tagger)[0]] == [(3, "212-555-1234")]


def brute_decode(model, em):
    """Plain Viterbi over one stretch."""
    p, rows = model.p, [(model.p["s"][k] + model.never[0, k] + em[0, k], [k]) for k in range(pii.TAGS)]
    for e in em[1:]:
        rows = [max(((x + p["T"][w[-1], k] + model.never[w[-1], k] + e[k], [*w, k]) for x, w in rows), key=lambda q: q[0]) for k in range(pii.TAGS)]
    return max((x + p["e"][w[-1]], w) for x, w in rows)[1]


def test_decoder_equals_plain_viterbi(tagger):
    r = np.random.default_rng(4)
    size = np.array([1, 7, 30])
    em = r.normal(0, 3, (3, 30, pii.TAGS)).astype(np.float32)
    for tags, e, n in zip(tagger.decode(em, size), em, size, strict=True):
        assert tags[:n].tolist() == brute_decode(tagger, e[:n]) and not tags[n:].any()


def test_pii_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    for r in docs.collect():
        base = naive_base(r["text"])
        mine = got[r["doc_id"]]
        assert [mine[f"n_{k}"] for k in pii.KINDS] == [len(s) for s in base]
        spans = set(filter(None, mine["spans"].split(",")))
        assert {f"{k}:{a}:{b}" for k, own in zip(pii.KINDS, base, strict=True) for a, b in own} <= spans


def agreement(df, other, a, b):
    both = df.join(other, "doc_id").where("held_out")
    return both.agg(F.avg((F.col(a) == F.col(b)).cast("double"))).first()[0]


def test_language_on_held_out(spark):
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    out = language.identify(docs)
    assert agreement(out, docs.select("doc_id", "lang"), "lang_pred", "lang") > 0.97


def test_quality_on_held_out(spark):
    docs, labels = (spark.read.parquet(f"{MORE}/{t}.parquet") for t in ("documents", "labels"))
    assert agreement(quality.quality(docs, labels), labels, "predicted", "quality") > 0.9


def test_toxicity_on_held_out(spark):
    docs, labels = (spark.read.parquet(f"{MORE}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels)
    assert agreement(out, labels, "predicted", "toxic") > 0.93
    assert out.join(labels, "doc_id").where("predicted = 1 and toxic = 0").count() <= 2


def test_letters():
    assert language.words_of("½ ² ① Ⅷ") == [] and language.words_of("x² ½y Äb 3c _d日本") == ["x", "y", "äb", "c", "d日本"]


def test_texts_without_a_letter(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", "s") for i in range(1, 60)]
    rows += [(100, "½ ² ① Ⅷ", "en", "s"), (101, "12 34 !", "en", "s"), (102, "die katze ½", None, "s")]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert (got[100], got[101], got[102]) == ("und", "und", "de")


def naive_language(model, text):
    """The backoff word by word, from the fitted tables."""
    words = re.findall(r"[^\W\d_]+", text.lower()) if text else []
    if not words:
        return "und", 0.0
    total = np.array(model.prior, float)
    for w in words:
        if w in model.words.at:
            total += model.words.rows[model.words.at[w]]
            continue
        for n in (5, 4, 3, 2, 1):
            p = f"<{w}>"
            known = [model.grams[n].rows[model.grams[n].at[p[i : i + n]]] for i in range(len(p) - n + 1) if p[i : i + n] in model.grams[n].at]
            if known:
                total += np.sum(known, 0, dtype=float) / n
                break
    p = np.exp(total - total.max())
    return model.langs[int(np.argmax(p))], float(p.max() / p.sum())


def test_language_equals_plain_backoff(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit(docs, rows=60)  # few rows, so that many words are unknown
    got = {r["doc_id"]: r for r in language.identify(docs, rows=60).collect()}
    texts = docs.collect()
    assert sum(w not in model.words.at for r in texts for w in language.words_of(r["text"])) > 500
    for r in texts:
        want = naive_language(model, r["text"])
        assert got[r["doc_id"]]["lang_pred"] == want[0] and got[r["doc_id"]]["score"] == pytest.approx(want[1], abs=1e-4)
        assert got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def naive_toxicity(model, text):
    """Whole words by a plain search for each entry, exceptions taken out."""
    s = toxicity.folded((text or "").encode())
    def found(entry):
        return [m.start() for m in re.finditer(f"(?={re.escape(entry)})", s) if not (m.start() and s[m.start() - 1].isalpha()) and not (m.start() + len(entry) < len(s) and s[m.start() + len(entry)].isalpha())]

    free = [(a, a + len(e)) for e in model["exceptions"] for a in found(e)]
    total = sum(x for w, x in model["weights"].items() for a in found(w) if not any(b <= a and a + len(w) <= c for b, c in free))
    n = max(len(s.split()), 1)
    z = model["beta"] @ np.array([1.0, np.log1p(100 * total / n), np.log1p(total)])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def test_toxicity_equals_plain_search(spark):
    docs, labels = (spark.read.parquet(f"{MORE}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, exceptions=("is the", "of the"))
    assert model["weights"]
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]]["score"] == pytest.approx(naive_toxicity(model, r["text"]), abs=1e-9)
    assert {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels, exceptions=("is the", "of the")).collect()} == {i: r["score"] for i, r in got.items()}


def test_exceptions_that_overlap():
    auto = toxicity.automaton({"bad": 1.0, "dog": 1.0}, {"bad dog", "not bad", "a bad dog day"})
    left = lambda s: [h[2] for h in toxicity.hits(auto, s)]
    assert left("bad dog bad") == ["bad"] and left("not bad dog") == [] and left("a bad dog day dog") == ["dog"] and left("dog bad not bad") == ["dog", "bad"]


def naive_quality(model, text):
    """One passage after the other: encoder, gates, attention, score."""
    p, rows = model.p, quality.passages((text or "").encode(), common.WordIds())
    hs, es = [], []
    for x in rows:
        h = np.tanh((x - model.mean) / model.std @ p["W"] + p["b"])
        hs.append(h)
        es.append(float(np.tanh(h @ p["V"]) * (1 / (1 + np.exp(-(h @ p["U"])))) @ p["w"]))
    a = np.exp(np.array(es) - max(es))
    return float(1 / (1 + np.exp(-np.clip((a / a.sum()) @ np.array(hs) @ p["c"] + p["d"][0], -30, 30))))


def test_quality_equals_plain_attention(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    for r in docs.collect():
        mine, want = got[r["doc_id"]], naive_quality(model, r["text"])
        assert mine["score"] == pytest.approx(want, abs=1e-6) and mine["predicted"] == int(mine["score"] >= 0.7)
        assert mine["n_passages"] == max(1, -(-len((r["text"] or "").encode().split()) // quality.PASSAGE))


def test_toxicity_folds_and_excepts():
    auto = toxicity.automaton({"idiot": 3.0, "trash": 2.0}, {"trash can"})
    found = lambda s: [h[2] for h in toxicity.hits(auto, toxicity.folded(s.encode()))]
    assert found("You ID10T! Ｉdіоt; idiotic") == ["idiot", "idiot"]
    assert found("the trash can is full of trash") == ["trash"]
    assert toxicity.hits(toxicity.automaton({}, set()), "any") == []


@pytest.mark.parametrize("noise", [0.25, 0.36])
def test_recall_of_the_pivot_index(spark, noise):
    r = np.random.default_rng(0)
    base = r.normal(size=(800, 64))
    x = np.concatenate([base, base[:600] + noise * r.normal(size=(600, 64))])
    label = np.concatenate([np.arange(800) % 4, np.arange(600) % 4])
    rows = [(i, list(map(float, v)), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    got = {q["vec_id"]: q["n_links"] for q in pivot_index.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), chunk=50).collect()}
    n = x / np.linalg.norm(x, axis=1)[:, None]
    want = ((n @ n.T >= 0.93) & (label[:, None] == label[None, :])).sum(1) - 1
    assert all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.95 * want.sum() > 0


def one_dense_group(n, dim=64):
    """One label; a third of the rows near copies of one vector, a third others, a third pairs with these."""
    r = np.random.default_rng(1)
    k = n // 3
    group = pivot_index.unit(r.normal(size=(1, dim))) + 0.2 / np.sqrt(dim) * r.normal(size=(k, dim))
    base = pivot_index.unit(r.normal(size=(k, dim)))
    x = pivot_index.unit(np.concatenate([group, base, base + 0.25 / np.sqrt(dim) * r.normal(size=(k, dim))]))
    return x[r.permutation(len(x))]


@pytest.mark.parametrize("n, chunk", [(900, 1024), (9000, 100)])
def test_recall_in_a_dense_group(spark, n, chunk):
    """At two sizes tenfold apart; with small chunks a list goes to many blocks."""
    x = one_dense_group(n)
    df = spark.createDataFrame([(i, list(map(float, v)), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {q["vec_id"]: (q["n_links"], q["component_id"]) for q in pivot_index.near_duplicates(df, chunk=chunk).collect()}
    links = np.triu(x @ x.T >= 0.93, 1)
    want = links.sum(0) + links.sum(1)
    assert all(got[i][0] <= want[i] for i in got)
    assert sum(g[0] for g in got.values()) >= 0.999 * want.sum() > 0
    assert np.bincount([g[1] for g in got.values()]).max() == n // 3  # the group is one component
    pairs = want == 1  # and of the pairs nearly all are found
    assert np.mean([got[i][0] for i in np.flatnonzero(pairs)]) >= 0.98


@pytest.mark.parametrize("noise", [0.02, 0.1, 0.2])
def test_groups_of_any_width_count_all_their_links(spark, noise):
    """Bins that are linked throughout, in part and not at all; repeated vectors and other labels among them."""
    r = np.random.default_rng(3)
    x = pivot_index.unit(np.concatenate([r.normal(size=16) + noise * k * r.normal(size=(60, 16)) for k in (1, 2, 3)]))
    x = np.concatenate([x, x[::9]])
    label = np.arange(len(x)) % 2
    label[180:] = label[:180:9]
    df = spark.createDataFrame([(i, list(map(float, v)), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<double>, label int")
    got = {q["vec_id"]: (q["n_links"], q["component_id"]) for q in pivot_index.near_duplicates(df, chunk=7).collect()}
    links = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(links, True)
    assert {i: g[0] for i, g in got.items()} == dict(enumerate((links.sum(1) - 1).tolist()))
    assert {i: g[1] for i, g in got.items()} == dict(enumerate(pivot_index._roots(links).tolist()))


def shared(perm):
    """Whether the first pivot of each is among the other's, for all pairs."""
    holds = np.zeros((len(perm), perm.max() + 1), bool)
    for p in perm.T:
        holds[np.flatnonzero(p >= 0), p[p >= 0]] = True
    one = holds[:, perm[:, 0]]
    return one & one.T


@pytest.mark.parametrize("pivots", [4096, 8192, 16_384])
def test_recall_with_very_many_pivots(pivots):
    """Pairs just above the threshold among evenly spread vectors, the hardest ones."""
    r = np.random.default_rng(5)
    table = pivot_index.unit(r.normal(size=(pivots, 64)))
    x, way = (pivot_index.unit(r.normal(size=(1500, 64))) for _ in range(2))
    way = pivot_index.unit(way - (way * x).sum(1, keepdims=True) * x)
    c = 0.93 + 0.005 * r.random((1500, 1))
    a, b = (pivot_index.described(v, table, pivot_index.nearest_of(pivots), 0.93)[0] for v in (x, c * x + np.sqrt(1 - c * c) * way))
    assert ((a == b[:, :1]).any(1) & (b == a[:, :1]).any(1)).mean() >= 0.9


def test_recall_at_the_largest_pivot_count():
    x = one_dense_group(9000)
    pivots = pivot_index.spread(x[:4096], 2048, 0.93)
    assert len(pivots) > 1900
    links = x @ x.T >= 0.93
    np.fill_diagonal(links, False)
    found = links & shared(pivot_index.described(x, pivots, pivot_index.nearest_of(2048), 0.93)[0])
    assert found.sum() >= 0.999 * links.sum() > 0
    pairs = links.sum(1) == 1
    assert found[pairs].sum() >= 0.98 * pairs.sum() > 5000


def test_vectors_that_cannot_link(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1, "a"), (2, v, 1, "b"), (3, v, 2, "c"), (4, None, 1, "d"), (5, [0.0, 0.0, 0.0], 1, "e"), (6, [1.0, None, 3.0], 1, "f"), (7, [1.0, float("nan"), 3.0], 1, "g"), (8, v, None, "h"), (9, [2.0, 4.0, 6.1], 1, "i"), (None, v, 1, "j"), (10, [1.0, 2.0], 1, "k")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pivot_index.near_duplicates(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[9] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 10))
    assert got[None] == (0, None, None)


def links_of(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_chains_of_near_copies(spark):
    """Copies with more and more edits: some link only by way of others."""
    r = random.Random(5)
    base = [f"w{r.randrange(500)}" for _ in range(120)]
    texts = [(1, " ".join(base)), (2, ""), (3, None), (4, "one"), (5, "ONE"), (6, "a b c"), (7, "A b  c")]
    for i in range(10, 70):
        own = list(base)
        for _ in range(r.randrange(0, 6)):
            own[r.randrange(120)] = f"v{r.randrange(9000)}"
        texts.append((i, " ".join(own)))
    grow = list(base)
    for i in range(70, 90):
        grow[i] = "new"
        texts.append((i + 100, " ".join(grow)))
    got = ngram_join.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got.collect()} == links_of(texts)


def test_six_shingles_link_with_seven(spark):
    """6 of 7 shingles are 85 in 100: nine words and one more at either end, and texts that cycle."""
    nine = "a b c d e f g h i"
    texts = [(1, nine), (2, nine + " j"), (3, "k l m n o p q r s"), (4, "z k l m n o p q r s"), (5, "u v w x y t " * 40), (6, "u v w x y t " * 40 + "u v w new")]
    texts += [(7, "aa ab ac ad ae af ag ah"), (8, "aa ab ac ad ae af ag ah ai")]  # 5 of 6 do not
    want = links_of(texts)
    assert [want[i][1] for i in range(1, 9)] == [1, 1, 3, 3, 5, 5, 7, 8]
    got = ngram_join.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got.collect()} == want


def test_rounds_go_over_open_columns_only(spark, monkeypatch):
    """Few pairs too take the hub round, and what comes after it reads no column whose rows are one component."""
    r, texts, seen = random.Random(3), [], []
    word = lambda: f"w{r.randrange(99999)}"
    for i in range(0, 120, 2):
        own = [word() for _ in range(60)]
        texts += [(i, " ".join(own)), (i + 1, " ".join([*own, word()]))]
    passage = [word() for _ in range(30)]
    texts += [(i, " ".join([*passage, *(word() for _ in range(9))])) for i in range(200, 212)]
    keep = ngram_join.written

    def noted(df, name):
        out = keep(df, name)
        seen.append((name, out.count(), out.select("token").distinct().count() if "token" in out.columns else 0))
        return out

    monkeypatch.setattr(ngram_join, "written", noted)
    got = ngram_join.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got.collect()} == links_of(texts)
    rows = {name: n for name, n, _ in reversed(seen)}  # the first of each name
    assert 0 < rows["open"] < rows["blocks"] and rows["labelled"] == rows["open"]
    columns = [n for name, _, n in seen if name == "lists"]
    assert columns[0] - columns[1] > 60  # the pairs' columns; the passage's ones stay


def test_a_passage_in_very_many_texts(spark):
    """Texts that share a long passage, in short ones nearly all they have; groups of near copies among them."""
    r = random.Random(9)
    word = lambda: f"w{r.randrange(99999)}"
    passage = [word() for _ in range(60)]
    texts = [(i, " ".join([word() for _ in range(r.randrange(3, 25))] + passage + [word() for _ in range(r.randrange(0, 25))])) for i in range(250)]
    for i in range(250, 330):
        own = passage + [word() for _ in range(r.randrange(0, 9))]
        texts.append((i, " ".join(own)))
    got = ngram_join.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string").repartition(8))
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got.collect()} == links_of(texts)


def test_components_of_a_long_path(spark):
    n = 700
    order = list(range(n))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(5000, 5001), (5001, 5000), (6000, 6000)], "u long, v long")
    got = {x["node"]: x["root"] for x in common.components(edges).collect()}
    assert got == dict.fromkeys(range(n), 0) | {5000: 5000, 5001: 5000}


LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [(1, "The same text", "en", "s"), (1, "The same text", "en", "s"), (2, "tHE SAME TEXT", None, None), (3, None, "en", None), (4, "", "de", "s"), (None, "no id at all here", "de", "t"), (5, " \n\t ", "en", "t"), (6, LONG, "en", "t"), (7, "1234 5678", None, "t")]
CLASH = ["n", "key", "node", "word", "h", "size", "n_words", "label", "score", "position", "token", "h_", "lo", "hi", "y", "target"]


def odd(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH], F.lit(5).cast("long").alias("n_chars"))


def labels(spark, rows=((1, 1, 0), (2, 0, 1), (6, None, None), (None, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "pieces": lambda s, d: sentencepieces.encode(d),
    "join": lambda s, d: ngram_join.jaccard_components(d),
    "quality": lambda s, d: quality.quality(d, labels(s)),
    "exact": lambda s, d: exact_dedup.exact_dedup(d),
    "mix": lambda s, d: mixing.mix(d),
    "pii": lambda s, d: pii.personal_data(d),
    "language": lambda s, d: language.identify(d),
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s)),
    "repeats": lambda s, d: suffix_dedup.repeated_passages(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_and_empty_tables(spark, name):
    rows = OPERATORS[name](spark, odd(spark)).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r.asDict() for r in rows}
    assert OPERATORS[name](spark, odd(spark, [])).count() == 0
    if name == "pieces":
        assert by[3]["n_tokens"] == by[4]["n_tokens"] == 0 and by[6]["round_trip"]
    if name == "join":
        assert by[2]["component_id"] == 1 and by[None]["component_id"] is None and by[3]["n_shingles"] == 0 and by[5]["component_id"] == 5
    if name == "exact":
        assert by[1]["keep_id"] == 2 and by[1]["group_size"] == 3 and by[4]["keep_id"] == 4 and by[3]["keep_id"] == 4 and by[4]["group_size"] == 2
    if name == "mix":
        assert by[3]["size"] == 0 and by[5]["taken"] == 0 and by[6]["size"] == 100_000
    if name == "language":
        assert by[3]["lang_pred"] == by[7]["lang_pred"] == "und" and by[7]["score"] == 0.0
    if name in ("quality", "toxicity"):
        assert all(0 <= r["score"] <= 1 for r in rows)
    if name == "repeats":
        assert by[6]["n_repeated"] == 0 and by[3]["n_words"] == 0


def test_no_labels_at_all(spark):
    none = labels(spark, ())
    assert {r["predicted"] for r in toxicity.toxicity(odd(spark), none).collect()} == {0}
    assert {r["score"] for r in quality.quality(odd(spark), none).collect()} == {0.5}


def test_empty_vectors(spark):
    assert pivot_index.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_mix_targets(spark):
    rows = [(i, "w " * (1 + i % 7), None, s) for i, s in enumerate(["a"] * 300 + ["b"] * 30 + [None] * 170)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    src = {i: s for i, _, _, s in rows}
    sizes: dict = {}
    taken: dict = {}
    target: dict = {}
    for r in got.collect():
        s = src[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        assert (r["position"] is not None) == (r["taken"] > 0) and (r["position_2"] is not None) == (r["taken"] == 2 * r["size"])
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(target[s] <= 2 * sizes[s] + 1e-6 and abs(taken[s] - target[s]) <= 8 for s in sizes)


def test_mix_of_rows_alike(spark):
    """A third of the rows share one id, others have none: each row is placed for itself."""
    rows = [(7, "a b c", None, "s")] * 300 + [(None, "w " * (1 + i % 5), None, "s") for i in range(300)] + [(i, "x y", None, "t") for i in range(100, 400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == 900 and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    for size, keys in ((300 * 3 + 60 * 15, (7, None)), (600, None)):
        own = [r for r in got if (r["doc_id"] in (7, None)) == (keys is not None)]
        assert {r["source_size"] for r in own} == {size} and abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 5
    middles = [p for r in got for p in (r["position"], r["position_2"]) if p is not None and r["doc_id"] == 7]
    assert len(set(middles)) == len(middles)


def test_directory_doubles(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    slots, depth = exact_dedup.directory(keys, capacity=100)
    got = slots.collect()
    assert depth > 4 and sorted(r["slot"] for r in got) == list(range(1 << depth))
    held = exact_dedup.placed(keys, slots, depth).groupBy("bucket", "local_depth").count().collect()
    assert sum(r["count"] for r in held) == 3000 and max(r["count"] for r in held) <= 100
    # a bucket was split only because the one it came from was overfull
    sizes = {}
    for r in keys.collect():
        for d in range(depth + 1):
            k = (d, (r["key"] & (1 << 64) - 1) >> 64 - d)
            sizes[k] = sizes.get(k, 0) + 1
    assert all(r["local_depth"] == 0 or sizes[r["local_depth"] - 1, r["bucket"] >> exact_dedup.MAX_DEPTH - r["local_depth"] + 1] > 100 for r in held)
    assert exact_dedup.directory(keys, capacity=3000)[1] == 0


@pytest.mark.parametrize("bits", [0, 3, 64])
def test_keys_that_collide_are_chained(spark, bits):
    """With few bits most texts share a key: bytes tell them apart in the bucket, chains lead to them."""
    rows = [(i, f"Text {i % 40}" if i % 3 else f"tEXT {i % 40}") for i in range(200)] + [(500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bits = bits or 1
    index, slots, depth = exact_dedup.build_index(df, capacity=4, bits=bits)
    assert (index.where("chained > 1").count() > 0) == (bits < 64)
    assert index.groupBy("bucket", "key").agg(F.max("chain").alias("a"), F.max("chained").alias("b"), F.count("*").alias("c")).where("a <> b or b <> c").count() == 0
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(df, capacity=4, bits=bits).collect()}
    groups: dict = {}
    for i, t in rows:
        groups.setdefault((t or "").lower(), []).append(i)
    assert got == {i: (max(g), len(g), i == max(g)) for g in groups.values() for i in g}


def test_results_come_through_the_index(spark):
    df = spark.createDataFrame([(i, f"t {i // 2}") for i in range(400)], "doc_id long, text string")
    index, slots, depth = exact_dedup.build_index(df, capacity=10)
    rows = exact_dedup.keyed(df)
    assert depth > 2 and exact_dedup.probed(rows, index, slots, depth).count() == 400
    bucket = index.agg(F.min("bucket")).first()[0]
    lost = index.where(F.col("bucket") == bucket).agg(F.sum("group_size")).first()[0]
    assert exact_dedup.probed(rows, index.where(F.col("bucket") != bucket), slots, depth).count() == 400 - lost
    moved = slots.withColumn("bucket", F.lit(bucket))  # a directory that sends all to one bucket finds only its entries
    assert exact_dedup.probed(rows, index, moved, depth).count() == lost


def test_words_with_one_hash_are_told_apart():
    table = sentencepieces.Pieces()
    cutter = sentencepieces.Cutter(table.pairs)
    texts = ["abcdefghij abcdefgihj abcdefghji", None, "", " x  y\nz", "the the the"]
    whole, start, size, h, check, n = cutter(texts)
    words = sentencepieces.sliced(whole, start, size)
    assert "".join(words) == whole and n.tolist()[1:3] == [0, 0] and len(set(h.tolist())) == len(set(words))
    alone = cutter.of(words)
    assert (alone[0] == h).all() and (alone[1] == check).all()
    d = sentencepieces.Dictionary(["▁the"], [[5]], table.pairs)
    assert [w for w, i in zip(words, d.number(h, check), strict=True) if i == 0] == ["▁the"] * 3
    d.check = d.check + np.uint64(1)  # another word with this hash
    assert (d.number(h, check) == -1).all()


def test_pieces_that_never_win_stay_out_of_the_lattice():
    rows = [("a", 1, -5.0), ("b", 2, -5.0), ("c", 3, -9.0), ("ab", 4, -1.0), ("abc", 5, -11.0), ("bc", 6, -14.0), ("cc", 7, -17.0)]
    assert [p for p, _, _ in sentencepieces.useful(rows)] == ["a", "b", "c", "ab", "bc", "cc"]  # bc: a tie stays
    assert sentencepieces.useful([("a", 1, -0.5), ("aa", 2, -9.0)]) == [("a", 1, -0.5), ("aa", 2, -9.0)]
    table, r = sentencepieces.Pieces(), random.Random(3)
    every, some = ({p: s for p, _, s in rows} for rows in (table.rows, table.useful))
    assert len(some) < len(every) / 2
    for _ in range(300):
        text = "".join(r.choice(table.rows)[0] for _ in range(r.randint(1, 6)))
        ways = []
        for score in (every, some):
            best = [(0.0, ())]
            for e in range(1, len(text) + 1):  # of equal sums the shorter last piece
                best.append(max(((best[e - n][0] + score[text[e - n : e]], -n, best[e - n][-1]) for n in range(1, e + 1) if text[e - n : e] in score), key=lambda w: w[:2]))
                best[-1] = (best[-1][0], (*best[-1][2], -best[-1][1]))
            ways.append(best[-1])
        assert ways[0] == ways[1]


def test_a_lattice_has_a_row_for_each_place(spark):
    """Not one for each substring; pieces of all lengths, also where the pieces have to start before the text's end."""
    table, r = sentencepieces.Pieces(), random.Random(5)
    score = {p: (i, x) for p, i, x in table.useful}
    many, few = [p for p, _, _ in table.useful if len(p) > 3], [p for p, _, _ in table.useful if len(p) < 4]
    texts = {"".join(r.choice(many if r.random() < 0.5 else few) for _ in range(r.randint(1, 7))) for _ in range(300)} | {p for p in many if len(p) > 12} | {"ጀ", "aጀb"}
    units = [(t, len(t) - (i % 4 and r.randrange(min(len(t), table.longest))), i) for i, t in enumerate(sorted(texts))]
    got = sentencepieces.lattices(spark.createDataFrame(units, "text string, body int, n long"), table)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1
    got = {x["text"]: x for x in got.collect()}
    assert len(got) == len(units)
    for text, body, n in units:
        best = [(0.0, [])]
        for e in range(1, len(text) + 1):
            ways = []
            for size in range(1, min(table.longest, e) + 1):
                i, x = score.get(text[e - size : e], (-1 - ord(text[e - 1]), table.unknown_score) if size == 1 else (0, None))
                if x is not None and e - size < body and best[e - size]:
                    ways.append((best[e - size][0] + x, -size, best[e - size][1] + [i]))
            best.append(max(ways, key=lambda w: w[:2])[::2] if ways else None)
        assert got[text]["n"] == n and len(got[text]["exits"]) == len(text) - body + 1
        for way, have in zip(best[body:], got[text]["exits"], strict=True):
            assert (have["s"], list(have["t"])) == way if way else have["s"] < -1e17


def test_a_dictionary_finds_its_words_in_a_few_steps():
    table = sentencepieces.Pieces()
    words = [f"w{i}" for i in range(5000)]
    d = sentencepieces.Dictionary(words[:3000], [[i] for i in range(3000)], table.pairs)
    h, check = sentencepieces.Cutter(table.pairs).of(words)
    assert d.number(h, check).tolist() == [*range(3000), *[-1] * 2000]
    assert np.bincount(d.begin).max() < 40 and np.diff(d.begin).max() < 12
    ends = np.array([0, 2**64 - 1], np.uint64)
    for x in (d, sentencepieces.Dictionary([], [], table.pairs)):
        assert x.number(ends, np.zeros(2, np.uint64)).tolist() == [-1, -1]
        assert len(x.number(h[:0], check[:0])) == 0
