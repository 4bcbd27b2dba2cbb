"""The pipeline against brute force, stage by stage."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from hydrapix.llm import sentencepieces
from hydrapix.llm import toxicity as tox
from tests.llm.test_contracts import brute_pieces, links_of

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "ngram_jaccard_join", "mix_sources", "sentencepiece"]
    first = stages["toxicity"](spark, docs, SF).persist()
    scored = tox.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert sorted(r["doc_id"] for r in first.collect()) == sorted(r["doc_id"] for r in scored.where("predicted = 0").collect())
    second = stages["exact_dedup"](spark, first, SF).persist()
    last: dict = {}
    for r in first.collect():
        t = r["text"].encode().lower()
        last[t] = max(last.get(t, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in second.collect()) == sorted(last.values())
    third = stages["ngram_jaccard_join"](spark, second, SF).persist()
    groups = links_of([(r["doc_id"], r["text"]) for r in second.collect()])
    assert sorted(r["doc_id"] for r in third.collect()) == sorted(i for i, (_, root) in groups.items() if i == root)
    fourth = stages["mix_sources"](spark, third, SF).persist()
    size = {r["doc_id"]: len(r["text"].split()) for r in third.collect()}
    times = Counter(r["doc_id"] for r in fourth.collect())
    assert max(times.values()) <= 2 and 1.2 < sum(size[i] * n for i, n in times.items()) / sum(size.values()) < 1.8
    assert all(df.columns == docs.columns for df in (first, second, third, fourth))
    table = sentencepieces.Pieces()
    text = {r["doc_id"]: r["text"] for r in fourth.collect()}
    got = stages["sentencepiece"](spark, fourth, SF).collect()
    assert Counter(r["doc_id"] for r in got) == times and all(r["round_trip"] for r in got)
    for r in got[:40]:
        assert list(r["token_ids"]) == brute_pieces(table, text[r["doc_id"]])


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).where("round_trip").count() > 100


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "same row here now", "en", "a", 1)] * 2 + [(None, "no id but a text", "en", "a", 1), (2, None, "en", "b", 0), (3, "other words in this one", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    assert Counter(r["doc_id"] for r in stages["exact_dedup"](spark, docs, SF).collect()) == {1: 1, None: 1, 2: 1, 3: 1}
    assert Counter(r["doc_id"] for r in stages["ngram_jaccard_join"](spark, docs, SF).collect()) == {1: 2, None: 1, 2: 1, 3: 1}
    times = Counter(r["doc_id"] for r in stages["mix_sources"](spark, docs, SF).collect())
    assert 2 not in times and times[1] <= 4 and max(times[None], times[3]) <= 2


KIND = "doc_id long, text string, lang string, source string, n_chars long"


def test_one_row_of_equal_texts(spark):
    """Rows without an id or with one that repeats; a kept row keeps no other row of its id."""
    rows = [(None, "one text here"), (None, "another text"), (2, "one TEXT here"), (2, "same id"), (2, "one text here"), (None, "another text"), (5, None), (4, "")]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], KIND)
    got = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, SF).collect()
    assert sorted((str(r["doc_id"]), (r["text"] or "").lower()) for r in got) == [("2", "one text here"), ("2", "same id"), ("5", ""), ("None", "another text")]


def test_columns_of_any_name_and_long_texts(spark):
    names = ["_id", "_times", "_copy", "kept_id", "times", "copy", "no_id", "digest", "taken", "size", "position", "key", "norm", "node", "a.b", "y"]
    rows = [(1, "word " * 60_000, "en", "a", 1), (2, "word " * 60_000, "en", "b", 1), (3, "other words in this one", "en", "b", 1), (4, None, "en", None, 1)]
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], KIND + "".join(f", `{n}` int" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert {tuple(r)[5:] for r in got.collect()} == {tuple(range(len(names)))}, name
    assert {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, SF).collect()} == {2, 3, 4}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).where("round_trip").count() == 4


def test_empty_documents(spark):
    docs = spark.createDataFrame([], KIND)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def shingles(text, n):
    w = text.lower().split()
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}


def test_near_copies_of_five_words_and_80(spark):
    """Copies with a tail of 15 to 30 % or a changed word in 47; texts of four to eight words."""
    r = random.Random(7)
    texts = []
    for tail in (15, 20, 24, 26, 30):
        own = [f"w{r.randrange(9000)}" for _ in range(104)]
        texts += [own, own + [f"t{r.randrange(9000)}" for _ in range(tail)]]
    own = [f"w{r.randrange(9000)}" for _ in range(47 * 4)]
    texts += [own, [f"c{i}" if i % 47 == 23 else w for i, w in enumerate(own)]]
    for n in (4, 5, 6, 7, 8):
        own = [f"s{n}{i}" for i in range(n)]
        texts += [own, [*own, "more"]]
    rows = [(i, " ".join(w), "en", "a", 1) for i, w in enumerate(texts)]
    sets = [shingles(t, 5) for _, t, *_ in rows]
    want = [i for i in range(len(rows)) if i % 2 == 0 or 100 * len(sets[i] & sets[i - 1]) < 80 * len(sets[i] | sets[i - 1])]
    old = [shingles(t, 4) for _, t, *_ in rows]
    assert any(i not in want and 100 * len(old[i] & old[i - 1]) < 85 * len(old[i] | old[i - 1]) for i in range(1, len(rows), 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(x["doc_id"] for x in dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, SF).collect()) == want
