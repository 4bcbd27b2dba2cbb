"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again as the next one's input.

Cases: of rows with equal texts one stays, also where they share a doc_id or have none; rows with one doc_id and other
texts stay or go together in the n-gram join (a group's smallest id stays) and are mixed equally often (each at most
twice); a null doc_id is an id like others and links with nothing in the n-gram join; null and empty texts are equal, and
stay until the mix, which takes no empty ones; texts of any length are read whole; empty tables give empty tables; extra
columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrapix.llm import exact_dedup as exact
from hydrapix.llm import mixing, ngram_join, sentencepieces
from hydrapix.llm import toxicity as tox
from hydrapix.llm.common import dropped, fold_ascii, written


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that docs has no column of."""
    taken = {c.lower() for c in docs.columns}
    longest = max(map(len, taken), default=0)
    return [n if n not in taken else n + "_" * (longest + 1) for n in names]


def _all(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _kept(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of docs whose id is in decided; all columns of docs."""
    (name,) = _free(docs, "kept_id")
    ids = decided.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids[name]), "left_semi").select(*_all(docs))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic. The verdict is per row, so no join is needed for it."""
    model = tox.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return tox.clean(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts a row with the largest doc_id stays: one, if several rows have that id."""
    key = _free(docs, "kept_id", "no_id", "digest")
    keyed = lambda df, digest: [F.coalesce("doc_id", F.lit(0)).alias(key[0]), F.col("doc_id").isNull().alias(key[1]), digest.alias(key[2])]
    decided = exact.exact_dedup(docs).where("kept")
    decided = decided.select(*keyed(decided, F.col("text_sha256"))).distinct()
    digest = F.sha2(fold_ascii(F.coalesce("text", F.lit(""))), 256)
    # copies combine in the tasks that read them; what is left meets the verdicts without another shuffle
    rows = docs.select(*_all(docs), *keyed(docs, digest)).dropDuplicates(key)
    return rows.join(decided, key, "left_semi").select(*_all(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 80 in 100 of their 5-word shingles the one with the smallest doc_id stays."""
    return _kept(docs, ngram_join.jaccard_components(docs, gram=5, percent=80).where("doc_id <=> component_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (not at all, once or twice)."""
    name, times, copy = _free(docs, "kept_id", "times", "copy")
    each = F.max(F.col("taken") / F.col("size")).cast("int").alias(times)
    plan = written(mixing.mix(docs.select("doc_id", "source", "text")).where("taken > 0").groupBy(F.col("doc_id").alias(name)).agg(each), "plan")
    out = docs.join(plan, docs["doc_id"].eqNullSafe(plan[name])).where(F.length("text") > 0)
    return out.select(*_all(docs), F.explode(F.sequence(F.lit(1), F.col(times))).alias(copy)).select(*_all(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each row: doc_id, n_tokens, token_ids, round_trip."""
    return sentencepieces.encode(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

#: The toxicity model and the byte-pair table have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"stage-{name}")
        dropped(before)  # of a table that a stage has written nothing is read any more
    return STAGES[-1][1](spark, docs, sf_dir)
