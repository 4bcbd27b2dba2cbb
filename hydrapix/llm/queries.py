"""The queries of this subpackage, by the names that __spark_entry__.py registers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import collocations, exact_dedup, language, mixing, ngram_join, pii, pivot_index, quality, secret_scan, sentencepieces, spelling, suffix_dedup, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(_documents(spark, sf_dir))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_documents(spark, sf_dir))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(_documents(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (op1_sentencepiece, op2_ngram_join, op3_quality, op4_exact_dedup, op5_mixing, op6_pii, op7_language, op8_toxicity, op9_embedding_near_dedup, op10_suffix_dedup, op11_spelling_variants, op12_secret_scan, op13_collocations)
}
ORACLE_SQL = {"op2_ngram_join": ngram_join.ORACLE_SQL, "op4_exact_dedup": exact_dedup.ORACLE_SQL, "op5_mixing": mixing.ORACLE_SQL, "op9_embedding_near_dedup": pivot_index.ORACLE_SQL, "op11_spelling_variants": spelling.ORACLE_SQL, "op13_collocations": collocations.ORACLE_SQL}
