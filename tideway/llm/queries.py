"""The registered queries of this subpackage, and their SQL."""

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontam, jaccard, langid, packing, periods, phrases, pieces, pii, quality, repeats, secrets, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.query(_read(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(_read(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(_read(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.query(_read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.query(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_read(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(_read(spark, sf_dir, "conversations"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_read(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.query(_read(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.query(_read(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_pii": op4_pii,
    "op5_language_id": op5_language_id,
    "op6_decontamination": op6_decontamination,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_chat_format": op8_chat_format,
    "op9_secrets": op9_secrets,
    "op10_quality_rules": op10_quality_rules,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_best_fit_packing": op13_best_fit_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op3_suffix_dedup": repeats.SQL,
    "op4_pii": pii.SQL,
    "op6_decontamination": decontam.SQL,
    "op7_ngram_jaccard": jaccard.SQL,
    "op9_secrets": secrets.SQL,
    "op10_quality_rules": quality.SQL,
    "op11_phrase_collocations": phrases.SQL,
    "op12_periodic_runs": periods.SQL,
}
