"""A training corpus from documents: quality, near duplicates, benchmark passages, secrets, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs; all but the last return the columns of documents,
with any others that docs has, whatever their names. All stages take rows with nulls in any
column, empty and very long texts, repeated rows and empty tables.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideway.llm import decontam, jaccard, pieces, quality, secrets
from tideway.llm.store import materialize, scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go.

    A null or empty text has no words and goes; repeated rows are judged alike and count once
    each for the thresholds; null languages and sources are groups of their own.
    """
    return quality.keep(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays: the one with the least doc_id, nulls last.

    Rows are compared by text, so repeated rows and rows with a null or repeated id are copies like
    others, and one of equals stays (of equal ids any); texts without a word are linked with nothing and stay.
    """
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go.

    Texts without a word stay, and items without a word are ignored; an empty benchmark leaves all.
    """
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that look live are masked in the text, and n_chars, where docs has it, follows it.

    No row goes; null and empty texts stay as they are, and a null source is one of its own.
    """
    masked = secrets.redact(docs)
    if "n_chars" not in masked.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, decoded_sha256, lossless of every row.

    Null and empty texts have no pieces; rows of equal id and text get equal pieces.
    """
    return pieces.query(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("sentencepiece", sentencepiece),
]

#: SentencePiece sampling has no SQL form; tests/llm/test_pipeline.py holds every stage and run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage wrote goes once the next one has read it; the result reads the last but one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scope(spark):
        for _, stage in STAGES[:-2]:
            with scope(spark):
                docs = materialize(stage(spark, docs, sf_dir), keep=True)
        docs = materialize(STAGES[-2][1](spark, docs, sf_dir), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
