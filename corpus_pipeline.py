"""The corpus pipeline: language, quality, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
as Parquet and read again as the next one's docs. All but the last keep the
columns of documents. Every stage judges whole texts of all documents that its
predecessor kept, and learns, where it learns, from those alone that models may learn from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import language_id, near_dup, packing, quality_rules, secret_scan
from chartloom.llm.common import held_out, release, staged_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents of a language that is less certain than this go.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; those without a letter, or without a clear language, go."""
    model = language_id.learn(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    kept = language_id.predict(docs.select(COLUMNS), model, keep=COLUMNS)
    if not model.languages:  # nothing to learn from: nothing to reject by
        return docs.select(COLUMNS)
    return kept.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that all quality rules keep."""
    scored = quality_rules.with_words(docs.select(COLUMNS)).withColumns({f"__{k}": c for k, c in quality_rules.measures().items()})
    # A filter would be pushed below the projection, which would then measure a text again for each condition.
    # Exploding one item or none keeps the rows that a filter would, and measures once.
    return scored.select(*COLUMNS, F.explode(F.when(quality_rules.kept_by(prefix="__"), F.array(F.lit(1))))).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least doc_id. Documents without a doc_id stay."""
    return near_dup.first_rows(docs.select(COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; n_chars follows a changed text."""
    before = F.col("text")
    clean = secret_scan.redact(docs.select(*COLUMNS, before.alias("__before")))
    changed = F.col("text") != F.col("__before")
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = staged_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        release(spark)
        docs = spark.read.parquet(path)
    return docs


#: Language models, sampling and tokenizers are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None
