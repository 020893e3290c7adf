"""The corpus pipeline: stages applied to ``documents`` in turn.

Every stage works on all rows its predecessor kept and its decisions take effect; all but the
last return the columns of ``documents``. The result has a row for every document of the mix
(twice, if the mix takes it twice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import line_dedup, mixture, ngram_join, piece_encoder, toxicity
from reelrank.llm.catalog import piece_vocabulary
from reelrank.llm.common import DOCUMENT_COLUMNS, ship, table
from reelrank.session import new_path, stage


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model rejects; null and empty texts stay."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs.select(DOCUMENT_COLUMNS), model)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated windows of lines; ``n_chars`` follows the text."""
    deduped = line_dedup.dedup_lines(docs.select(DOCUMENT_COLUMNS))
    changed = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return deduped.withColumn("n_chars", changed.cast("long")).select(DOCUMENT_COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every group of near duplicates: of the smallest id, then text hash.

    Every row has a key of its own, so rows of equal id are told apart; a null id comes last. Rows without
    words are linked with nothing and stay.
    """
    key = F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(docs.select(key.alias("_key"), *DOCUMENT_COLUMNS), "pipeline-rows")
    groups = ngram_join.near_duplicates(rows, "_key")
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("_key"))
    return rows.join(kept, "_key", "left_semi").select(DOCUMENT_COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources; a document that is taken twice is there twice.

    Documents of equal id are taken alike, a null source is a source of its own, and documents without
    words stay or go with the hash of their id.
    """
    _, cuts = mixture.plan(docs)
    return (
        mixture.mix(docs.select(DOCUMENT_COLUMNS), cuts)
        .where("repeats > 0")
        .selectExpr(*DOCUMENT_COLUMNS, "explode(sequence(1, repeats)) AS _copy")
        .drop("_copy")
    )


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of what they decode to.

    Null and empty texts have no ids; every row has a result.
    """
    coded = piece_encoder.encode_texts(docs, piece_vocabulary(), with_text=False)
    return coded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", clean_language),
    ("line dedup", fresh_lines),
    ("near duplicates", one_of_each),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: SQL can't express the encoder; the tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written and read again by the next."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
