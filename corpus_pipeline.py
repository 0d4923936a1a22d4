"""The corpus pipeline: quality, line dedup, near duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the shared folder and read again as the next one's docs. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import bpe, jaccard, line_dedup, mixing, quality, queries
from turnloom.llm.common import WORD, fresh, table, written

#: No SQL can express the classifier, the Jaccard join and the encoding.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it learns from labels of documents that aren't held out."""
    labels = table(spark, sf_dir, "labels").where(~queries.held_out(3, 1))
    machine = quality.train(docs, labels)
    added = fresh(docs, "_score"), fresh(docs, "_predicted")
    return quality.scored(docs, machine, added=added).where(F.col(added[1]) == 1).select(*docs.columns)


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a smaller document has; n_chars follows the text, and documents left empty go."""
    added = fresh(docs, "_all"), fresh(docs, "_dropped")
    kept = line_dedup.dedup_lines(docs, min_chars=10, added=added)
    return _measured(kept.where((F.col("text") != "") | (F.col(added[1]) == 0)), docs)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles at 0.8 or more."""
    return jaccard.one_of_each(docs, n=5, threshold=(4, 5))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes; a copy in which its source is cut off ends there.

    Rows that repeat an id or have a null one are documents of their own. Null and empty texts stay once.
    """
    key, size, taken = (fresh(docs, n) for n in ("_key", "_size", "_taken"))
    # written with the key, so that both sides of the join have the same one
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-keyed")
    mix = mixing.mix_sources(keyed, key_column=key).groupBy("key", "copy").agg(F.first("size").alias(size), F.sum("taken").alias(taken))
    mix = mix.where((F.col(taken) > 0) | ((F.col(size) == 0) & (F.col("copy") == 0))).select(F.col("key").alias(key), size, taken)
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)), F.lit(1), F.col(taken).cast("int")), "")
    return _measured(keyed.join(mix, key).withColumn("text", F.when(F.col(taken) < F.col(size), first).otherwise(F.col("text"))), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's number of tokens, and hashes of its ids and of the text decoded from them."""
    return bpe.encode_decode(docs, queries.vocabulary_path())


def _measured(rows: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_filter),
    ("ngram_jaccard_join", near_duplicate_filter),
    ("source_mixing", source_mix),
    ("bpe_encode_decode", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
