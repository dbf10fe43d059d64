"""From raw documents to packed sequences: five stages, each on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.exact_dedup import exact_dedup
from orderloom.llm.mixing import draw_copies, mix_sources
from orderloom.llm.ngram_join import drop_near_duplicates
from orderloom.llm.packing import pack_documents
from orderloom.llm.quality_rules import quality_rules
from orderloom.llm.queries import language_labels, tokenizer_path
from orderloom.llm.scratch import Scratch, collected, free_name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; a null text is rejected."""
    row = free_name(docs, "_row")
    return quality_rules(docs, carry=row).filter("kept").select(f"{row}.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text one stays, a row with the largest doc_id.

    Rows that repeat both doc_id and text are one document. Only where there are
    such rows do whole rows go through a second shuffle.
    """
    marked = exact_dedup(docs)
    sha, kept_id, kept_sha = (free_name(docs, n) for n in ("_sha", "_kept_id", "_kept_sha"))
    kept = marked.filter("kept").select(
        F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha)
    )
    keyed = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")), 256))
    same = (F.col(sha) == F.col(kept_sha)) & F.col("doc_id").eqNullSafe(F.col(kept_id))
    found = keyed.join(kept, same, "left_semi")
    copies = marked.filter("group_size > 1").groupBy("doc_id", "text_sha256").count()
    if not copies.filter("count > 1").isEmpty():
        found = found.dropDuplicates(["doc_id", sha])
    return found.drop(sha)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that of the smallest doc_id."""
    return drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small languages are repeated towards the target weights; none goes."""
    mix = free_name(docs, "_mix")
    return draw_copies(mix_sources(docs, language_labels(spark, sf_dir), into=mix), mix)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near duplicates", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The mixing and packing stages have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again.

    Once it is written, the stage's input and all that its operators wrote on
    their way are removed.
    """
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        table = name.replace(" ", "-")
        with collected() as made:
            docs = scratch.store(table, stage(spark, docs, sf_dir))
        for opened in made:
            opened.drop(*opened.paths)
        if before is not None:
            scratch.drop(before)
        before = table
    return docs
