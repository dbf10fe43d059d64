"""The operators' registered queries over the whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import oracle
from orderloom.llm.chat_format import chat_format
from orderloom.llm.exact_dedup import exact_dedup
from orderloom.llm.html_extract import extract_text
from orderloom.llm.language_id import predict_languages
from orderloom.llm.merkle import merkle_manifest
from orderloom.llm.line_dedup import line_dedup
from orderloom.llm.mixing import mix_sources
from orderloom.llm.ngram_join import ngram_components
from orderloom.llm.packing import pack_documents
from orderloom.llm.quality_classifier import classify_quality
from orderloom.llm.quality_rules import quality_rules
from orderloom.llm.resample import importance_resample
from orderloom.llm.substring_dedup import substring_dedup

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLE[run.__name__] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(oracle.SUBSTRING_DEDUP)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"))


@query()
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


@query(oracle.CHAT_FORMAT)
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format(_table(spark, sf_dir, "conversations"))


@query(oracle.EXACT_DEDUP)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


@query(oracle.QUALITY_RULES)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


@query()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(_table(spark, sf_dir, "documents"))


@query(oracle.NGRAM_JOIN)
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"))


@query()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents"))


@query()
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages are the domains; smaller ones are raised, none shrinks."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed = mix_sources(docs, language_labels(spark, sf_dir))
    return mixed.select("doc_id", "mix.tokens", "mix.p", "mix.rate")


def language_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table of mixing: documents with their language as domain."""
    return _table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("domain"))


@query(oracle.MERKLE_MANIFEST)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering adds 1 to n_chars where 7 divides the crc32 of the id."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    manifest = merkle_manifest(_table(spark, sf_dir, "documents"), {"n_chars": n_chars})
    return manifest.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query(oracle.IMPORTANCE_RESAMPLE)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


@query()
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))
