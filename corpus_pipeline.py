"""Document pipeline: quality rules, exact and near duplicates, personal data, packing.

Every stage takes documents with null ids, null or empty texts, ids that stand for several texts,
repeated rows and further columns of any name, and gives an empty result for an empty table. Rows
are told apart by doc_id and a hash of the text, in the exact stage by their place in the stored table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import exact_dup, near_dup, packing, pii, quality
from strata.llm._util import cut, tokenizer_path
from strata.session import scratch_path
from strata.sinks.writers import remove_folder


#: Pre-tokens that a Python worker keeps in the packing stage. The workers live on beside the memory of the
#: other stages, which have used the executor's heap by then, so a quarter of what packing alone keeps.
KEPT_PIECES = packing.PRETOKENS // 4


def _free(docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    name = "__document"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _without_rejected(docs: DataFrame, key: Column, judge: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    """``docs`` less the rows whose ``key`` is among those that ``judge`` (doc_id, kept) rejects."""
    column = _free(docs)
    keyed = docs.withColumn(column, key)
    gone = cut(judge(keyed, column).where(~F.col("kept")).select(F.col("doc_id").alias(column)).distinct(), name)
    return keyed.join(gone, column, "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def _document() -> Column:
    return F.struct("doc_id", F.xxhash64("text").alias("text_hash"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 7). Null and blank texts have too few words."""
    return _without_rejected(docs, _document(), quality.quality_rules, "quality-rejected")


def _told_apart(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with a ``column`` that differs from row to row and is the same at every reading.

    A stored Parquet table has it in file and row number; any other table is stored once with numbers.
    """
    if "_metadata" not in {c.lower() for c in docs.columns}:
        try:
            return docs.withColumn(column, F.struct(F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")))
        except AnalysisException:  # no Parquet files below
            pass
    return cut(docs.withColumn(column, F.monotonically_increasing_id()), "numbered")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts exactly one row: that of the largest id (null is the least), of rows that
    repeat the id any one, the same at every reading (operator 5). Null texts equal empty ones."""
    row = _free(docs)
    numbered = _told_apart(docs, row)
    kept = _without_rejected(numbered, F.struct("doc_id", row), exact_dup.exact_duplicates, "exact-copies")
    return kept.drop(row)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the least id (operator 1); texts without words stay."""
    return _without_rejected(docs, _document(), near_dup.near_duplicates, "near-copies")


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced, and their new length if there is a column n_chars
    (operator 3). A null text stays null."""
    redacted = pii.redact(docs)
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return redacted.select([F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences (operator 9); a null or empty text is its end id alone."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), special_tokens=True, pieces=KEPT_PIECES)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("redact_pii", redact_pii), ("pack", pack)]

#: Boosted trees and tokenization are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again; a stage's table goes when the next one stands."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
