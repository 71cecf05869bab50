"""Exact duplicates by progressive refinement (operator 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm._util import ascii_lower

PREFIX = 256           # characters under the prefix hash
FILTER_BITS = 1 << 23  # of the filter of surviving keys: 1 MB, whatever the input


def _bit_filter(keys: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap): at most bits / 32768 rows of 4 KB."""
    at = F.pmod("key", F.lit(bits))
    return (keys.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")))


def _bit_is_set(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (position % 8).cast("int")) == 1


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, and the ``carry`` columns.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Keys are
    refined step by step: byte length, then (length, prefix hash), then the full hash,
    and only groups of two or more go on. A filter of fixed size holds the surviving
    (length, prefix) keys, so the scan hashes the whole text of survivors only (and of
    the few that the filter lets pass by chance) and no text is shuffled. Of a group the
    row with the largest non-null id stays; rows that repeat id and text all have kept
    true, and a row without an id has it only if its group has no id. ``carry`` holds
    expressions over ``lowered`` (the normalised text). An empty table gives an empty result.
    """
    text = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    slim = text.select("doc_id", "text", F.octet_length("text").alias("length"))
    lengths = slim.groupBy("length").count().where("count > 1").select("length")
    prefixed = slim.select("doc_id", "text", "length",
                           F.xxhash64("length", ascii_lower(F.substring("text", 1, PREFIX))).alias("key"))
    keys = (prefixed.select("length", "key").join(lengths, "length", "left_semi")
            .groupBy("length", "key").count().where("count > 1").select("key"))
    at = F.pmod("key", F.lit(FILTER_BITS))
    tested = (prefixed.withColumn("bucket", F.bitmap_bucket_number(at))
              .join(F.broadcast(_bit_filter(keys, FILTER_BITS)), "bucket", "left")
              .withColumn("survives", F.coalesce(_bit_is_set(F.col("bitmap"), F.bitmap_bit_position(at)),
                                                 F.lit(False))))
    lowered = tested.withColumn("lowered", ascii_lower(F.col("text")))
    rows = lowered.select(
        "doc_id", "length", "key",
        F.when(F.col("survives"), F.sha2("lowered", 256)).alias("full"),
        *[value.alias(name) for name, value in (carry or {}).items()])
    groups = (rows.where("full is not null").groupBy("length", "key", "full")
              .agg(F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("size"))
              .where("size > 1"))
    return (rows.join(groups, ["length", "key", "full"], "left")
            .select("doc_id",
                    F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
                    F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), *(carry or {}))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))
