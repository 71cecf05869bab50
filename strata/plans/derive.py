"""Bank / complaint / employer frames derived from the benchmark tables.

The benchmark tables hold no NULLs, so the messy cases of the real feeds (missing tax
id, missing or foreign name, several matches per row) are produced here by fixed
expressions over the columns; the oracle SQL uses the same expressions. Everything is
lazy: the derived frames are plain projections over the parquet scans, so filters
and column pruning still reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table, resolved (listing + footer schema) once per application."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def supplier_name(key) -> F.Column:
    """``Supplier#`` + 9-digit zero-padded key (the naming rule of the supplier table)."""
    return F.concat(F.lit("Supplier#"), F.lpad(key.cast("string"), 9, "0"))


def banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bank per supplier; segment S1..S5 from the nation key."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("S"), (F.col("s_nationkey") % 5 + 1).cast("string")).alias("nom_segto_instituicao"),
        F.col("s_suppkey").alias("num_cnpj_instituicao"),
        F.col("s_name").alias("nom_instituicao"),
    )


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One complaint row per line item.

    tax id: missing on even line numbers; name: missing when the line number is a
    multiple of 3, otherwise the name of supplier ``suppkey + linenumber - 1`` (its own
    supplier on line 1, a neighbour or a non-existent supplier otherwise). So rows
    match by key only, by name only, by both (possibly two different banks) or not at all.
    """
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    return li.select(
        F.when(ln % 2 != 0, F.col("l_suppkey")).alias("num_cnpj_instituicao"),
        F.when(ln % 3 != 0, supplier_name(F.col("l_suppkey") + ln - 1)).alias("nom_instituicao"),
        F.col("l_orderkey").alias("qtd_totl_clie_css_scr"),
        F.col("l_quantity").cast("bigint").alias("qtd_totl_recl"),
        F.col("l_discount").alias("vlr_ind_recl"),
        F.year("l_shipdate").alias("ano"),
        F.quarter("l_shipdate").alias("num_trimestre"),
    )


def complaints_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`complaints`, but every third order (``l_orderkey % 3 = 0``) is filed
    against supplier 0 by key and name: one bank holds a third of all rows."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    hot = F.col("l_orderkey") % 3 == 0
    return li.select(
        F.when(hot, F.lit(0).cast("bigint")).when(ln % 2 != 0, F.col("l_suppkey"))
         .alias("num_cnpj_instituicao"),
        F.when(hot, supplier_name(F.lit(0)))
         .when(ln % 3 != 0, supplier_name(F.col("l_suppkey") + ln - 1)).alias("nom_instituicao"),
        F.col("l_orderkey").alias("qtd_totl_clie_css_scr"),
        F.col("l_quantity").cast("bigint").alias("qtd_totl_recl"),
        F.col("l_discount").alias("vlr_ind_recl"),
        F.year("l_shipdate").alias("ano"),
        F.quarter("l_shipdate").alias("num_trimestre"),
    )


def employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employer ratings keyed by institution name."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_name").alias("nom_instituicao"),
        (F.col("s_acctbal") / 2000).alias("vlr_ind_satis_geral"),
        (F.col("s_nationkey").cast("double") / 5).alias("vlr_ind_remu_bene"),
    )


# Same derivations for the DuckDB oracle (tables are pre-registered views there).
SQL_BANKS = """SELECT 'S' || CAST(s_nationkey % 5 + 1 AS VARCHAR) AS nom_segto_instituicao,
       s_suppkey AS num_cnpj_instituicao, s_name AS nom_instituicao
FROM supplier"""

SQL_COMPLAINTS = """SELECT CASE WHEN l_linenumber % 2 <> 0 THEN l_suppkey END AS num_cnpj_instituicao,
       CASE WHEN l_linenumber % 3 <> 0
            THEN 'Supplier#' || lpad(CAST(l_suppkey + l_linenumber - 1 AS VARCHAR), 9, '0') END
         AS nom_instituicao,
       l_orderkey AS qtd_totl_clie_css_scr, CAST(l_quantity AS BIGINT) AS qtd_totl_recl,
       l_discount AS vlr_ind_recl, CAST(year(l_shipdate) AS INTEGER) AS ano,
       CAST(quarter(l_shipdate) AS INTEGER) AS num_trimestre
FROM lineitem"""

SQL_COMPLAINTS_HOT = """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0
            WHEN l_linenumber % 2 <> 0 THEN l_suppkey END AS num_cnpj_instituicao,
       CASE WHEN l_orderkey % 3 = 0 THEN 'Supplier#000000000'
            WHEN l_linenumber % 3 <> 0
            THEN 'Supplier#' || lpad(CAST(l_suppkey + l_linenumber - 1 AS VARCHAR), 9, '0') END
         AS nom_instituicao,
       l_orderkey AS qtd_totl_clie_css_scr, CAST(l_quantity AS BIGINT) AS qtd_totl_recl,
       l_discount AS vlr_ind_recl, CAST(year(l_shipdate) AS INTEGER) AS ano,
       CAST(quarter(l_shipdate) AS INTEGER) AS num_trimestre
FROM lineitem"""

SQL_EMPLOYERS = """SELECT s_name AS nom_instituicao, s_acctbal / 2000 AS vlr_ind_satis_geral,
       CAST(s_nationkey AS DOUBLE) / 5 AS vlr_ind_remu_bene
FROM supplier"""

SQL_SOURCES = f"""banks AS ({SQL_BANKS}),
complaints AS ({SQL_COMPLAINTS}),
employers AS ({SQL_EMPLOYERS})"""
