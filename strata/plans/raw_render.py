"""Raw landing files rendered from the benchmark tables (text in the feeds' layouts).

Banks from ``supplier`` (tab-separated), complaints from ``lineitem`` (semicolon, one
trailing empty field, locale decimals, blank numbers), employers from ``supplier``
(pipe-separated) plus a second employer file from ``nation`` whose segment position
holds a number (those rows are removed by the segment filter). The ``SQL_SOT_*``
strings state, for the oracle, what the trusted layer must contain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas as SC
from strata.functions.columns import format_decimal_br
from strata.plans.derive import supplier_name, table
from strata.sinks.writers import write_partitioned


def _s(c) -> F.Column:
    return c.cast("string")


def raw_bancos(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("S"), _s(F.col("s_nationkey") % 5 + 1)).alias("Segmento"),
        _s(F.col("s_suppkey")).alias("CNPJ"),
        F.concat("s_name", F.when(F.col("s_suppkey") % 4 == 0, F.lit(" - PRUDENCIAL"))
                 .otherwise(F.lit(""))).alias("Nome"))


def raw_reclamacoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    qty = F.col("l_quantity").cast("bigint")
    cols = [
        _s(F.year("l_shipdate")),
        F.concat(_s(F.quarter("l_shipdate")), F.lit("º")),
        F.when(F.col("l_returnflag") == "A", F.lit("Top 10"))
         .when(F.col("l_returnflag") == "N", F.lit("Grupo Secundário")).otherwise(F.lit("Demais")),
        F.when(F.col("l_linestatus") == "O", F.lit("Conglomerado"))
         .otherwise(F.lit("Banco/financeira")),
        F.when((ln == 7) & (F.col("l_orderkey") % 2 == 0), F.lit(" "))
         .otherwise(_s(F.col("l_suppkey"))),
        F.concat(supplier_name(F.col("l_suppkey")),
                 F.when(ln % 2 == 0, F.lit(" (conglomerado)")).otherwise(F.lit(""))),
        F.when(ln == 5, F.lit(" ")).otherwise(format_decimal_br("l_extendedprice", 2)),
        _s(qty),
        _s(ln),
        _s(F.col("l_partkey") % 50),
        _s(qty + ln),
        F.when(ln == 6, F.lit("")).otherwise(_s(F.col("l_orderkey"))),
        _s(F.col("l_partkey")),
        _s(F.col("l_suppkey")),
    ]
    named = [c.alias(n) for c, n in zip(cols, SC.COMPLAINT_FIELDS)]
    return li.select(*named, F.lit("").alias("_trailing"))


def _employer_cols(name, nation, key) -> list[F.Column]:
    return [
        name,
        F.concat(_s(nation * 10), F.lit(".0")),
        _s(nation),
        _s(key % 7),
        F.when(key % 2 == 0, F.lit("")).otherwise(F.lit("3")),
        F.concat(F.lit("www."), F.lower(F.regexp_replace(name, "#", "")), F.lit(".com.br")),
        F.when(key % 5 == 0, F.concat(F.lit("City"), _s(nation)))
         .otherwise(F.concat(F.lit("City"), _s(nation), F.lit(", Brasil"))),
        F.when(key % 3 == 0, F.lit("")).otherwise(F.concat(_s(nation + 1900), F.lit(".0"))),
        F.when(key % 6 == 0, F.lit("sem-setor")).otherwise(F.concat(
            F.lit("/Avaliacoes/bancos-"), _s(nation), F.lit("/setor-"), _s(nation),
            F.lit(".9,40_IP"), _s(key), F.lit(".htm"))),
        F.when(nation % 3 == 0, F.lit("Mais de US$ 10 bi (BRL)")).otherwise(F.lit("Desconhecida")),
        F.concat(F.lit("https://example.org/"), _s(key)),
        F.concat(_s(nation % 5 + 1), F.lit("."), _s(key % 10)),
        F.concat(_s(key % 5), F.lit("."), _s(nation % 10)),
        F.concat(_s(nation % 4 + 1), F.lit(".5")),
        F.concat(_s(key % 4 + 1), F.lit(".0")),
        F.lit("3.9"),
        F.concat(_s(key % 5), F.lit("."), _s(nation % 10)),
        F.lit("4.1"),
        _s(key % 100),
        F.lit(""),
    ]


def raw_empregados(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    seg = F.concat(F.lit("S"), _s(F.col("s_nationkey") % 5 + 1))
    cols = _employer_cols(F.col("s_name"), F.col("s_nationkey"), F.col("s_suppkey"))
    cols += [seg, F.col("s_name"), F.lit("100")]
    return s.select(*[c.alias(n) for c, n in zip(cols, SC.EMPLOYER_FIELDS)])


def raw_empregados_tax_id_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second employer file: a tax id where the segment belongs (rows never survive)."""
    n = table(spark, sf_dir, "nation")
    cols = _employer_cols(F.col("n_name"), F.col("n_regionkey"), F.col("n_nationkey"))
    cols += [_s(F.col("n_nationkey") + 1000), F.col("n_name"), F.lit("90")]
    return n.select(*[c.alias(n_) for c, n_ in zip(cols, SC.EMPLOYER_FIELDS)])


LAND_ROWS = 250_000  # lines of a landed file: gzip files are read whole, by one task each


def land(raw: DataFrame, folder: str, sep: str, empty_value: str | None = "", mode: str = "overwrite") -> str:
    """Write a feed as gzip CSV files of bounded size."""
    return write_partitioned(raw, folder, fmt="csv", sep=sep, empty_value=empty_value, mode=mode,
                             compression="gzip", max_records_per_file=LAND_ROWS)


def land_raw_files(spark: SparkSession, sf_dir: str, landing: str,
                   datasets: tuple[str, ...] = ("bancos", "reclamacoes", "empregados")) -> dict[str, str]:
    """Write the feeds of ``datasets`` below ``landing/<Dataset>/``; returns dataset -> folder."""
    out = {d: f"{landing}/{d.capitalize()}" for d in datasets}
    if "bancos" in out:
        land(raw_bancos(spark, sf_dir), out["bancos"], sep="\t", empty_value=None)
    if "reclamacoes" in out:
        land(raw_reclamacoes(spark, sf_dir), out["reclamacoes"], sep=";")
    if "empregados" in out:
        land(raw_empregados(spark, sf_dir), out["empregados"], sep="|")
        land(raw_empregados_tax_id_variant(spark, sf_dir), out["empregados"], sep="|", mode="append")
    return out


# What the raw layer must contain: every field as text, blank fields as they were read.
SQL_SOR_COMPLAINTS = """SELECT CAST(year(l_shipdate) AS VARCHAR) AS "Ano",
       CAST(quarter(l_shipdate) AS VARCHAR) || 'º' AS "Trimestre",
       CASE l_returnflag WHEN 'A' THEN 'Top 10' WHEN 'N' THEN 'Grupo Secundário' ELSE 'Demais' END AS "Categoria",
       CASE WHEN l_linestatus = 'O' THEN 'Conglomerado' ELSE 'Banco/financeira' END AS "Tipo",
       CASE WHEN l_linenumber = 7 AND l_orderkey % 2 = 0 THEN ' ' ELSE CAST(l_suppkey AS VARCHAR) END
         AS "CNPJ IF",
       'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') ||
         CASE WHEN l_linenumber % 2 = 0 THEN ' (conglomerado)' ELSE '' END AS "Instituição financeira",
       CASE WHEN l_linenumber = 5 THEN ' '
            ELSE translate(format('{:,.2f}', CAST(l_extendedprice AS DOUBLE)), ',.', '.,') END AS "Índice",
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS "Quantidade de reclamações reguladas procedentes",
       CAST(l_linenumber AS VARCHAR) AS "Quantidade de reclamações reguladas - outras",
       CAST(l_partkey % 50 AS VARCHAR) AS "Quantidade de reclamações não reguladas",
       CAST(CAST(l_quantity AS BIGINT) + l_linenumber AS VARCHAR) AS "Quantidade total de reclamações",
       CASE WHEN l_linenumber = 6 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END
         AS "Quantidade total de clientes  CCS e SCR",
       CAST(l_partkey AS VARCHAR) AS "Quantidade de clientes  CCS",
       CAST(l_suppkey AS VARCHAR) AS "Quantidade de clientes  SCR",
       CAST(year(l_shipdate) AS VARCHAR) ||
       CASE quarter(l_shipdate) WHEN 1 THEN '03' WHEN 2 THEN '06' WHEN 3 THEN '09' ELSE '12' END
       || '01' AS anomesdia
FROM lineitem"""


def _sor_employers_sql(source: str, name: str, nation: str, key: str, segment: str, match: str) -> str:
    def text(value):
        return f"CAST({value} AS VARCHAR)"
    values = [
        name, f"{text(f'{nation} * 10')} || '.0'", text(nation), text(f"{key} % 7"),
        f"CASE WHEN {key} % 2 = 0 THEN NULL ELSE '3' END",
        f"'www.' || lower(replace({name}, '#', '')) || '.com.br'",
        f"'City' || {text(nation)} || CASE WHEN {key} % 5 = 0 THEN '' ELSE ', Brasil' END",
        f"CASE WHEN {key} % 3 = 0 THEN NULL ELSE {text(f'{nation} + 1900')} || '.0' END",
        f"CASE WHEN {key} % 6 = 0 THEN 'sem-setor' ELSE '/Avaliacoes/bancos-' || {text(nation)} || '/setor-' "
        f"|| {text(nation)} || '.9,40_IP' || {text(key)} || '.htm' END",
        f"CASE WHEN {nation} % 3 = 0 THEN 'Mais de US$ 10 bi (BRL)' ELSE 'Desconhecida' END",
        f"'https://example.org/' || {text(key)}",
        f"{text(f'{nation} % 5 + 1')} || '.' || {text(f'{key} % 10')}",
        f"{text(f'{key} % 5')} || '.' || {text(f'{nation} % 10')}", f"{text(f'{nation} % 4 + 1')} || '.5'",
        f"{text(f'{key} % 4 + 1')} || '.0'", "'3.9'", f"{text(f'{key} % 5')} || '.' || {text(f'{nation} % 10')}",
        "'4.1'", text(f"{key} % 100"), "NULL", segment, name, f"'{match}'"]
    named = ", ".join(f'{v} AS "{c}"' for v, c in zip(values, SC.EMPLOYER_FIELDS))
    return f"SELECT {named}, '20230814' AS anomesdia FROM {source}"


SQL_SOR_EMPLOYERS = "\nUNION ALL\n".join([
    _sor_employers_sql("supplier", "s_name", "s_nationkey", "s_suppkey",
                       "'S' || CAST(s_nationkey % 5 + 1 AS VARCHAR)", "100"),
    _sor_employers_sql("nation", "n_name", "n_regionkey", "n_nationkey",
                       "CAST(n_nationkey + 1000 AS VARCHAR)", "90")])

# What the trusted layer must contain (DuckDB oracle; base tables are views there).
SQL_SOT_BANKS = """SELECT 'S' || CAST(s_nationkey % 5 + 1 AS VARCHAR) AS nom_segto_instituicao,
       s_suppkey AS num_cnpj_instituicao, s_name AS nom_instituicao
FROM supplier"""

SQL_SOT_COMPLAINTS = """SELECT CAST(year(l_shipdate) AS INTEGER) AS ano,
       CAST(quarter(l_shipdate) AS INTEGER) AS num_trimestre,
       CASE l_returnflag WHEN 'A' THEN 'Top 10' WHEN 'N' THEN 'Grupo Secundário'
            ELSE 'Demais' END AS nom_categoria,
       CASE WHEN l_linestatus = 'O' THEN 'Conglomerado' ELSE 'Banco/financeira' END
         AS nom_tipo_instituicao,
       CASE WHEN l_linenumber = 7 AND l_orderkey % 2 = 0 THEN NULL ELSE l_suppkey END
         AS num_cnpj_instituicao,
       'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS nom_instituicao,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_extendedprice AS FLOAT) END
         AS vlr_ind_recl,
       CAST(l_quantity AS BIGINT) AS qtd_recl_reg_prec,
       CAST(l_linenumber AS BIGINT) AS qtd_recl_reg_outr,
       CAST(l_partkey % 50 AS BIGINT) AS qtd_recl_nao_reg,
       CAST(l_quantity AS BIGINT) + l_linenumber AS qtd_totl_recl,
       CASE WHEN l_linenumber = 6 THEN NULL ELSE l_orderkey END AS qtd_totl_clie_css_scr,
       l_partkey AS qtd_clie_ccs, l_suppkey AS qtd_clie_scr,
       CAST(year(l_shipdate) AS VARCHAR) ||
       CASE quarter(l_shipdate) WHEN 1 THEN '03' WHEN 2 THEN '06' WHEN 3 THEN '09' ELSE '12' END
       || '01' AS anomesdia
FROM lineitem"""

SQL_SOT_EMPLOYERS = """SELECT CAST(s_nationkey * 10 AS INTEGER) AS qtd_aval,
       CAST(s_nationkey AS INTEGER) AS qtd_aval_cult,
       CAST(s_suppkey % 7 AS INTEGER) AS qtd_aval_salr,
       CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 3 END AS qtd_aval_benef,
       'www.' || lower(replace(s_name, '#', '')) || '.com.br' AS txt_url_instituicao,
       'City' || CAST(s_nationkey AS VARCHAR) AS nom_mun_sede_instituicao,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'Brasil' END AS nom_pais_sede_instituicao,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_nationkey + 1900 AS INTEGER) END
         AS ano_fund_instituicao,
       CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE 'setor-' || CAST(s_nationkey AS VARCHAR) END
         AS nom_segto_atua_instituicao,
       CASE WHEN s_nationkey % 3 = 0 THEN 'Mais de US$ 10 bi (BRL)' ELSE 'Desconhecida' END
         AS txt_faixa_rend_instituicao,
       'https://example.org/' || CAST(s_suppkey AS VARCHAR) AS txt_url_orig_data,
       CAST(CAST(s_nationkey % 5 + 1 AS VARCHAR) || '.' || CAST(s_suppkey % 10 AS VARCHAR) AS FLOAT)
         AS vlr_ind_satis_geral,
       CAST(CAST(s_suppkey % 5 AS VARCHAR) || '.' || CAST(s_nationkey % 10 AS VARCHAR) AS FLOAT)
         AS vlr_ind_cult_valrs,
       CAST(CAST(s_nationkey % 4 + 1 AS VARCHAR) || '.5' AS FLOAT) AS vlr_ind_divr_incl,
       CAST(CAST(s_suppkey % 4 + 1 AS VARCHAR) || '.0' AS FLOAT) AS vlr_ind_qual_vida,
       CAST('3.9' AS FLOAT) AS vlr_ind_alt_lider,
       CAST(CAST(s_suppkey % 5 AS VARCHAR) || '.' || CAST(s_nationkey % 10 AS VARCHAR) AS FLOAT)
         AS vlr_ind_remu_bene,
       CAST('4.1' AS FLOAT) AS vlr_ind_oprt_carr,
       CAST(s_suppkey % 100 AS FLOAT) AS vlr_pct_recom_outr_pess,
       CAST(NULL AS FLOAT) AS vlr_pct_perspec_pos_instituicao,
       s_name AS nom_instituicao
FROM supplier"""
