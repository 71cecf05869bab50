"""Scalar cleaning functions and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import projection as P
from strata.plans import derive
from strata.plans.catalog._base import register


@register("regex_replace", """SELECT c_custkey,
  regexp_replace(c_name, 'Customer#', '', 'g') AS name_digits,
  regexp_replace(c_name || ' - PRUDENCIAL', ' - PRUDENCIAL', '', 'g') AS name_no_prudential,
  regexp_replace(c_name || ' (conglomerado)', ' \\(conglomerado\\)', '', 'g') AS name_no_group,
  translate('Ô' || c_mktsegment, 'Ô', 'O') AS segment_folded,
  regexp_replace(CAST(c_nationkey % 4 + 1 AS VARCHAR) || 'º', 'º', '', 'g') AS quarter_digit
FROM customer""")
def regex_replace(spark, sf_dir):
    c = derive.table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        C.strip_pattern("c_name", "Customer#").alias("name_digits"),
        C.strip_pattern(F.concat("c_name", F.lit(" - PRUDENCIAL")), " - PRUDENCIAL")
         .alias("name_no_prudential"),
        C.strip_pattern(F.concat("c_name", F.lit(" (conglomerado)")), r" \(conglomerado\)")
         .alias("name_no_group"),
        C.fold_accents(F.concat(F.lit("Ô"), "c_mktsegment")).alias("segment_folded"),
        C.strip_pattern(F.concat((F.col("c_nationkey") % 4 + 1).cast("string"), F.lit("º")), "º")
         .alias("quarter_digit"),
    )


_INDUSTRY_SQL = """CASE WHEN p_size % 2 = 0 THEN p_name
     ELSE '/Explore/' || lower(p_type) || '/' || replace(p_name, ' ', '-') || '.9,40_IP'
          || CAST(p_partkey AS VARCHAR) || '.htm' END"""


@register("regex_extract", f"""WITH src AS (SELECT p_partkey, {_INDUSTRY_SQL} AS industry FROM part)
SELECT p_partkey,
  regexp_extract(industry, '\\/.+\\/(.+)\\..,', 1) AS slug_empty,
  CASE WHEN regexp_matches(industry, '\\/.+\\/(.+)\\..,')
       THEN regexp_extract(industry, '\\/.+\\/(.+)\\..,', 1) ELSE industry END AS slug_keep,
  CASE WHEN regexp_matches(industry, '\\/.+\\/(.+)\\..,')
       THEN regexp_extract(industry, '\\/.+\\/(.+)\\..,', 1) END AS slug_null
FROM src""")
def regex_extract(spark, sf_dir):
    from strata.schemas import INDUSTRY_PATTERN
    p = derive.table(spark, sf_dir, "part")
    industry = F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.concat(
        F.lit("/Explore/"), F.lower("p_type"), F.lit("/"), F.regexp_replace("p_name", " ", "-"),
        F.lit(".9,40_IP"), F.col("p_partkey").cast("string"), F.lit(".htm")))
    return p.select("p_partkey", industry.alias("industry")).select(
        "p_partkey",
        C.regex_extract("industry", INDUSTRY_PATTERN, 1, "empty").alias("slug_empty"),
        C.regex_extract("industry", INDUSTRY_PATTERN, 1, "keep").alias("slug_keep"),
        C.regex_extract("industry", INDUSTRY_PATTERN, 1, "null").alias("slug_null"))


@register("regex_extract_host", """SELECT page_id,
  CASE WHEN regexp_matches(url, '://([^/:?#]+)') THEN regexp_extract(url, '://([^/:?#]+)', 1)
  END AS host
FROM pages""")
def regex_extract_host(spark, sf_dir):
    pages = derive.table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", C.regex_extract("url", "://([^/:?#]+)", 1, "null").alias("host"))


@register("split_part", """SELECT p_partkey,
  string_split(p_name, ' ')[1] AS word1, string_split(p_name, ' ')[2] AS word2,
  string_split(p_name, ' ')[3] AS word3,
  string_split(p_type || ', ' || p_brand, ', ')[1] AS hq_city,
  string_split(p_type || ', ' || p_brand, ', ')[2] AS hq_country
FROM part""")
def split_part(spark, sf_dir):
    p = derive.table(spark, sf_dir, "part")
    hq = F.concat("p_type", F.lit(", "), "p_brand")
    return p.select(
        "p_partkey",
        C.split_part_at("p_name", " ", 1).alias("word1"),
        C.split_part_at("p_name", " ", 2).alias("word2"),
        C.split_part_at("p_name", " ", 3).alias("word3"),
        C.split_part_at(hq, ", ", 1).alias("hq_city"),
        C.split_part_at(hq, ", ", 2).alias("hq_country"))


@register("decimal_br", """WITH src AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN ' '
              ELSE translate(format('{:,.2f}', o_totalprice), ',.', '.,') END AS price_text
  FROM orders)
SELECT o_orderkey, price_text,
       TRY_CAST(translate(trim(price_text), ',.', '.') AS DOUBLE) AS price_value
FROM src""")
def decimal_br(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit(" ")).otherwise(
        C.format_decimal_br("o_totalprice", 2))
    return o.select("o_orderkey", text.alias("price_text")).select(
        "o_orderkey", "price_text", C.parse_decimal_br("price_text").alias("price_value"))


@register("safe_cast", """WITH src AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_linenumber % 3 WHEN 0 THEN ' '
              WHEN 1 THEN CAST(l_quantity AS VARCHAR)
              ELSE ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS raw_qty,
         CASE WHEN l_linenumber % 2 = 0 THEN 'n/a' ELSE CAST(l_tax AS VARCHAR) END AS raw_tax
  FROM lineitem)
SELECT l_orderkey, l_linenumber, raw_qty,
       TRY_CAST(TRY_CAST(trim(raw_qty) AS DECIMAL(38,10)) AS INTEGER) AS qty,
       TRY_CAST(TRY_CAST(trim(raw_qty) AS DECIMAL(38,10)) AS BIGINT) AS qty_big,
       TRY_CAST(trim(raw_tax) AS DOUBLE) AS tax
FROM src""")
def safe_cast(spark, sf_dir):
    li = derive.table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    raw_qty = (F.when(ln % 3 == 0, F.lit(" "))
               .when(ln % 3 == 1, F.col("l_quantity").cast("string"))
               .otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("bigint").cast("string"))))
    raw_tax = F.when(ln % 2 == 0, F.lit("n/a")).otherwise(F.col("l_tax").cast("string"))
    src = li.select("l_orderkey", "l_linenumber", raw_qty.alias("raw_qty"), raw_tax.alias("raw_tax"))
    return src.select("l_orderkey", "l_linenumber", "raw_qty",
                      C.safe_cast("raw_qty", "int").alias("qty"),
                      C.safe_cast("raw_qty", "bigint").alias("qty_big"),
                      C.safe_cast("raw_tax", "double").alias("tax"))


@register("quarter_partition", """WITH src AS (
  SELECT o_orderkey, o_orderdate,
         CASE WHEN o_orderkey % 11 = 0 THEN 'X'
              ELSE CAST(quarter(o_orderdate) AS VARCHAR) || 'º' END AS quarter_text
  FROM orders)
SELECT o_orderkey, quarter_text,
       CASE replace(quarter_text, 'º', '') WHEN '1' THEN '03' WHEN '2' THEN '06'
            WHEN '3' THEN '09' WHEN '4' THEN '12' ELSE '00' END AS month_text,
       CAST(year(o_orderdate) AS VARCHAR) ||
       CASE replace(quarter_text, 'º', '') WHEN '1' THEN '03' WHEN '2' THEN '06'
            WHEN '3' THEN '09' WHEN '4' THEN '12' ELSE '00' END || '01' AS anomesdia,
       strftime(o_orderdate, '%Y%m%d') AS order_day
FROM src""")
def quarter_partition(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders")
    qtext = F.when(F.col("o_orderkey") % 11 == 0, F.lit("X")).otherwise(
        F.concat(F.quarter("o_orderdate").cast("string"), F.lit("º")))
    src = o.select("o_orderkey", "o_orderdate", qtext.alias("quarter_text"))
    return src.select("o_orderkey", "quarter_text",
                      C.quarter_to_month("quarter_text").alias("month_text"),
                      C.quarter_partition(F.year("o_orderdate"), "quarter_text").alias("anomesdia"),
                      C.date_key("o_orderdate").alias("order_day"))


_RAW_COMPLAINT_SQL = """SELECT CAST(year(l_shipdate) AS VARCHAR) AS "Ano",
       CAST(quarter(l_shipdate) AS VARCHAR) || 'º' AS "Trimestre",
       CASE WHEN l_linenumber % 2 = 0 THEN ' ' ELSE CAST(l_suppkey AS VARCHAR) END AS "CNPJ IF",
       'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS "Instituição financeira",
       CAST(l_quantity AS VARCHAR) AS "Quantidade total de reclamações",
       CAST(l_orderkey AS VARCHAR) AS "Quantidade total de clientes  CCS e SCR"
FROM lineitem"""


def _raw_complaints(spark, sf_dir):
    li = derive.table(spark, sf_dir, "lineitem")
    return li.select(
        F.year("l_shipdate").cast("string").alias("Ano"),
        F.concat(F.quarter("l_shipdate").cast("string"), F.lit("º")).alias("Trimestre"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit(" "))
         .otherwise(F.col("l_suppkey").cast("string")).alias("CNPJ IF"),
        derive.supplier_name(F.col("l_suppkey")).alias("Instituição financeira"),
        F.col("l_quantity").cast("string").alias("Quantidade total de reclamações"),
        F.col("l_orderkey").cast("string").alias("Quantidade total de clientes  CCS e SCR"))


@register("spec_projection", f"""WITH raw AS ({_RAW_COMPLAINT_SQL})
SELECT TRY_CAST(TRY_CAST(trim("Ano") AS DECIMAL(38,10)) AS INTEGER) AS ano,
       TRY_CAST(TRY_CAST(trim(replace("Trimestre", 'º', '')) AS DECIMAL(38,10)) AS INTEGER)
         AS num_trimestre,
       TRY_CAST(TRY_CAST(trim("CNPJ IF") AS DECIMAL(38,10)) AS BIGINT) AS num_cnpj_instituicao,
       "Instituição financeira" AS nom_instituicao,
       TRY_CAST(TRY_CAST(trim("Quantidade total de reclamações") AS DECIMAL(38,10)) AS BIGINT)
         AS qtd_totl_recl,
       TRY_CAST(TRY_CAST(trim("Quantidade total de clientes  CCS e SCR") AS DECIMAL(38,10))
         AS BIGINT) AS qtd_totl_clie_css_scr
FROM raw""")
def spec_projection(spark, sf_dir):
    from strata.schemas import COMPLAINT_SPEC
    raw = _raw_complaints(spark, sf_dir)
    raw = raw.withColumn("Trimestre", C.strip_pattern("Trimestre", "º"))
    wanted = {"Ano", "Trimestre", "CNPJ IF", "Instituição financeira",
              "Quantidade total de reclamações", "Quantidade total de clientes  CCS e SCR"}
    return P.apply_spec(raw, [s for s in COMPLAINT_SPEC if s[0] in wanted])


@register("project", "SELECT p_name, p_partkey, p_retailprice FROM part")
def project(spark, sf_dir):
    return P.project(derive.table(spark, sf_dir, "part"), ["p_name", "p_partkey", "p_retailprice"])


@register("drop_cols", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_cols(spark, sf_dir):
    return P.drop_cols(derive.table(spark, sf_dir, "customer"), ["c_acctbal", "c_mktsegment"])


@register("prefix_filter", "SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'S%'")
def prefix_filter(spark, sf_dir):
    p = derive.table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return P.filter_prefix(p, "p_type", "S")


@register("substring_filter", "SELECT p_partkey, p_type FROM part WHERE substring(p_type, 1, 1) = 'S'")
def substring_filter(spark, sf_dir):
    p = derive.table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return P.filter_first_chars(p, "p_type", "S")


@register("ref_date", "SELECT n_nationkey, n_name, '20230814' AS anomesdia FROM nation")
def ref_date(spark, sf_dir):
    n = derive.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return C.with_ref_date(n, "2023-08-14")


@register("load_ts", "SELECT o_orderkey, true AS has_load_ts FROM orders")
def load_ts(spark, sf_dir):
    o = C.with_load_ts(derive.table(spark, sf_dir, "orders").select("o_orderkey"))
    return o.select("o_orderkey", F.col("dat_hor_psst").isNotNull().alias("has_load_ts"))


@register("clean_header", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def clean_header(spark, sf_dir):
    n = derive.table(spark, sf_dir, "nation")
    messy = n.select(F.col("n_nationkey").alias('"id"'), F.col("n_name").alias(" name"),
                     F.col("n_regionkey").alias("'name'"))
    return P.clean_header(messy)
