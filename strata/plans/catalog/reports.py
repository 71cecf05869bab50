"""Bank report, key-or-name joins, plain joins and set operations, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import sinks
from strata.operators import joins, report
from strata.plans import derive, jobs
from strata.session import scratch_path
from strata.plans.derive import SQL_SOURCES
from strata.plans.catalog._base import register, sources


# The report from its definition: per tax id the maxima over the complaints that share its
# id and over those that share a bank's name, and over the employers of that name. The
# second level groups single rows, so its means and sums are the values themselves.
SQL_PER_BANK = """by_id AS (
  SELECT num_cnpj_instituicao AS id, max(qtd_totl_clie_css_scr) AS clients,
         max(qtd_totl_recl) AS complaints, max(vlr_ind_recl) AS rate
  FROM complaints GROUP BY id),
by_name AS (
  SELECT nom_instituicao AS name, max(qtd_totl_clie_css_scr) AS clients,
         max(qtd_totl_recl) AS complaints, max(vlr_ind_recl) AS rate
  FROM complaints GROUP BY name),
staff AS (
  SELECT nom_instituicao AS name, max(vlr_ind_satis_geral) AS mood, max(vlr_ind_remu_bene) AS pay
  FROM employers GROUP BY name),
per_bank AS (
  SELECT b.num_cnpj_instituicao, max(b.nom_instituicao) AS nom_instituicao,
         max(b.nom_segto_instituicao) AS nom_segto_instituicao,
         max(greatest(i.clients, n.clients)) AS max_qtd_totl_clie_ccs_scr,
         max(greatest(i.rate, n.rate)) AS avg_ind_recl,
         max(greatest(i.complaints, n.complaints)) AS sum_qtd_totl_recl,
         max(s.mood) AS avg_ind_geral_instituicao, max(s.pay) AS avg_ind_remu_bene_instituicao
  FROM banks b JOIN staff s ON s.name = b.nom_instituicao
  LEFT JOIN by_id i ON i.id = b.num_cnpj_instituicao
  LEFT JOIN by_name n ON n.name = b.nom_instituicao
  WHERE i.id IS NOT NULL OR n.name IS NOT NULL
  GROUP BY b.num_cnpj_instituicao)"""

# The same per quarter: both ways of matching give (bank, quarter, maxima) rows.
SQL_PER_BANK_QUARTER = """staff AS (
  SELECT nom_instituicao AS name, max(vlr_ind_satis_geral) AS mood, max(vlr_ind_remu_bene) AS pay
  FROM employers GROUP BY name),
ways AS (
  SELECT 'id' AS way, CAST(num_cnpj_instituicao AS VARCHAR) AS term, ano, num_trimestre,
         max(qtd_totl_clie_css_scr) AS clients, max(qtd_totl_recl) AS complaints, max(vlr_ind_recl) AS rate
  FROM complaints GROUP BY ALL
  UNION ALL
  SELECT 'name', nom_instituicao, ano, num_trimestre, max(qtd_totl_clie_css_scr), max(qtd_totl_recl),
         max(vlr_ind_recl)
  FROM complaints GROUP BY ALL),
per_bank_quarter AS (
  SELECT b.num_cnpj_instituicao, w.ano, w.num_trimestre, max(b.nom_instituicao) AS nom_instituicao,
         max(b.nom_segto_instituicao) AS nom_segto_instituicao, max(w.clients) AS clients,
         max(w.complaints) AS complaints, max(w.rate) AS rate, max(s.mood) AS mood, max(s.pay) AS pay
  FROM banks b JOIN staff s ON s.name = b.nom_instituicao
  JOIN ways w ON w.term = CASE w.way WHEN 'id' THEN CAST(b.num_cnpj_instituicao AS VARCHAR)
                                     ELSE b.nom_instituicao END
  GROUP BY b.num_cnpj_instituicao, w.ano, w.num_trimestre)"""

SQL_FINAL_SNAPSHOT = """SELECT nom_instituicao AS nome_banco,
       CAST(num_cnpj_instituicao AS BIGINT) AS cnpj,
       nom_segto_instituicao AS classificacao_banco,
       TRY_CAST(max_qtd_totl_clie_ccs_scr AS INTEGER) AS quantidade_clientes_banco,
       CAST(avg_ind_recl AS FLOAT) AS indice_reclamacoes,
       TRY_CAST(sum_qtd_totl_recl AS INTEGER) AS quantidade_reclamacoes,
       CAST(avg_ind_geral_instituicao AS FLOAT) AS indice_satisfacao_funcionarios_bancos,
       CAST(avg_ind_remu_bene_instituicao AS FLOAT)
         AS "indice_satisfação_salarios_funcionarios_bancos"
FROM per_bank"""

SQL_REPORT_CTES = f"WITH {SQL_SOURCES},\n{SQL_PER_BANK}"
SQL_FLAGSHIP = f"{SQL_REPORT_CTES}\n{SQL_FINAL_SNAPSHOT}"


def flagship_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    banks, complaints, employers = sources(spark, sf_dir)
    return report.finalize_report(report.snapshot_report(banks, complaints, employers))


register("flagship_report", SQL_FLAGSHIP)(flagship_report)


@register("flagship_report_unaggregated", SQL_FLAGSHIP)
def flagship_report_unaggregated(spark, sf_dir):
    """Same report without the collapse-before-join rewrite (equivalence witness)."""
    banks, complaints, employers = sources(spark, sf_dir)
    return report.finalize_report(
        report.snapshot_report(banks, complaints, employers, pre_aggregate=False))


SQL_FLAGSHIP_HOT = (f"WITH banks AS ({derive.SQL_BANKS}),\n"
                    f"complaints AS ({derive.SQL_COMPLAINTS_HOT}),\n"
                    f"employers AS ({derive.SQL_EMPLOYERS}),\n{SQL_PER_BANK}\n"
                    f"{SQL_FINAL_SNAPSHOT}")


@register("flagship_report_hot_key", SQL_FLAGSHIP_HOT)
def flagship_report_hot_key(spark, sf_dir):
    """The flagship with one bank holding a third of all complaint rows."""
    banks, _, employers = sources(spark, sf_dir)
    complaints = derive.complaints_hot_key(spark, sf_dir)
    return report.finalize_report(report.snapshot_report(banks, complaints, employers))


@register("or_join_bag_hot_key", f"""WITH banks AS ({derive.SQL_BANKS}),
complaints AS ({derive.SQL_COMPLAINTS_HOT})
SELECT b.num_cnpj_instituicao, count(*) AS n_matches,
       CAST(sum(c.qtd_totl_recl) AS BIGINT) AS sum_qtd_totl_recl
FROM banks b JOIN complaints c
  ON b.num_cnpj_instituicao = c.num_cnpj_instituicao OR b.nom_instituicao = c.nom_instituicao
GROUP BY b.num_cnpj_instituicao""")
def or_join_bag_hot_key(spark, sf_dir):
    """Bag key-or-name join on raw fact rows with a hot key (a third of all rows)."""
    banks = derive.banks(spark, sf_dir)
    comp = derive.complaints_hot_key(spark, sf_dir).select(
        "num_cnpj_instituicao", "nom_instituicao", "qtd_totl_recl")
    m = joins.or_equi_join(banks, comp, [("num_cnpj_instituicao", "num_cnpj_instituicao"),
                                         ("nom_instituicao", "nom_instituicao")])
    return m.groupBy("num_cnpj_instituicao").agg(
        F.count(F.lit(1)).alias("n_matches"), F.sum("qtd_totl_recl").alias("sum_qtd_totl_recl"))


@register("or_join_bag_salted", f"""WITH banks AS ({derive.SQL_BANKS}),
complaints AS ({derive.SQL_COMPLAINTS_HOT}),
ways AS (
  SELECT b.num_cnpj_instituicao, c.qtd_totl_recl FROM banks b
  JOIN complaints c ON b.num_cnpj_instituicao = c.num_cnpj_instituicao
  UNION ALL
  SELECT b.num_cnpj_instituicao, c.qtd_totl_recl FROM banks b
  JOIN complaints c ON b.nom_instituicao = c.nom_instituicao
  WHERE b.num_cnpj_instituicao IS DISTINCT FROM c.num_cnpj_instituicao)
SELECT num_cnpj_instituicao, count(*) AS n_matches, CAST(sum(qtd_totl_recl) AS BIGINT) AS sum_qtd_totl_recl
FROM ways GROUP BY num_cnpj_instituicao""")
def or_join_bag_salted(spark, sf_dir):
    """Bag key-or-name join with a hot key: heavy hitters found by a sketch, their rows salted."""
    banks = derive.banks(spark, sf_dir)
    keys = ["num_cnpj_instituicao", "nom_instituicao"]
    comp = derive.complaints_hot_key(spark, sf_dir).select(*keys, "qtd_totl_recl")
    m = joins.or_equi_join(banks, comp, [(c, c) for c in keys], heavy=joins.heavy_keys(comp, keys))
    return m.groupBy("num_cnpj_instituicao").agg(
        F.count(F.lit(1)).alias("n_matches"), F.sum("qtd_totl_recl").alias("sum_qtd_totl_recl"))


@register("or_join_bag", f"""WITH {SQL_SOURCES}
SELECT b.num_cnpj_instituicao, count(*) AS n_matches,
       max(c.qtd_totl_recl) AS max_qtd_totl_recl,
       CAST(sum(c.qtd_totl_recl) AS BIGINT) AS sum_qtd_totl_recl,
       count(c.num_cnpj_instituicao) AS n_with_key
FROM banks b JOIN complaints c
  ON b.num_cnpj_instituicao = c.num_cnpj_instituicao OR b.nom_instituicao = c.nom_instituicao
GROUP BY b.num_cnpj_instituicao""")
def or_join_bag(spark, sf_dir):
    banks, complaints, _ = sources(spark, sf_dir)
    comp = complaints.select("num_cnpj_instituicao", "nom_instituicao", "qtd_totl_recl")
    m = joins.or_equi_join(banks, comp, [("num_cnpj_instituicao", "num_cnpj_instituicao"),
                                         ("nom_instituicao", "nom_instituicao")])
    return m.groupBy("num_cnpj_instituicao").agg(
        F.count(F.lit(1)).alias("n_matches"),
        F.max("qtd_totl_recl").alias("max_qtd_totl_recl"),
        F.sum("qtd_totl_recl").alias("sum_qtd_totl_recl"),
        F.count("num_cnpj_instituicao_r").alias("n_with_key"))


_SET_COLS = ("b.nom_segto_instituicao, b.num_cnpj_instituicao, b.nom_instituicao, "
             "c.qtd_totl_clie_css_scr, c.qtd_totl_recl, c.ano, c.num_trimestre")


@register("or_join_set", f"""WITH {SQL_SOURCES},
matched AS (
  SELECT {_SET_COLS} FROM banks b JOIN complaints c
    ON b.num_cnpj_instituicao = c.num_cnpj_instituicao
  UNION
  SELECT {_SET_COLS} FROM banks b JOIN complaints c
    ON b.nom_instituicao = c.nom_instituicao)
SELECT num_cnpj_instituicao, count(*) AS n_distinct_matches,
       max(qtd_totl_recl) AS max_qtd_totl_recl
FROM matched GROUP BY num_cnpj_instituicao""")
def or_join_set(spark, sf_dir):
    banks, complaints, _ = sources(spark, sf_dir)
    comp = complaints.select("num_cnpj_instituicao", "nom_instituicao", "qtd_totl_clie_css_scr",
                             "qtd_totl_recl", "ano", "num_trimestre")
    m = joins.or_equi_join(banks, comp, [("num_cnpj_instituicao", "num_cnpj_instituicao"),
                                         ("nom_instituicao", "nom_instituicao")],
                           dedup=True, keep_right_keys=False)
    return m.groupBy("num_cnpj_instituicao").agg(
        F.count(F.lit(1)).alias("n_distinct_matches"),
        F.max("qtd_totl_recl").alias("max_qtd_totl_recl"))


SQL_QUARTERLY = f"""WITH {SQL_SOURCES},
{SQL_PER_BANK_QUARTER}
SELECT nom_instituicao, num_cnpj_instituicao, nom_segto_instituicao, ano, num_trimestre,
       CAST(clients AS DOUBLE) AS max_qtd_totl_clie_ccs_scr, CAST(rate AS DOUBLE) AS avg_ind_recl,
       CAST(complaints AS BIGINT) AS sum_qtd_totl_recl, CAST(mood AS DOUBLE) AS avg_ind_geral_instituicao,
       CAST(pay AS DOUBLE) AS avg_ind_remu_bene_instituicao
FROM per_bank_quarter"""


@register("quarterly_report", SQL_QUARTERLY)
def quarterly_report(spark, sf_dir):
    banks, complaints, employers = sources(spark, sf_dir)
    return report.quarterly_report(banks, complaints, employers)


@register("quarterly_report_unaggregated", SQL_QUARTERLY)
def quarterly_report_unaggregated(spark, sf_dir):
    banks, complaints, employers = sources(spark, sf_dir)
    return report.quarterly_report(banks, complaints, employers, pre_aggregate=False)


@register("spec_incremental", SQL_QUARTERLY)
def spec_incremental(spark, sf_dir):
    """The quarterly report from stored level-1 maxima. Complaints come in three waves: the first two
    quarters of a year, the other two, then late rows of the first two; after each the maxima
    of its quarters alone are made anew."""
    banks, complaints, employers = sources(spark, sf_dir)
    root = scratch_path(spark, "spec_incremental")
    early = F.col("num_trimestre") <= 2
    late = early & (F.col("qtd_totl_recl") % 5 == 0)
    for wave in (early & ~late, ~early, late):
        rows = complaints.where(wave)
        sinks.write_partitioned(rows, f"{root}/complaints", by=report.PERIOD, mode="append")
        jobs.refresh_maxima(spark, f"{root}/complaints", f"{root}/maxima", rows.select(*report.PERIOD))
    return jobs.spec_quarterly_frame(banks, spark.read.parquet(f"{root}/maxima"), employers, stamp=False, collapsed=True)


@register("join_key", f"""WITH {SQL_SOURCES}
SELECT c.num_cnpj_instituicao, b.nom_instituicao, b.nom_segto_instituicao,
       c.qtd_totl_clie_css_scr, c.qtd_totl_recl
FROM complaints c JOIN banks b ON c.num_cnpj_instituicao = b.num_cnpj_instituicao""")
def join_key(spark, sf_dir):
    banks, complaints, _ = sources(spark, sf_dir)
    comp = complaints.select("num_cnpj_instituicao", "qtd_totl_clie_css_scr", "qtd_totl_recl")
    return joins.equi_join(comp, banks, "num_cnpj_instituicao").select(
        "num_cnpj_instituicao", "nom_instituicao", "nom_segto_instituicao",
        "qtd_totl_clie_css_scr", "qtd_totl_recl")


@register("join_name", f"""WITH {SQL_SOURCES}
SELECT c.nom_instituicao, b.num_cnpj_instituicao, c.qtd_totl_clie_css_scr,
       c.qtd_totl_recl, e.vlr_ind_satis_geral
FROM complaints c JOIN banks b ON c.nom_instituicao = b.nom_instituicao
JOIN employers e ON c.nom_instituicao = e.nom_instituicao""")
def join_name(spark, sf_dir):
    banks, complaints, employers = sources(spark, sf_dir)
    comp = complaints.select("nom_instituicao", "qtd_totl_clie_css_scr", "qtd_totl_recl")
    out = joins.equi_join(comp, banks.select("nom_instituicao", "num_cnpj_instituicao"),
                          "nom_instituicao")
    out = joins.equi_join(out, employers.select("nom_instituicao", "vlr_ind_satis_geral"),
                          "nom_instituicao")
    return out.select("nom_instituicao", "num_cnpj_instituicao", "qtd_totl_clie_css_scr",
                      "qtd_totl_recl", "vlr_ind_satis_geral")


@register("union_all", """SELECT s_suppkey AS entity_key, s_name AS entity_name, 'supplier' AS kind
FROM supplier
UNION ALL
SELECT c_custkey AS entity_key, c_name AS entity_name, 'customer' AS kind FROM customer""")
def union_all(spark, sf_dir):
    s = derive.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("entity_key"), F.col("s_name").alias("entity_name"),
        F.lit("supplier").alias("kind"))
    c = derive.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("entity_name"), F.col("c_custkey").alias("entity_key"),
        F.lit("customer").alias("kind"))
    return joins.union_all([s, c])


@register("distinct_rows", f"""WITH {SQL_SOURCES}
SELECT DISTINCT ano, num_trimestre, qtd_totl_recl FROM complaints""")
def distinct_rows(spark, sf_dir):
    _, complaints, _ = sources(spark, sf_dir)
    return joins.distinct_rows(complaints.select("ano", "num_trimestre", "qtd_totl_recl"))


SQL_REPORT_WITH = f"{SQL_REPORT_CTES},\nreport AS ({SQL_FINAL_SNAPSHOT})"


@register("count_by_segment", f"""{SQL_REPORT_WITH}
SELECT classificacao_banco, count(nome_banco) AS n_banks FROM report GROUP BY classificacao_banco""")
def count_by_segment(spark, sf_dir):
    return report.count_by(flagship_report(spark, sf_dir), "classificacao_banco", "nome_banco",
                           alias="n_banks")


RANKINGS = {
    "rank_clients": "quantidade_clientes_banco",
    "rank_complaint_index": "indice_reclamacoes",
    "rank_complaints": "quantidade_reclamacoes",
    "rank_satisfaction": "indice_satisfacao_funcionarios_bancos",
    "rank_pay_satisfaction": "indice_satisfação_salarios_funcionarios_bancos",
}


def _ranking(column):
    def run(spark, sf_dir):
        return report.with_position(flagship_report(spark, sf_dir), column, tiebreak=["cnpj"])
    return run


for _name, _column in RANKINGS.items():
    register(_name, f"""{SQL_REPORT_WITH}
SELECT *, row_number() OVER (ORDER BY "{_column}" DESC NULLS LAST, cnpj) AS position
FROM report""")(_ranking(_column))


@register("top5_clients", f"""{SQL_REPORT_WITH}
SELECT * FROM report ORDER BY quantidade_clientes_banco DESC NULLS LAST, cnpj LIMIT 5""")
def top5_clients(spark, sf_dir):
    return report.top_k(flagship_report(spark, sf_dir), "quantidade_clientes_banco", 5,
                        tiebreak=["cnpj"])




@register("flagship_report_sql", SQL_FLAGSHIP)
def flagship_report_sql(spark, sf_dir):
    """The flagship written as Spark SQL text over DataFrame arguments."""
    banks, complaints, employers = sources(spark, sf_dir)
    return report.finalize_report(report.snapshot_report_sql(spark, banks, complaints, employers))
