"""Layer jobs end to end: raw files rendered from the tables -> SoR -> SoT -> SPEC."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import sinks, sources as S
from strata.operators import quality as Q
from strata.plans import jobs as J
from strata.plans import raw_render as RR
from strata.schemas import RAW_FORMATS, all_string_schema
from strata.session import scratch_path
from strata.plans.catalog._base import register
from strata.plans.catalog.reports import SQL_FINAL_SNAPSHOT, SQL_PER_BANK, SQL_PER_BANK_QUARTER


REF_DATE = "2023-08-14"
_LAYERS: dict[tuple, dict] = {}


def _sor_schema(dataset: str) -> T.StructType:
    s = all_string_schema(RAW_FORMATS[dataset]["fields"])
    return s.add("anomesdia", T.StringType())


_DATASETS = ("bancos", "reclamacoes", "empregados")


def layers(spark, sf_dir, upto: str = "sot", datasets: tuple[str, ...] = _DATASETS) -> dict:
    """Run the layer jobs of ``datasets`` once per application and table folder; returns paths."""
    key = (spark.sparkContext.applicationId, sf_dir)
    state = _LAYERS.setdefault(key, {"sor": {}, "sot": {}})
    root = state.setdefault("root", scratch_path(spark, "layers"))
    for d in datasets:
        if d not in state["sor"]:
            landing = RR.land_raw_files(spark, sf_dir, f"{root}/landing", (d,))
            state["sor"][d] = J.run_sor(spark, d, landing[d], f"{root}/sor/{d}", REF_DATE)
        if upto in ("sot", "spec") and d not in state["sot"]:
            sor = spark.read.schema(_sor_schema(d)).parquet(state["sor"][d])
            J.run_sot(spark, d, sor, f"{root}/sot/{d}", REF_DATE, dq_root=f"{root}/data_quality")
            state["sot"][d] = f"{root}/sot/{d}"
    return state


@register("job_sor_bancos", """SELECT 'S' || CAST(s_nationkey % 5 + 1 AS VARCHAR) AS "Segmento",
       CAST(s_suppkey AS VARCHAR) AS "CNPJ",
       s_name || CASE WHEN s_suppkey % 4 = 0 THEN ' - PRUDENCIAL' ELSE '' END AS "Nome",
       '20230814' AS anomesdia
FROM supplier""")
def job_sor_bancos(spark, sf_dir):
    return spark.read.schema(_sor_schema("bancos")).parquet(layers(spark, sf_dir, "sor", ("bancos",))["sor"]["bancos"])


@register("job_sor_reclamacoes", RR.SQL_SOR_COMPLAINTS)
def job_sor_reclamacoes(spark, sf_dir):
    return spark.read.schema(_sor_schema("reclamacoes")).parquet(
        layers(spark, sf_dir, "sor", ("reclamacoes",))["sor"]["reclamacoes"])


@register("job_sor_empregados", RR.SQL_SOR_EMPLOYERS)
def job_sor_empregados(spark, sf_dir):
    return spark.read.schema(_sor_schema("empregados")).parquet(
        layers(spark, sf_dir, "sor", ("empregados",))["sor"]["empregados"])


_SOT_READ = {
    "bancos": "nom_segto_instituicao string, num_cnpj_instituicao bigint, nom_instituicao string, "
              "dat_hor_psst timestamp, anomesdia string",
}


@register("job_sot_bancos", f"""SELECT *, '20230814' AS anomesdia FROM ({RR.SQL_SOT_BANKS}) t""")
def job_sot_bancos(spark, sf_dir):
    df = spark.read.schema(_SOT_READ["bancos"]).parquet(layers(spark, sf_dir, datasets=("bancos",))["sot"]["bancos"])
    return df.drop("dat_hor_psst")


@register("job_sot_reclamacoes", RR.SQL_SOT_COMPLAINTS)
def job_sot_reclamacoes(spark, sf_dir):
    df = spark.read.parquet(layers(spark, sf_dir, datasets=("reclamacoes",))["sot"]["reclamacoes"])
    return df.drop("dat_hor_psst")


@register("job_raw_to_sot_reclamacoes", RR.SQL_SOT_COMPLAINTS)
def job_raw_to_sot_reclamacoes(spark, sf_dir):
    """Landing files -> raw -> trusted complaints, every step run by each call."""
    root = scratch_path(spark, "raw_to_sot")
    RR.land(RR.raw_reclamacoes(spark, sf_dir), f"{root}/landing", sep=";")
    sor = J.run_sor(spark, "reclamacoes", f"{root}/landing", f"{root}/sor", REF_DATE)
    done = J.run_sot(spark, "reclamacoes", spark.read.schema(_sor_schema("reclamacoes")).parquet(sor),
                     f"{root}/sot", REF_DATE, dq_root=f"{root}/dq")
    return spark.read.parquet(done.output_path).drop("dat_hor_psst")


@register("job_sot_quarantine", f"""WITH t AS ({RR.SQL_SOT_COMPLAINTS})
SELECT 'trusted' AS place, CAST('' AS VARCHAR) AS failures, count(*) AS n_rows, CAST(sum(qtd_clie_ccs) AS BIGINT) AS sum_clients
FROM t WHERE num_cnpj_instituicao IS NOT NULL AND nom_instituicao IS NOT NULL AND NOT coalesce(vlr_ind_recl < 0, false)
  AND NOT coalesce(qtd_totl_clie_css_scr < 0, false)
UNION ALL
SELECT 'quarantine', 'CompletenessConstraint(Completeness(num_cnpj_instituicao,None))', count(*),
       CAST(sum(qtd_clie_ccs) AS BIGINT)
FROM t WHERE num_cnpj_instituicao IS NULL""")
def job_sot_quarantine(spark, sf_dir):
    """Trusted complaints with rows without a tax id put aside: rows and client sums of both tables."""
    root = scratch_path(spark, "sot_quarantine")
    sor = spark.read.schema(_sor_schema("reclamacoes")).parquet(layers(spark, sf_dir, "sor", ("reclamacoes",))["sor"]["reclamacoes"])
    J.run_sot(spark, "reclamacoes", sor, f"{root}/sot", REF_DATE, dq_root=f"{root}/dq",
              quarantine_root=f"{root}/quarantine", run_id="load-1", max_rejected=0.2)
    places = {"trusted": spark.read.parquet(f"{root}/sot").withColumn(Q.ROW_FAILURES, F.array().cast("array<string>")),
              "quarantine": spark.read.parquet(f"{root}/quarantine")}
    rows = [df.select(F.lit(place).alias("place"), F.array_join(Q.ROW_FAILURES, "; ").alias("failures"), "qtd_clie_ccs")
            for place, df in places.items()]
    return (rows[0].unionByName(rows[1]).groupBy("place", "failures")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("qtd_clie_ccs").alias("sum_clients")))


@register("job_sot_empregados", f"""SELECT *, '20230814' AS anomesdia FROM ({RR.SQL_SOT_EMPLOYERS}) t""")
def job_sot_empregados(spark, sf_dir):
    path = layers(spark, sf_dir, datasets=("empregados",))["sot"]["empregados"]
    df = spark.read.parquet(path)
    return df.withColumn("anomesdia", F.col("anomesdia").cast("string")).drop("dat_hor_psst")


def _metric_sql(table: str, column: str, moments: bool) -> str:
    out = [("Completeness", f"count({column}) / count(*)")]
    if moments:
        out += [("Maximum", f"max({column})"), ("Minimum", f"min({column})"),
                ("Mean", f"avg(CAST({column} AS DOUBLE))"),
                ("StandardDeviation", f"stddev_pop(CAST({column} AS DOUBLE))")]
    return "\nUNION ALL ".join(
        f"SELECT 'tb_{table}' AS nom_tab, 'Column' AS entity, '{column}' AS instance, '{name}' AS name, "
        f"round(CAST({value} AS DOUBLE), 4) AS value FROM {table}" for name, value in out)


def _size_sql(table: str, distinct: str) -> str:
    return (f"SELECT 'tb_{table}', 'Dataset', '*', 'Size', CAST(count(*) AS DOUBLE) FROM {table}\n"
            f"UNION ALL SELECT 'tb_{table}', 'Column', '{distinct}', 'CountDistinct', "
            f"CAST(count(DISTINCT {distinct}) AS DOUBLE) FROM {table}")


@register("job_sot_metrics", "\nUNION ALL ".join([
    f"""WITH bancos AS ({RR.SQL_SOT_BANKS}), reclamacoes AS ({RR.SQL_SOT_COMPLAINTS}),
empregados AS ({RR.SQL_SOT_EMPLOYERS})
{_metric_sql("bancos", "nom_segto_instituicao", False)}""",
    _metric_sql("bancos", "num_cnpj_instituicao", False), _metric_sql("bancos", "nom_instituicao", False),
    _size_sql("bancos", "num_cnpj_instituicao"),
    _metric_sql("empregados", "vlr_ind_satis_geral", True), _metric_sql("empregados", "vlr_ind_remu_bene", True),
    _metric_sql("empregados", "nom_instituicao", False), _size_sql("empregados", "nom_instituicao"),
    _metric_sql("reclamacoes", "vlr_ind_recl", True), _metric_sql("reclamacoes", "qtd_totl_clie_css_scr", True),
    _metric_sql("reclamacoes", "nom_instituicao", False), _size_sql("reclamacoes", "nom_instituicao")]))
def job_sot_metrics(spark, sf_dir):
    """Every metric that the three trusted loads wrote."""
    m = spark.read.parquet(f"{layers(spark, sf_dir)['root']}/data_quality")
    return m.select(F.col("nom_tab").cast("string").alias("nom_tab"), "entity", "instance", "name",
                    F.round("value", 4).alias("value"))


SQL_SOT_REPORT_CTES = f"""WITH banks AS ({RR.SQL_SOT_BANKS}),
complaints AS ({RR.SQL_SOT_COMPLAINTS}),
employers AS ({RR.SQL_SOT_EMPLOYERS}),
{SQL_PER_BANK}"""


@register("job_spec_snapshot", f"{SQL_SOT_REPORT_CTES}\n{SQL_FINAL_SNAPSHOT}")
def job_spec_snapshot(spark, sf_dir):
    state = layers(spark, sf_dir)
    sot = state["sot"]
    out = J.run_spec(spark, sot["bancos"], sot["reclamacoes"], sot["empregados"],
                     scratch_path(spark, "spec_snapshot"), sink="parquet", ref_date=REF_DATE)
    return spark.read.parquet(out).drop("dat_hor_psst", "anomesdia")


_DISPLAY_SELECT = """SELECT nom_instituicao AS "Nome do Banco", CAST(num_cnpj_instituicao AS BIGINT) AS "CNPJ",
       nom_segto_instituicao AS "Classificação do Banco",
       TRY_CAST(max_qtd_totl_clie_ccs_scr AS INTEGER) AS "Quantidade de Clientes do Bancos",
       CAST(avg_ind_recl AS FLOAT) AS "Índice de reclamações",
       TRY_CAST(sum_qtd_totl_recl AS INTEGER) AS "Quantidade de reclamações",
       CAST(avg_ind_geral_instituicao AS FLOAT) AS "Índice de satisfação dos funcionários dos bancos",
       CAST(avg_ind_remu_bene_instituicao AS FLOAT)
         AS "Índice de satisfação com salários dos funcionários dos bancos"
FROM per_bank"""


@register("job_spec_display", f"{SQL_SOT_REPORT_CTES}\n{_DISPLAY_SELECT}")
def job_spec_display(spark, sf_dir):
    """Report with the database display names (the frame the JDBC sink receives)."""
    sot = layers(spark, sf_dir)["sot"]
    b, c, e = J.spec_inputs(spark, sot["bancos"], sot["reclamacoes"], sot["empregados"])
    return J.spec_frame(b, c, e, style="display", stamp=False)


@register("job_spec_csv", f"""{SQL_SOT_REPORT_CTES}
SELECT nom_instituicao, CAST(num_cnpj_instituicao AS BIGINT) AS num_cnpj_instituicao, nom_segto_instituicao,
       CAST(max_qtd_totl_clie_ccs_scr AS BIGINT) AS max_qtd_totl_clie_ccs_scr,
       round(CAST(avg_ind_recl AS DOUBLE), 6) AS avg_ind_recl,
       CAST(sum_qtd_totl_recl AS BIGINT) AS sum_qtd_totl_recl,
       round(CAST(avg_ind_geral_instituicao AS DOUBLE), 6) AS avg_ind_geral_instituicao,
       round(CAST(avg_ind_remu_bene_instituicao AS DOUBLE), 6) AS avg_ind_remu_bene_instituicao,
       true AS stamped, '20230814' AS anomesdia
FROM per_bank""")
def job_spec_csv(spark, sf_dir):
    """Snapshot report as text: internal names, doubles, load stamp and run date in it."""
    sot = layers(spark, sf_dir)["sot"]
    path = J.run_spec(spark, sot["bancos"], sot["reclamacoes"], sot["empregados"],
                      scratch_path(spark, "spec_csv"), sink="csv", ref_date=REF_DATE)
    schema = ("nom_instituicao string, num_cnpj_instituicao bigint, nom_segto_instituicao string, "
              "max_qtd_totl_clie_ccs_scr bigint, avg_ind_recl double, sum_qtd_totl_recl bigint, "
              "avg_ind_geral_instituicao double, avg_ind_remu_bene_instituicao double, "
              "dat_hor_psst timestamp, anomesdia string")
    df = S.read_delimited(spark, path, sep=";", schema=schema)
    means = [c for c in df.columns if c.startswith("avg_")]
    return df.withColumns({c: F.round(c, 6) for c in means}) \
        .withColumn("stamped", F.col("dat_hor_psst").isNotNull()).drop("dat_hor_psst")


@register("job_spec_quarterly", f"""WITH banks AS ({RR.SQL_SOT_BANKS}),
complaints AS ({RR.SQL_SOT_COMPLAINTS}),
employers AS ({RR.SQL_SOT_EMPLOYERS}),
{SQL_PER_BANK_QUARTER}
SELECT nom_instituicao, num_cnpj_instituicao, nom_segto_instituicao, ano, num_trimestre,
       round(CAST(clients AS DOUBLE), 6) AS max_qtd_totl_clie_ccs_scr,
       round(CAST(rate AS DOUBLE), 6) AS avg_ind_recl,
       CAST(complaints AS BIGINT) AS sum_qtd_totl_recl,
       round(CAST(mood AS DOUBLE), 6) AS avg_ind_geral_instituicao,
       round(CAST(pay AS DOUBLE), 6) AS avg_ind_remu_bene_instituicao, '20230814' AS anomesdia
FROM per_bank_quarter""")
def job_spec_quarterly(spark, sf_dir):
    """Quarterly report written as text, read back."""
    sot = layers(spark, sf_dir)["sot"]
    path = J.run_spec_quarterly(spark, sot["bancos"], sot["reclamacoes"], sot["empregados"],
                                scratch_path(spark, "spec_quarterly"), ref_date=REF_DATE)
    schema = ("nom_instituicao string, num_cnpj_instituicao bigint, nom_segto_instituicao string, "
              "ano int, num_trimestre int, max_qtd_totl_clie_ccs_scr double, avg_ind_recl double, "
              "sum_qtd_totl_recl bigint, avg_ind_geral_instituicao double, "
              "avg_ind_remu_bene_instituicao double, dat_hor_psst timestamp, anomesdia string")
    df = spark.read.schema(schema).option("sep", ";").option("header", True).csv(path)
    metrics = ["max_qtd_totl_clie_ccs_scr", "avg_ind_recl", "avg_ind_geral_instituicao",
               "avg_ind_remu_bene_instituicao"]
    return df.select(*[F.round(c, 6).alias(c) if c in metrics else F.col(c)
                       for c in df.columns if c != "dat_hor_psst"])


@register("job_sot_gate_stop", """SELECT 'reclamacoes' AS dataset,
  count(*) FILTER (WHERE NOT (l_linenumber = 7 AND l_orderkey % 2 = 0)) * 1.0 / count(*) < 0.99
    AS gate_raised,
  false AS output_written
FROM lineitem""")
def job_sot_gate_stop(spark, sf_dir):
    """Complaints load with a 0.99 tax-id completeness floor: the gate must stop the
    write (metrics are still appended)."""
    state = layers(spark, sf_dir, "sor", ("reclamacoes",))
    sor = spark.read.schema(_sor_schema("reclamacoes")).parquet(state["sor"]["reclamacoes"])
    out = scratch_path(spark, "sot_gate")
    profile = J.quality_profile("reclamacoes", {"num_cnpj_instituicao": 0.99})
    try:
        J.run_sot(spark, "reclamacoes", sor, out, REF_DATE, profile=profile,
                  dq_root=scratch_path(spark, "dq_gate"))
        raised = False
    except Q.DataQualityError:
        raised = True
    written = S.path_length(spark, out) is not None
    return spark.createDataFrame([("reclamacoes", raised, written)],
                                 "dataset string, gate_raised boolean, output_written boolean")


@register("job_sor_bancos_csv", """SELECT 'S' || CAST(s_nationkey % 5 + 1 AS VARCHAR) AS "Segmento",
       CAST(s_suppkey AS VARCHAR) AS "CNPJ",
       s_name || CASE WHEN s_suppkey % 4 = 0 THEN ' - PRUDENCIAL' ELSE '' END AS "Nome",
       '20230814' AS anomesdia
FROM supplier""")
def job_sor_bancos_csv(spark, sf_dir):
    """File-based layers: SoR as ';' CSV with per-date overwrite, loaded twice (the
    second load replaces the same date partition, no duplicates)."""
    state = layers(spark, sf_dir, "sor", ("bancos",))
    out = scratch_path(spark, "sor_csv")
    src = f"{state['root']}/landing/Bancos"
    for _ in range(2):
        J.run_sor(spark, "bancos", src, out, REF_DATE, fmt="csv", overwrite="partitions")
    return spark.read.schema(_sor_schema("bancos")).option("sep", ";").option("header", True) \
        .csv(out)


@register("job_sot_bancos_csv", f"""SELECT *, '20230814' AS anomesdia FROM ({RR.SQL_SOT_BANKS}) t""")
def job_sot_bancos_csv(spark, sf_dir):
    """SoT written as ';' CSV (checked from the staged Parquet, then rewritten)."""
    state = layers(spark, sf_dir, "sor", ("bancos",))
    sor = spark.read.schema(_sor_schema("bancos")).parquet(state["sor"]["bancos"])
    out = scratch_path(spark, "sot_csv")
    J.run_sot(spark, "bancos", sor, out, REF_DATE, fmt="csv", overwrite="partitions")
    return spark.read.schema(_SOT_READ["bancos"]).option("sep", ";").option("header", True) \
        .csv(out).drop("dat_hor_psst")


@register("job_spec_from_csv_layers", f"{SQL_SOT_REPORT_CTES}\n{SQL_FINAL_SNAPSHOT}")
def job_spec_from_csv_layers(spark, sf_dir):
    """File-based SPEC: the trusted tables as ';' CSV trees, read back recursively with
    type inference (partition folders are not columns) and a tax-id override, then the
    snapshot report."""
    from strata.operators import report
    from strata.sinks import write_partitioned
    sot = layers(spark, sf_dir)["sot"]
    root = scratch_path(spark, "csv_layers")
    frames = {}
    for d in ("bancos", "reclamacoes", "empregados"):
        write_partitioned(spark.read.parquet(sot[d]), f"{root}/{d}", by=J.SOT_PARTITIONS[d],
                          fmt="csv", sep=";")
        frames[d] = S.read_csv_recursive(spark, f"{root}/{d}", sep=";",
                                         overrides={"num_cnpj_instituicao": "bigint"})
    return report.finalize_report(report.snapshot_report(
        frames["bancos"], frames["reclamacoes"], frames["empregados"]))
