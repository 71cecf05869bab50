"""Landing-folder ingestion (Structured Streaming, availableNow) and path routing."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata import sinks, sources as S, streaming as ST
from strata.functions import columns as C
from strata.operators import joins, quality as Q
from strata.plans import derive
from strata.plans import jobs as J
from strata.plans import raw_render as RR
from strata.schemas import RAW_FORMATS
from strata.session import scratch_path
from strata.plans.catalog._base import register
from strata.plans.catalog.layers import REF_DATE, _sor_schema


_STREAM: dict[tuple, dict] = {}
_LANDING: dict[tuple, dict] = {}


def _landing_with_extras(spark, sf_dir) -> dict:
    """Raw feeds + an empty file + a file no route matches (written once per app)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDING:
        _LANDING[key] = _write_landing(spark, sf_dir)
    return _LANDING[key]


def _write_landing(spark, sf_dir) -> dict:
    root = scratch_path(spark, "landing_stream")
    landing = f"{root}/landing"
    RR.land_raw_files(spark, sf_dir, landing)
    sinks.touch_empty(spark, f"{landing}/Bancos/empty-Bancos.csv")
    region = derive.table(spark, sf_dir, "region").select(F.col("r_name").alias("x"))
    sinks.write_partitioned(region, f"{landing}/Outros", fmt="csv", sep=";")
    return {"root": root, "landing": landing}


def stream_run(spark, sf_dir) -> dict:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STREAM:
        st = _landing_with_extras(spark, sf_dir)
        ST.stream_landing(spark, st["landing"], f"{st['root']}/sor", f"{st['root']}/_checkpoint",
                          ref_date=REF_DATE, quarantine_root=f"{st['root']}/quarantine",
                          timeout_s=900, sot_root=f"{st['root']}/sot",
                          dq_root=f"{st['root']}/data_quality")
        _STREAM[key] = st
    return _STREAM[key]


@register("stream_landing", """SELECT 'bancos' AS dataset, count(*) AS n_rows FROM supplier
UNION ALL SELECT 'reclamacoes', count(*) FROM lineitem
UNION ALL SELECT 'empregados', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation)
UNION ALL SELECT 'unrouted', count(*) + 1 FROM region""")
def stream_landing(spark, sf_dir):
    """Rows per dataset in the SoR folders written by the stream (+ quarantined lines,
    which include the unrouted file's header line)."""
    st = stream_run(spark, sf_dir)
    counts = [spark.read.parquet(f"{st['root']}/sor/{d}").agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(d).alias("dataset"), "n_rows") for d in RAW_FORMATS]
    counts.append(spark.read.parquet(f"{st['root']}/quarantine").agg(
        F.count(F.lit(1)).alias("n_rows")).select(F.lit("unrouted").alias("dataset"), "n_rows"))
    return joins.union_all(counts)


@register("stream_sor_bancos", """SELECT 'S' || CAST(s_nationkey % 5 + 1 AS VARCHAR) AS "Segmento",
       CAST(s_suppkey AS VARCHAR) AS "CNPJ",
       s_name || CASE WHEN s_suppkey % 4 = 0 THEN ' - PRUDENCIAL' ELSE '' END AS "Nome",
       '20230814' AS anomesdia
FROM supplier""")
def stream_sor_bancos(spark, sf_dir):
    st = stream_run(spark, sf_dir)
    return spark.read.schema(_sor_schema("bancos")).parquet(f"{st['root']}/sor/bancos") \
        .select("Segmento", "CNPJ", "Nome", "anomesdia")


@register("stream_sor_reclamacoes", RR.SQL_SOR_COMPLAINTS)
def stream_sor_reclamacoes(spark, sf_dir):
    st = stream_run(spark, sf_dir)
    return spark.read.schema(_sor_schema("reclamacoes")).parquet(
        f"{st['root']}/sor/reclamacoes").drop("batch_id", *J.LINEAGE["reclamacoes"])


@register("stream_sot_reclamacoes", RR.SQL_SOT_COMPLAINTS)
def stream_sot_reclamacoes(spark, sf_dir):
    """Trusted complaints rebuilt by the stream's raw -> trusted chain."""
    st = stream_run(spark, sf_dir)
    return spark.read.parquet(f"{st['root']}/sot/reclamacoes").drop("dat_hor_psst")


@register("stream_sot_empregados",
          f"""SELECT *, '20230814' AS anomesdia FROM ({RR.SQL_SOT_EMPLOYERS}) t""")
def stream_sot_empregados(spark, sf_dir):
    st = stream_run(spark, sf_dir)
    df = spark.read.parquet(f"{st['root']}/sot/empregados")
    return df.withColumn("anomesdia", F.col("anomesdia").cast("string")).drop("dat_hor_psst")


@register("route_by_path", """SELECT 'bancos' AS dataset, count(*) AS n_data_lines FROM supplier
UNION ALL SELECT 'reclamacoes', count(*) FROM lineitem
UNION ALL SELECT 'empregados', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation)""")
def route_by_path(spark, sf_dir):
    """Batch form of the routing: rows of the landed files per dataset."""
    st = _landing_with_extras(spark, sf_dir)
    files = ST.routed_files(spark.read.format("binaryFile").option("recursiveFileLookup", True)
                            .load(st["landing"]))
    return joins.union_all([
        J.sor_frame(spark, dataset, paths, REF_DATE).agg(F.count(F.lit(1)).alias("n_data_lines"))
        .select(F.lit(dataset).alias("dataset"), "n_data_lines")
        for dataset, paths in ST.nonempty_by_dataset(files).items() if dataset])


@register("stream_unrouted", """SELECT true AS raised, false AS raw_written, count(*) AS n_lines_left FROM region""")
def stream_unrouted(spark, sf_dir):
    """A file without a route and without a quarantine folder: the stream stops before it
    writes, and the lines are still to be had when a folder is given."""
    root = scratch_path(spark, "stream_unrouted")
    landing = f"{root}/landing"
    sinks.write_partitioned(RR.raw_bancos(spark, sf_dir), f"{landing}/Bancos", fmt="csv", sep="\t")
    sinks.write_partitioned(derive.table(spark, sf_dir, "region").select("r_name"), f"{landing}/Outros",
                            fmt="csv", header=False)
    where = dict(sor_root=f"{root}/sor", checkpoint=f"{root}/checkpoint", ref_date=REF_DATE, timeout_s=900)
    try:
        ST.stream_landing(spark, landing, **where)
        raised = False
    except StreamingQueryException:
        raised = True
    written = S.path_length(spark, f"{root}/sor") is not None
    ST.stream_landing(spark, landing, quarantine_root=f"{root}/quarantine", **where)
    return (spark.read.parquet(f"{root}/quarantine").agg(F.count(F.lit(1)).alias("n_lines_left"))
            .select(F.lit(raised).alias("raised"), F.lit(written).alias("raw_written"), "n_lines_left"))


def _respelled(raw):
    """Odd lines spell year and quarter another way, so a quarter has several raw dates."""
    odd = F.col("Quantidade de reclamações reguladas - outras").cast("int") % 2 != 0
    return raw.withColumns({
        "Ano": F.when(odd, F.concat("Ano", F.lit(".0"))).otherwise(F.col("Ano")),
        "Trimestre": F.when(odd, F.concat(F.lit(" "), "Trimestre")).otherwise(F.col("Trimestre"))})


@register("stream_refresh_partitions", f"""SELECT * EXCLUDE (anomesdia) FROM ({RR.SQL_SOT_COMPLAINTS}) t""")
def stream_refresh_partitions(spark, sf_dir):
    """Complaints landed in two waves with mixed spellings, trusted partitions refreshed
    after each: the trusted table holds every row of both."""
    root = scratch_path(spark, "stream_waves")
    raw = _respelled(RR.raw_reclamacoes(spark, sf_dir))
    first = F.col("Quantidade de reclamações reguladas - outras").cast("int") % 3 == 0
    for wave in (first, ~first):
        RR.land(raw.filter(wave), f"{root}/landing/Reclamacoes", sep=";", mode="append")
        ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/checkpoint", ref_date=REF_DATE,
                          timeout_s=900, sot_root=f"{root}/sot", refresh="partitions")
    return spark.read.parquet(f"{root}/sot/reclamacoes").drop("dat_hor_psst", "anomesdia")


_RAW_BANK_SQL = """SELECT 'S' || CAST(s_nationkey % 5 + 1 AS VARCHAR) AS "Segmento", CAST(s_suppkey AS VARCHAR) AS "CNPJ",
       s_name || CASE WHEN s_suppkey % 4 = 0 THEN ' - PRUDENCIAL' ELSE '' END AS "Nome",
       {date} AS anomesdia
FROM supplier"""


@register("stream_redelivered", _RAW_BANK_SQL.format(
    date="CASE WHEN s_suppkey % 2 = 0 THEN '20230814' ELSE '20230816' END"))
def stream_redelivered(spark, sf_dir):
    """Half of the banks land; a day later all their files land again under other names, beside the
    other half. The run of that day is lost before its batch is committed (the commit entry is
    taken out) and made up for another day later. Raw rows: each bank once, under the date of
    the run that stands."""
    root = scratch_path(spark, "stream_redelivered")
    raw = RR.raw_bancos(spark, sf_dir)
    even = F.col("CNPJ").cast("long") % 2 == 0

    def land(rows, name):
        sinks.write_partitioned(rows, f"{root}/landing/Bancos/{name}", fmt="csv", sep="\t", empty_value="")

    def run(date):
        ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/checkpoint", ref_date=date, timeout_s=900)

    land(raw.where(even), "first")
    run("2023-08-14")
    land(raw.where(even), "again")
    land(raw.where(~even), "second")
    run("2023-08-15")
    last = max(int(n) for n in sinks.list_names(spark, f"{root}/checkpoint/commits") if n.isdigit())
    sinks.remove_file(spark, f"{root}/checkpoint/commits/{last}")
    run("2023-08-16")
    return spark.read.schema(_sor_schema("bancos")).parquet(f"{root}/sor/bancos") \
        .select("Segmento", "CNPJ", "Nome", "anomesdia")


@register("stream_rerun_next_day", _RAW_BANK_SQL.format(date="'20230815'"))
def stream_rerun_next_day(spark, sf_dir):
    """One batch written on two dates, as after a failure late in the day: the rows of the second
    date replace those of the first."""
    root = scratch_path(spark, "stream_rerun")
    sinks.write_partitioned(RR.raw_bancos(spark, sf_dir), f"{root}/landing/Bancos", fmt="csv", sep="\t", empty_value="")
    files = ST.routed_files(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/landing"))
    for date in ("2023-08-14", "2023-08-15"):
        ST.Landing(f"{root}/sor", date).write_batch(files, 0)
    return spark.read.schema(_sor_schema("bancos")).parquet(f"{root}/sor/bancos") \
        .select("Segmento", "CNPJ", "Nome", "anomesdia")


@register("stream_refresh_pruned", """SELECT CAST(year(l_shipdate) AS INTEGER) AS ano,
       CAST(quarter(l_shipdate) AS INTEGER) AS num_trimestre, count(*) AS n_read, count(*) AS n_trusted
FROM lineitem WHERE quarter(l_shipdate) IN (2, 4) GROUP BY ALL""")
def stream_refresh_pruned(spark, sf_dir):
    """Complaints in two waves, the second with late rows of second and fourth quarters alone and mixed
    spellings in both: raw rows that the second refresh reads, and trusted rows, per quarter."""
    root = scratch_path(spark, "stream_pruned")
    raw = _respelled(RR.raw_reclamacoes(spark, sf_dir))
    late = (F.col("Quantidade de reclamações reguladas - outras").cast("int") % 3 == 0) \
        & F.substring(F.trim("Trimestre"), 1, 1).isin("2", "4")
    for wave in (~late, late):
        RR.land(raw.filter(wave), f"{root}/landing/Reclamacoes", sep=";", mode="append")
        ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/checkpoint", ref_date=REF_DATE,
                          timeout_s=900, sot_root=f"{root}/sot", refresh="partitions")
    last = max(int(name.partition("=")[2]) for name in sinks.list_names(spark, f"{root}/sor/reclamacoes")
               if name.startswith("batch_id="))
    read = J.sot_frame("reclamacoes", ST.Landing(f"{root}/sor", REF_DATE).feeding(spark, "reclamacoes", last))
    read = read.groupBy("ano", "num_trimestre").agg(F.count(F.lit(1)).alias("n_read"))
    trusted = (spark.read.parquet(f"{root}/sot/reclamacoes").groupBy("ano", "num_trimestre")
               .agg(F.count(F.lit(1)).alias("n_trusted")))
    return read.join(trusted, ["ano", "num_trimestre"])


@register("stream_refresh_metrics", f"""WITH reclamacoes AS ({RR.SQL_SOT_COMPLAINTS})
SELECT name, value FROM (
  SELECT 'Size' AS name, CAST(count(*) AS DOUBLE) AS value FROM reclamacoes
  UNION ALL SELECT 'Completeness', round(CAST(count(vlr_ind_recl) / count(*) AS DOUBLE), 4) FROM reclamacoes
  UNION ALL SELECT 'Maximum', round(CAST(max(vlr_ind_recl) AS DOUBLE), 4) FROM reclamacoes
  UNION ALL SELECT 'Minimum', round(CAST(min(vlr_ind_recl) AS DOUBLE), 4) FROM reclamacoes
  UNION ALL SELECT 'Mean', round(avg(CAST(vlr_ind_recl AS DOUBLE)), 4) FROM reclamacoes
  UNION ALL SELECT 'StandardDeviation', round(stddev_pop(CAST(vlr_ind_recl AS DOUBLE)), 4) FROM reclamacoes) t""")
def stream_refresh_metrics(spark, sf_dir):
    """Complaints in two waves by quarter parity, trusted partitions refreshed after each: the
    metrics that the last refresh stored are those of the whole table, not of its partitions."""
    root = scratch_path(spark, "stream_metrics")
    raw = RR.raw_reclamacoes(spark, sf_dir)
    odd = F.substring(F.trim("Trimestre"), 1, 1).isin("1", "3")
    for wave in (odd, ~odd):
        RR.land(raw.filter(wave), f"{root}/landing/Reclamacoes", sep=";", mode="append")
        ST.stream_landing(spark, f"{root}/landing", f"{root}/sor", f"{root}/checkpoint", ref_date=REF_DATE,
                          timeout_s=900, sot_root=f"{root}/sot", dq_root=f"{root}/dq", refresh="partitions")
    m = spark.read.parquet(f"{root}/dq")
    last = F.max(F.regexp_extract("run_id", r"(\d+)$", 1).cast("int"))
    last = m.agg(last.alias("last")).select(F.concat(F.lit("batch-"), "last").alias("run_id"))
    return (m.join(last, "run_id").where(F.col("instance").isin("*", "vlr_ind_recl"))
            .select("name", F.round("value", 4).alias("value")))


@register("stream_equals_batch", RR.SQL_SOR_EMPLOYERS.replace("SELECT ", "SELECT 1 AS n_stream, 1 AS n_batch, "))
def stream_equals_batch(spark, sf_dir):
    """Every raw employer row with its count in the streamed and in the batch-loaded raw table."""
    st = stream_run(spark, sf_dir)
    both = {"n_stream": spark.read.schema(_sor_schema("empregados")).parquet(f"{st['root']}/sor/empregados"),
            "n_batch": J.sor_frame(spark, "empregados", f"{st['landing']}/Empregados", REF_DATE)}
    cols = _sor_schema("empregados").names
    counted = joins.union_all([
        df.select(*[C.col_ref(c) for c in cols], *[F.lit(int(k == name)).alias(k) for k in both])
        for name, df in both.items()])
    return counted.groupBy(*[C.col_ref(c) for c in cols]).agg(*[F.sum(k).alias(k) for k in both])


@register("metrics_rerun", """SELECT 'tb_bancos' AS nom_tab, 'Size' AS name, 2 AS n_runs,
       CAST(count(*) AS DOUBLE) AS smallest, CAST(count(*) AS DOUBLE) AS largest FROM supplier""")
def metrics_rerun(spark, sf_dir):
    """One run written twice and another once: each run has each metric once."""
    root = scratch_path(spark, "metrics_rerun")
    banks = derive.banks(spark, sf_dir)
    for run in ("batch-0", "batch-0", "batch-1"):
        sinks.append_metrics(Q.analyze(banks, [Q.Size()]), root, "tb_bancos", REF_DATE, run_id=run)
    return (spark.read.parquet(root).groupBy(F.col("nom_tab").cast("string").alias("nom_tab"), "name")
            .agg(F.count(F.lit(1)).alias("n_runs"), F.min("value").alias("smallest"),
                 F.max("value").alias("largest")))
