"""Layer jobs: raw files -> SoR (raw copy, partitioned) -> SoT (clean, typed, checked)
-> SPEC (joined report). Each ``*_frame`` function is lazy; the ``run_*`` functions
add the sinks (the only actions), the data-quality run and the gate.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import schemas as SC
from strata.functions import columns as C
from strata.operators import metric_states as MS
from strata.operators import quality as Q
from strata.operators import report as R
from strata.operators.projection import apply_spec, filter_prefix
from strata.sinks import writers as W
from strata.sources.files import path_length, read_delimited

# ---------------------------------------------------------------------------
# SoR
# ---------------------------------------------------------------------------
# Banks and employers land under one partition (the run date): tasks write their own
# files, no shuffle. Complaints spread over quarter partitions: rebalance on them so
# each quarter gets a few advisory-size files instead of one file per input task.
WRITE_LAYOUT = {"bancos": "none", "empregados": "none", "reclamacoes": "rebalance"}


def sor_frame(spark: SparkSession, dataset: str, input_path: str | list[str],
              ref_date: _dt.date | str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Raw file(s) as all-string columns + ``anomesdia`` (run date, or the quarter's
    last month for complaints)."""
    fmt = SC.RAW_FORMATS[dataset]
    raw = read_delimited(spark, input_path, sep=fmt["sep"],
                         schema=SC.all_string_schema(fmt["fields"]), header=True,
                         encoding=encoding, mode="PERMISSIVE")
    if dataset == "reclamacoes":
        return raw.withColumn("anomesdia", C.quarter_partition("Ano", "Trimestre"))
    return C.with_ref_date(raw, ref_date)


def run_sor(spark: SparkSession, dataset: str, input_path: str | list[str], output_path: str,
            ref_date: _dt.date | str | None = None, table: str | None = None,
            encoding: str = "UTF-8", overwrite: str = "table", fmt: str = "parquet",
            sep: str = ";") -> str:
    """Raw copy partitioned by ``anomesdia``. ``fmt='csv'`` (``sep``-separated, header)
    with ``overwrite='partitions'`` is the file-based layout: only the dates present in
    this load are replaced."""
    W.write_partitioned(sor_frame(spark, dataset, input_path, ref_date, encoding), output_path,
                        by="anomesdia", fmt=fmt, sep=sep, overwrite=overwrite,
                        layout=WRITE_LAYOUT[dataset])
    if table:
        W.repair_table(spark, table)
    return output_path


# ---------------------------------------------------------------------------
# SoT
# ---------------------------------------------------------------------------


def sot_bancos(sor: DataFrame, ref_date=None, stamp: bool = True) -> DataFrame:
    df = sor.withColumn("Nome", C.strip_pattern("Nome", SC.PRUDENTIAL_SUFFIX))
    df = apply_spec(df, SC.BANK_SPEC)
    if stamp:
        df = C.with_load_ts(df)
    return C.with_ref_date(df, ref_date)


def sot_empregados(sor: DataFrame, ref_date=None, stamp: bool = True,
                   on_no_match: str = "empty") -> DataFrame:
    df = filter_prefix(sor, "Segmento", "S")
    hq = "employer-headquarters"
    df = df.select(
        "*",
        C.split_part_at(hq, SC.HEADQUARTERS_SEP, 1).alias("employer-headquarters-city"),
        C.split_part_at(hq, SC.HEADQUARTERS_SEP, 2).alias("employer-headquarters-country"))
    df = df.withColumn("employer-industry",
                       C.regex_extract("employer-industry", SC.INDUSTRY_PATTERN, 1, on_no_match))
    df = df.withColumn("Nome", C.strip_pattern("Nome", SC.PRUDENTIAL_SUFFIX))
    df = apply_spec(df, SC.EMPLOYER_SPEC)
    if stamp:
        df = C.with_load_ts(df)
    return C.with_ref_date(df, ref_date)


def sot_reclamacoes(sor: DataFrame, stamp: bool = True) -> DataFrame:
    name = "Instituição financeira"
    df = sor.select(
        *[c for c in sor.columns if c not in (name, "Trimestre", "Índice")],
        C.fold_accents(C.strip_pattern(name, SC.CONGLOMERATE_SUFFIX),
                       *SC.ACCENT_FOLD).alias(name),
        C.strip_pattern("Trimestre", SC.ORDINAL_MARK).alias("Trimestre"),
        C.parse_decimal_br("Índice").alias("Índice"))
    df = apply_spec(df, SC.COMPLAINT_SPEC)
    return C.with_load_ts(df) if stamp else df


def sot_frame(dataset: str, sor: DataFrame, ref_date=None, stamp: bool = True) -> DataFrame:
    if dataset == "bancos":
        return sot_bancos(sor, ref_date, stamp)
    if dataset == "empregados":
        return sot_empregados(sor, ref_date, stamp)
    if dataset == "reclamacoes":
        return sot_reclamacoes(sor, stamp)
    raise ValueError(f"unknown dataset {dataset!r}")


SOT_PARTITIONS = {"bancos": ["anomesdia"], "empregados": ["anomesdia"],
                  "reclamacoes": ["ano", "num_trimestre"]}

#: Columns of a raw table that hold the cleaned values of the trusted partition which a row feeds
#: (raw column: trusted column). Banks and employers feed the partition of the run date.
LINEAGE = {"bancos": {}, "empregados": {}, "reclamacoes": {"lin_ano": "ano", "lin_num_trimestre": "num_trimestre"}}


def with_lineage(dataset: str, sor: DataFrame) -> DataFrame:
    """Raw rows and the trusted partition that each feeds (spellings of a value fall together).

    Raw tables partitioned by these columns are pruned to the rows of a trusted partition,
    whatever their raw date says.
    """
    if not LINEAGE[dataset]:
        return sor
    return sor.withColumns({"lin_ano": C.safe_cast("Ano", "int"),
                            "lin_num_trimestre": C.safe_cast(C.strip_pattern("Trimestre", SC.ORDINAL_MARK), "int")})


@dataclass
class QualityProfile:
    analyzers: list
    check: Q.Check
    table: str = ""


def quality_profile(dataset: str, completeness: dict[str, float] | None = None,
                    approx_distinct: bool = False) -> QualityProfile:
    """Metrics and checks of each trusted table. ``completeness`` overrides the
    minimum completeness per column (defaults are the pipeline's thresholds);
    ``approx_distinct`` computes the distinct counts with HyperLogLog++ (no shuffle
    of distinct values; for very large tables)."""
    th = dict(DEFAULT_COMPLETENESS[dataset])
    th.update(completeness or {})
    chk = Q.Check("Warning", "Review Check")
    if dataset == "bancos":
        chk = chk.is_contained_in("nom_segto_instituicao", SC.SEGMENTS).has_size(lambda n: n >= 1)
        for col in ("nom_segto_instituicao", "num_cnpj_instituicao", "nom_instituicao"):
            chk = chk.has_completeness(col, lambda v, t=th[col]: v >= t)
        analyzers = [Q.Size(), Q.Completeness("nom_segto_instituicao"),
                     Q.Completeness("num_cnpj_instituicao"), Q.Completeness("nom_instituicao"),
                     Q.CountDistinct("num_cnpj_instituicao", approx=approx_distinct)]
        return QualityProfile(analyzers, chk, "tb_bancos")
    if dataset == "empregados":
        chk = (chk.has_size(lambda n: n >= 1)
               .has_completeness("nom_instituicao", lambda v, t=th["nom_instituicao"]: v >= t)
               .is_non_negative("vlr_ind_satis_geral").is_non_negative("vlr_ind_remu_bene"))
        analyzers = [Q.Size(), Q.Completeness("vlr_ind_satis_geral"),
                     Q.Completeness("nom_instituicao"), Q.Completeness("vlr_ind_remu_bene")]
        for col in ("vlr_ind_satis_geral", "vlr_ind_remu_bene"):
            analyzers += [Q.Maximum(col), Q.Minimum(col), Q.Mean(col), Q.StandardDeviation(col)]
        analyzers.append(Q.CountDistinct("nom_instituicao", approx=approx_distinct))
        return QualityProfile(analyzers, chk, "tb_empregados")
    if dataset == "reclamacoes":
        chk = (chk.has_size(lambda n: n >= 1)
               .has_completeness("nom_instituicao", lambda v, t=th["nom_instituicao"]: v >= t)
               .has_completeness("num_cnpj_instituicao",
                                 lambda v, t=th["num_cnpj_instituicao"]: v >= t)
               .is_non_negative("vlr_ind_recl").is_non_negative("qtd_totl_clie_css_scr"))
        analyzers = [Q.Size(), Q.Completeness("vlr_ind_recl"), Q.Completeness("nom_instituicao"),
                     Q.Completeness("qtd_totl_clie_css_scr")]
        for col in ("vlr_ind_recl", "qtd_totl_clie_css_scr"):
            analyzers += [Q.Maximum(col), Q.Minimum(col), Q.Mean(col), Q.StandardDeviation(col)]
        analyzers.append(Q.CountDistinct("nom_instituicao", approx=approx_distinct))
        return QualityProfile(analyzers, chk, "tb_reclamacoes")
    raise ValueError(f"unknown dataset {dataset!r}")


# Minimum completeness per trusted column.
DEFAULT_COMPLETENESS = {
    "bancos": {"nom_segto_instituicao": 0.98, "num_cnpj_instituicao": 0.98,
               "nom_instituicao": 0.98},
    "empregados": {"nom_instituicao": 0.98},
    "reclamacoes": {"nom_instituicao": 0.9, "num_cnpj_instituicao": 0.9},
}


@dataclass
class SotResult:
    output_path: str | None
    checks: DataFrame | None = None
    metrics_path: str | None = None
    extra: dict = field(default_factory=dict)


def _table_metrics(spark: SparkSession, load: DataFrame, by: list[str], analyzers: list, staged: str,
                   states_root: str, overwrite: str) -> DataFrame:
    """Stage the states of ``load``; metrics of the table as it will be with this load."""
    states = MS.partition_states(load, by, analyzers)
    W.write_partitioned(states, staged, by=by, layout="none")
    states = spark.read.schema(states.schema).parquet(staged)
    if overwrite == "partitions" and path_length(spark, states_root) is not None:
        states = MS.replace_states(spark.read.schema(states.schema).parquet(states_root), states, by)
    return MS.merged_metrics(states, analyzers)


def _quarantine(spark: SparkSession, dataset: str, frame: DataFrame, profile: QualityProfile, root: str,
                run_id: str | None, max_rejected: float) -> DataFrame:
    """Judge the rows once, store the rejected ones, and return the others.

    The judged rows are staged, so both tables come from one evaluation (a load stamp, or a source that
    changes meanwhile, cannot put a row into both or neither); their counts are gathered by the write.
    """
    from strata.session import scratch_path
    staged = scratch_path(spark, f"judged_{dataset}")
    judged = Q.row_verdicts(frame, [profile.check])
    seen = Observation()
    W.write_partitioned(judged, staged, layout="none", observe=lambda df: df.observe(
        seen, F.count(F.lit(1)).alias("total"), F.count_if(F.size(Q.ROW_FAILURES) > 0).alias("rejected")))
    kept, rejected = Q.split_rows(spark.read.schema(judged.schema).parquet(staged))
    W.write_partitioned(rejected, f"{root}/run_id={run_id or uuid.uuid4().hex}", layout="none")
    counts = seen.get
    Q.rejection_gate(counts.get("total", 0), counts.get("rejected", 0), max_rejected)
    return kept


def run_sot(spark: SparkSession, dataset: str, sor: DataFrame, output_path: str,
            ref_date=None, dq_root: str | None = None,
            profile: QualityProfile | None = None, table: str | None = None,
            overwrite: str = "table", materialize: str = "stage",
            fmt: str = "parquet", sep: str = ";", only: DataFrame | None = None,
            run_id: str | None = None, states_root: str | None = None,
            quarantine_root: str | None = None, max_rejected: float = 1.0,
            layout: str = "none") -> SotResult:
    """Transform, measure, check, gate, publish.

    ``layout``: of the trusted files (:mod:`strata.sinks.writers`). A raw table lies by quarter
    in files of the advisory size, and so do the trusted rows that a task makes from them: no
    shuffle is needed. ``'rebalance'`` merges the rows of many small raw files, as a stream leaves them.

    ``only`` (distinct partition values of the trusted table) limits the load to those
    partitions, NULL values included. ``run_id`` names the metrics of this load: a repeat
    replaces them.

    ``fmt='csv'`` writes the trusted table as ``sep``-separated text with header (the
    staged Parquet is then rewritten, not renamed).

    ``states_root``: metric states of each partition are kept there
    (:mod:`strata.operators.metric_states`), so that a load of some partitions still stores
    the metrics of the whole table; checks and gate judge the load. A stopped load leaves
    the states as they were.

    ``quarantine_root``: rows that fail a row constraint of the profile's check (a missing value, a value
    outside its domain) do not stop the load but go to ``quarantine_root/run_id=<run>/`` with the
    texts of the constraints they fail; the trusted table, its metrics and its checks are those of
    the other rows. A load with a greater share of rejected rows than ``max_rejected`` is stopped, its
    rows left in quarantine. Every row is in exactly one of the two tables.

    ``materialize='stage'`` (default): the transformed frame is written ONCE to a
    staging table below the shared checkpoint folder. Metrics and check values are gathered
    by that write; only exact distinct counts scan the staged Parquet (their columns alone).
    A passing load is published by directory renames. The lineage is cut at the staged table, so an executor loss after the
    write costs nothing, and no 100 TB cache has to fit on executor disks.
    ``materialize='persist'``: keep the frame in executor memory/disk instead (lost
    blocks are recomputed from lineage).

    Metrics are appended BEFORE the gate so a stopped load still leaves its
    measurements; a failed gate leaves ``output_path`` untouched (the staged table
    stays below the checkpoint folder for inspection).
    """
    from strata.session import scratch_path
    profile = profile or quality_profile(dataset)
    by = SOT_PARTITIONS[dataset]
    frame = sot_frame(dataset, sor, ref_date)
    if only is not None:
        only = only.select(*[C.col_ref(c).alias(f"_only_{c}") for c in by])
        frame = frame.join(only, reduce(lambda a, b: a & b, [
            C.col_ref(c).eqNullSafe(F.col(f"_only_{c}")) for c in by]), "left_semi")
    staging = values = states = None
    if quarantine_root:
        frame = _quarantine(spark, dataset, frame, profile, quarantine_root, run_id, max_rejected)
    if materialize == "stage":
        staging = scratch_path(spark, f"stage_{dataset}")
        written = Q.WriteMetrics(Q.suite_analyzers(profile.analyzers, [profile.check]))
        W.write_partitioned(frame, staging, by=by, fmt="parquet", overwrite="table",
                            layout=layout, observe=written.observe)
        df = spark.read.schema(frame.schema).parquet(staging)
        values = written.values(df)
    elif materialize == "persist":
        df = frame.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        raise ValueError(f"materialize must be stage|persist, got {materialize!r}")
    try:
        metrics, checks = Q.run_suite(df, profile.analyzers, [profile.check], values)
        if states_root:
            states = scratch_path(spark, f"states_{dataset}")
            metrics = _table_metrics(spark, df, by, profile.analyzers, states, states_root, overwrite)
        if dq_root:
            W.append_metrics(metrics, dq_root, profile.table, ref_date, run_id=run_id)
        Q.gate(checks)
        if staging and fmt == "parquet":
            W.publish_staged(spark, staging, output_path, by, overwrite)
        else:
            W.write_partitioned(df, output_path, by=by, fmt=fmt, sep=sep, overwrite=overwrite,
                                layout=layout)
        if states:
            W.publish_staged(spark, states, states_root, by, overwrite)
        if table:
            W.repair_table(spark, table)
        return SotResult(output_path, checks, dq_root)
    finally:
        if materialize == "persist":
            df.unpersist()


# ---------------------------------------------------------------------------
# SPEC
# ---------------------------------------------------------------------------
BANK_COLUMNS = [t for _, t, _ in SC.BANK_SPEC]
EMPLOYER_COLUMNS = [*R.EMPLOYER_METRICS, R.NAME]
COMPLAINT_COLUMNS = [R.KEY, R.NAME, *R.COMPLAINT_METRICS, *R.PERIOD]


def spec_inputs(spark: SparkSession, banks: str, complaints: str, employers: str,
                from_tables: bool = False, complaint_filter=None,
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three trusted inputs pruned to the report's columns (paths or table names).

    By default every partition is read (the report covers all loaded quarters).
    ``complaint_filter`` (Column or SQL text, e.g. ``"ano >= 2022"``) restricts the
    complaint quarters; on the ``ano``/``num_trimestre`` partition columns it becomes a
    partition filter, so other quarters' files are never listed or opened."""
    def load(src, cols, where=None):
        df = spark.read.table(src) if from_tables else spark.read.parquet(src)
        if where is not None:
            df = df.filter(where)
        return df.select(*cols)
    return (load(banks, BANK_COLUMNS), load(complaints, COMPLAINT_COLUMNS, complaint_filter),
            load(employers, EMPLOYER_COLUMNS))


def spec_frame(banks: DataFrame, complaints: DataFrame, employers: DataFrame,
               style: str = "snapshot", ref_date=None, stamp: bool = True) -> DataFrame:
    """Snapshot report, renamed and cast (``style`` 'snapshot', 'display' or 'internal')."""
    out = R.finalize_report(R.snapshot_report(banks, complaints, employers), style)
    if stamp:
        out = C.with_load_ts(out)
    return C.with_ref_date(out, ref_date) if stamp else out


def refresh_maxima(spark: SparkSession, complaints: str, maxima: str, periods: DataFrame | None = None) -> str:
    """Keep the level-1 maxima of the complaints (:func:`report.complaint_maxima`) as a table of its own.

    ``complaints`` and ``maxima`` are folders partitioned by ``ano, num_trimestre``. ``periods``
    (rows of both, NULL is a value) names the quarters whose complaints changed: only their
    folders are read, and only their maxima are replaced; quarters without rows left lose
    theirs. Without ``periods`` all quarters are made anew. The maxima are staged and published by
    renames, quarter by quarter, so a lost run leaves old or new maxima of a quarter and
    is made up for by a repeat.
    """
    from strata.session import scratch_path
    source = spark.read.parquet(complaints)
    named = None
    if periods is not None:
        # one row for each partition folder that is going to be replaced
        named = periods.select(*R.PERIOD).distinct().collect()
        if not named:
            return maxima
        source = source.where(W.partition_filter(R.PERIOD, named))
    staged = scratch_path(spark, "maxima")
    W.write_partitioned(R.complaint_maxima(source.select(*COMPLAINT_COLUMNS)), staged, by=R.PERIOD)
    if named is None:
        return W.publish_staged(spark, staged, maxima, R.PERIOD, "table")
    left = {W.partition_folder(R.PERIOD, r) for r in named} - set(W.list_partitions(spark, staged, len(R.PERIOD)))
    W.publish_staged(spark, staged, maxima, R.PERIOD, "partitions")
    W.drop_partitions(spark, maxima, sorted(left))
    return maxima


def spec_quarterly_frame(banks: DataFrame, complaints: DataFrame, employers: DataFrame,
                         ref_date=None, stamp: bool = True, collapsed: bool = False) -> DataFrame:
    out = R.quarterly_report(banks, complaints, employers, collapsed=collapsed)
    if stamp:
        out = C.with_ref_date(C.with_load_ts(out), ref_date)
    return out


def run_spec(spark: SparkSession, banks: str, complaints: str, employers: str, output: str,
             sink: str = "parquet", ref_date=None, jdbc: dict | None = None,
             from_tables: bool = False, files: int | None = None) -> str:
    """sink: 'parquet' (partitioned by anomesdia), 'csv' (internal column names, means as
    doubles, load stamp and run date in the rows; ``files=1`` for one file), or 'jdbc'
    (display column names; ``jdbc`` = {url, table, properties})."""
    b, c, e = spec_inputs(spark, banks, complaints, employers, from_tables)
    if sink == "jdbc":
        out = spec_frame(b, c, e, style="display", ref_date=ref_date)
        W.write_jdbc(out, jdbc["url"], jdbc["table"], jdbc.get("properties", {}))
        return jdbc["table"]
    if sink == "csv":
        out = spec_frame(b, c, e, style="internal", ref_date=ref_date)
        return W.write_report_csv(out, output, ref_date, files=files)
    out = spec_frame(b, c, e, ref_date=ref_date)
    return W.write_partitioned(out, output, by="anomesdia", fmt="parquet", overwrite="table")


def run_spec_quarterly(spark: SparkSession, banks: str, complaints: str, employers: str,
                       output: str, ref_date=None, files: int | None = None, collapsed: bool = False) -> str:
    """``collapsed``: ``complaints`` is the table of maxima that :func:`refresh_maxima` keeps."""
    b, c, e = spec_inputs(spark, banks, complaints, employers)
    out = spec_quarterly_frame(b, c, e, ref_date=ref_date, collapsed=collapsed)
    return W.write_report_csv(out, output, ref_date, files=files)
