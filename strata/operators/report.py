"""Two-level report aggregations, counts, rankings and top-k.

Every level-1 aggregate of the bank report is a ``max``. ``max`` ignores repeats and
order, so complaint rows can be collapsed per (tax id, name[, year, quarter]) and
employer rows per name BEFORE the key-or-name join without changing any output value:
all rows of one collapsed group meet exactly the same banks. Spark then shuffles only
the collapsed groups (map-side partial aggregation shrinks a hot key to one row per
task), and the joins run on those small frames instead of the full fact table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col_ref
from strata.operators.joins import join_sources
from strata.operators.projection import apply_spec
from strata.schemas import report_spec

KEY = "num_cnpj_instituicao"
NAME = "nom_instituicao"
SEGMENT = "nom_segto_instituicao"
COMPLAINT_METRICS = ["qtd_totl_clie_css_scr", "qtd_totl_recl", "vlr_ind_recl"]
EMPLOYER_METRICS = ["vlr_ind_remu_bene", "vlr_ind_satis_geral"]
PERIOD = ["ano", "num_trimestre"]


def latest_max(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Level 1: one row per key with an independent ``max`` of each column.

    A ``max`` of a string is planned as a sort aggregate. So the other columns are first
    reduced per key and strings, by hash, and only that result is sorted.
    """
    kinds = dict(df.dtypes)
    texts = [c for c in columns if kinds[c] == "string"]
    if texts and len(texts) < len(columns):
        df = df.groupBy(*[col_ref(k) for k in [*keys, *texts]]).agg(
            *[F.max(col_ref(c)).alias(c) for c in columns if c not in texts])
    return df.groupBy(*[col_ref(k) for k in keys]).agg(
        *[F.max(col_ref(c)).alias(c) for c in columns])


def bank_report(level1: DataFrame) -> DataFrame:
    """Level 2 of the snapshot report (names as in the report spec).

    Grouping keys contain the tax id, so the hash partitioning left by level 1
    already satisfies this aggregation: no second shuffle.
    """
    return level1.groupBy(NAME, KEY, SEGMENT).agg(
        F.max("qtd_totl_clie_css_scr").alias("max_qtd_totl_clie_ccs_scr"),
        F.avg("vlr_ind_recl").alias("avg_ind_recl"),
        F.sum("qtd_totl_recl").alias("sum_qtd_totl_recl"),
        F.avg("vlr_ind_satis_geral").alias("avg_ind_geral_instituicao"),
        F.avg("vlr_ind_remu_bene").alias("avg_ind_remu_bene_instituicao"),
    )


def quarterly_level2(level1: DataFrame) -> DataFrame:
    """Level 2 per quarter: the client count is a mean although it keeps the ``max_`` name."""
    return level1.groupBy(NAME, KEY, SEGMENT, *PERIOD).agg(
        F.avg("qtd_totl_clie_css_scr").alias("max_qtd_totl_clie_ccs_scr"),
        F.avg("vlr_ind_recl").alias("avg_ind_recl"),
        F.sum("qtd_totl_recl").alias("sum_qtd_totl_recl"),
        F.avg("vlr_ind_satis_geral").alias("avg_ind_geral_instituicao"),
        F.avg("vlr_ind_remu_bene").alias("avg_ind_remu_bene_instituicao"),
    )


def _collapse_complaints(complaints: DataFrame, extra_keys: list[str]) -> DataFrame:
    # A row with neither tax id nor name can never match a bank.
    usable = complaints.filter(F.col(KEY).isNotNull() | F.col(NAME).isNotNull())
    return usable.groupBy(KEY, NAME, *extra_keys).agg(
        *[F.max(c).alias(c) for c in COMPLAINT_METRICS])


def complaint_maxima(complaints: DataFrame) -> DataFrame:
    """Level-1 maxima of the complaints per (tax id, name, year, quarter).

    Complaints are only ever read through these maxima, so the rows of a quarter that did not
    change need not be read again: see ``plans.jobs.refresh_maxima``.
    """
    return _collapse_complaints(complaints, PERIOD)


def _collapse_employers(employers: DataFrame) -> DataFrame:
    return employers.filter(F.col(NAME).isNotNull()).groupBy(NAME).agg(
        *[F.max(c).alias(c) for c in EMPLOYER_METRICS])


def matched_facts(banks: DataFrame, complaints: DataFrame, employers: DataFrame,
                  period: bool = False, pre_aggregate: bool = True, collapsed: bool = False) -> DataFrame:
    """Banks joined to complaints (tax id OR name) and employers (name), pruned to the
    columns the report reads. ``collapsed``: the complaints are maxima per period already."""
    extra = PERIOD if period else []
    banks = banks.select(SEGMENT, KEY, NAME)
    complaints = complaints.select(KEY, NAME, *extra, *COMPLAINT_METRICS)
    employers = employers.select(NAME, *EMPLOYER_METRICS)
    if pre_aggregate:
        complaints = complaints if collapsed and period else _collapse_complaints(complaints, extra)
        employers = _collapse_employers(employers)
    # The quarterly variant is defined on the set (distinct) form of the match;
    # after collapsing, rows are already unique per (bank, group) and every later
    # aggregate is a max, so the distinct is only needed on raw rows.
    return join_sources(banks, complaints, employers, key=KEY, name=NAME,
                        dedup=period and not pre_aggregate)


def snapshot_report(banks: DataFrame, complaints: DataFrame, employers: DataFrame,
                    pre_aggregate: bool = True) -> DataFrame:
    """Bank report: one row per tax id with clients, complaint index, complaint count
    and staff satisfaction (internal column names; see :func:`finalize_report`)."""
    joined = matched_facts(banks, complaints, employers, pre_aggregate=pre_aggregate)
    level1 = latest_max(joined, [KEY], [SEGMENT, NAME, *COMPLAINT_METRICS, *EMPLOYER_METRICS])
    return bank_report(level1)


def quarterly_report(banks: DataFrame, complaints: DataFrame, employers: DataFrame,
                     pre_aggregate: bool = True, collapsed: bool = False) -> DataFrame:
    """Bank report per (tax id, year, quarter). ``collapsed``: ``complaints`` are those of
    :func:`complaint_maxima`."""
    joined = matched_facts(banks, complaints, employers, period=True,
                           pre_aggregate=pre_aggregate, collapsed=collapsed)
    level1 = latest_max(joined, [KEY, *PERIOD],
                        [SEGMENT, NAME, *COMPLAINT_METRICS, *EMPLOYER_METRICS])
    return quarterly_level2(level1)


def finalize_report(report: DataFrame, style: str = "snapshot") -> DataFrame:
    """Rename + cast the report columns (``'snapshot'`` file names, ``'display'``
    database names or ``'internal'`` names) in one select."""
    return apply_spec(report, report_spec(style))


def count_by(df: DataFrame, key: str, column: str, alias: str = "n") -> DataFrame:
    """Non-NULL count of ``column`` per ``key``."""
    return df.groupBy(col_ref(key)).agg(F.count(col_ref(column)).alias(alias))


def _order(df: DataFrame, column: str, tiebreak: list[str] | None):
    order = [F.desc_nulls_last(col_ref(column))]
    if tiebreak:
        return order + [F.asc_nulls_last(col_ref(t)) for t in tiebreak]
    # No key given: a row hash as the last key keeps the order total and deterministic
    # and lets the range partitioner spread a heavily repeated value over many tasks.
    return order + [F.xxhash64(*[col_ref(c) for c in df.columns])]


def sort_desc(df: DataFrame, column: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Descending order, NULLs last (range-partitioned distributed sort). Pass a unique
    ``tiebreak`` to fix the order of equal values; otherwise a row hash breaks ties."""
    return df.orderBy(*_order(df, column, tiebreak))


def with_position(df: DataFrame, column: str, tiebreak: list[str] | None = None,
                  name: str = "position") -> DataFrame:
    """:func:`sort_desc` plus a 1-based ``position`` column, computed without a global
    window (which would pull every row into one task):

    1. range-partitioned sort; each row records its partition and its id within it,
       and the result is checkpointed (reliable, below ``spark.checkpoint.dir``) so
       both uses below see the same partitioning;
    2. rows per partition -> running offsets: one row per partition, a table bounded
       by the partition count, which is what gets broadcast back;
    3. position = offset of the partition + index within the partition + 1.
    """
    from pyspark.sql import Window

    from strata.session import shared_root
    shared_root(df.sparkSession)  # make sure a checkpoint folder is set
    ordered = df.orderBy(*_order(df, column, tiebreak)).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    ordered = ordered.checkpoint(eager=True)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (ordered.join(F.broadcast(offsets), "_pid")
            .select(*[col_ref(c) for c in df.columns],
                    (F.col("_off") + local + 1).alias(name)))


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows (a peek; stops reading once ``n`` rows are found)."""
    return df.limit(n)


def top_k(df: DataFrame, column: str, k: int = 5, tiebreak: list[str] | None = None) -> DataFrame:
    """First ``k`` rows of :func:`sort_desc` (planned as TakeOrderedAndProject: each task
    keeps its own top k, only k rows per task reach the final merge)."""
    return df.orderBy(*_order(df, column, tiebreak)).limit(k)


# A maximum over "same tax id OR same name" is the greater of the maximum by tax id and
# the maximum by name, so no OR join is needed; greatest() passes over NULLs.
_SNAPSHOT_SQL = """
WITH by_id AS (
  SELECT num_cnpj_instituicao AS id, max(qtd_totl_clie_css_scr) AS clients,
         max(qtd_totl_recl) AS complaints, max(vlr_ind_recl) AS rate
  FROM {complaints} WHERE num_cnpj_instituicao IS NOT NULL GROUP BY 1),
by_name AS (
  SELECT nom_instituicao AS name, max(qtd_totl_clie_css_scr) AS clients,
         max(qtd_totl_recl) AS complaints, max(vlr_ind_recl) AS rate
  FROM {complaints} WHERE nom_instituicao IS NOT NULL GROUP BY 1),
staff AS (
  SELECT nom_instituicao AS name, max(vlr_ind_satis_geral) AS mood, max(vlr_ind_remu_bene) AS pay
  FROM {employers} GROUP BY 1),
facts AS (
  SELECT b.nom_segto_instituicao AS segment, b.num_cnpj_instituicao AS id, b.nom_instituicao AS name,
         greatest(i.clients, n.clients) AS clients, greatest(i.complaints, n.complaints) AS complaints,
         greatest(i.rate, n.rate) AS rate, s.mood, s.pay
  FROM {banks} b
  JOIN staff s ON s.name = b.nom_instituicao
  LEFT JOIN by_id i ON i.id = b.num_cnpj_instituicao
  LEFT JOIN by_name n ON n.name = b.nom_instituicao
  WHERE i.id IS NOT NULL OR n.name IS NOT NULL)
SELECT max(name) AS nom_instituicao, id AS num_cnpj_instituicao, max(segment) AS nom_segto_instituicao,
       max(clients) AS max_qtd_totl_clie_ccs_scr, CAST(max(rate) AS DOUBLE) AS avg_ind_recl,
       max(complaints) AS sum_qtd_totl_recl, CAST(max(mood) AS DOUBLE) AS avg_ind_geral_instituicao,
       CAST(max(pay) AS DOUBLE) AS avg_ind_remu_bene_instituicao
FROM facts GROUP BY id
"""


def snapshot_report_sql(spark, banks: DataFrame, complaints: DataFrame,
                        employers: DataFrame) -> DataFrame:
    """The snapshot report as one Spark SQL statement over DataFrame arguments (no
    temp views). One row per tax id leaves level 1, so level 2 only renames and widens."""
    return spark.sql(_SNAPSHOT_SQL, banks=banks, complaints=complaints, employers=employers)
