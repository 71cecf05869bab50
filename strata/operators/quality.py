"""Data-quality metrics, constraint checks and the load gate.

All metrics of one run are computed by ONE ``agg`` over the frame (a single scan). Plain
metrics are combined map-side to one row per task; exact distinct counts add Spark's
Expand and a shuffle of the distinct values (``approx=True`` has neither).
Metric names, entity/instance conventions and constraint texts follow the public
Deequ library, whose result frames the load jobs write.

Semantics:
  Size               rows
  Completeness(c)    non-NULL rows / rows
  CountDistinct(c)   distinct non-NULL values (exact; ``approx=True`` -> HyperLogLog++)
  Distinctness(c)    distinct non-NULL values / non-NULL rows
  Maximum/Minimum/Mean(c), StandardDeviation(c) (population)
  Compliance(p)      rows where predicate p is true / rows
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col_ref


class DataQualityError(RuntimeError):
    """Raised by :func:`gate` when a constraint failed."""


@dataclass(frozen=True)
class Analyzer:
    name: str
    column: str | None = None
    predicate: str | None = None      # Compliance: SQL predicate text
    label: str | None = None          # Compliance: instance text
    shown: str | None = None          # Compliance: predicate as constraint texts spell it
    approx: bool = False

    @property
    def entity(self) -> str:
        return "Dataset" if self.column is None and self.name == "Size" else "Column"

    @property
    def instance(self) -> str:
        if self.name == "Size":
            return "*"
        return self.label if self.name == "Compliance" else self.column

    def expr(self) -> Column:
        rows = F.count(F.lit(1))
        if self.name == "Size":
            return rows.cast("double")
        if self.name == "Compliance":
            hit = F.sum(F.when(F.expr(self.predicate), 1).otherwise(0))
            return F.try_divide(hit.cast("double"), rows)
        c = col_ref(self.column)
        if self.name == "Completeness":
            return F.try_divide(F.count(c).cast("double"), rows)
        if self.name == "CountDistinct":
            return (F.approx_count_distinct(c) if self.approx else F.count_distinct(c)).cast("double")
        if self.name == "Distinctness":
            distinct = F.approx_count_distinct(c) if self.approx else F.count_distinct(c)
            return F.try_divide(distinct.cast("double"), F.count(c))
        if self.name == "Maximum":
            return F.max(c).cast("double")
        if self.name == "Minimum":
            return F.min(c).cast("double")
        if self.name == "Mean":
            return F.avg(c).cast("double")
        if self.name == "StandardDeviation":
            return F.stddev_pop(c).cast("double")
        raise ValueError(f"unknown analyzer {self.name}")

    def describe(self) -> str:
        if self.name == "Size":
            return "Size(None)"
        if self.name == "Compliance":
            return f"Compliance({self.label},{self.shown or self.predicate},None)"
        return f"{self.name}({self.column},None)"


def Size() -> Analyzer:  # noqa: N802 - analyzer names as in the DQ vocabulary
    return Analyzer("Size")


def Completeness(column: str) -> Analyzer:  # noqa: N802
    return Analyzer("Completeness", column)


def CountDistinct(column: str, approx: bool = False) -> Analyzer:  # noqa: N802
    return Analyzer("CountDistinct", column, approx=approx)


def Distinctness(column: str, approx: bool = False) -> Analyzer:  # noqa: N802
    return Analyzer("Distinctness", column, approx=approx)


def Maximum(column: str) -> Analyzer:  # noqa: N802
    return Analyzer("Maximum", column)


def Minimum(column: str) -> Analyzer:  # noqa: N802
    return Analyzer("Minimum", column)


def Mean(column: str) -> Analyzer:  # noqa: N802
    return Analyzer("Mean", column)


def StandardDeviation(column: str) -> Analyzer:  # noqa: N802
    return Analyzer("StandardDeviation", column)


def Compliance(label: str, predicate: str, shown: str | None = None) -> Analyzer:  # noqa: N802
    return Analyzer("Compliance", predicate=predicate, label=label, shown=shown)


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _metric_row(df: DataFrame, analyzers: list[Analyzer]) -> DataFrame:
    return df.agg(*[a.expr().alias(f"m{i}") for i, a in enumerate(analyzers)])


def analyze(df: DataFrame, analyzers: list[Analyzer]) -> DataFrame:
    """Metrics in long form ``entity, instance, name, value`` (one scan of ``df``)."""
    analyzers = list(dict.fromkeys(analyzers))
    wide = _metric_row(df, analyzers)
    args = ", ".join(f"{_sql_str(a.entity)}, {_sql_str(a.instance)}, {_sql_str(a.name)}, m{i}"
                     for i, a in enumerate(analyzers))
    return wide.selectExpr(f"stack({len(analyzers)}, {args}) AS (entity, instance, name, value)")


# ---------------------------------------------------------------------------
# Checks
# ---------------------------------------------------------------------------
@dataclass
class Constraint:
    text: str
    analyzer: Analyzer
    assertion: Callable[[float], bool]


@dataclass
class Check:
    level: str = "Warning"            # 'Warning' or 'Error'
    description: str = "Review Check"
    constraints: list[Constraint] = field(default_factory=list)

    def _add(self, text, analyzer, assertion) -> "Check":
        self.constraints.append(Constraint(text, analyzer, assertion))
        return self

    def has_size(self, assertion: Callable[[float], bool]) -> "Check":
        return self._add("SizeConstraint(Size(None))", Size(), assertion)

    def has_completeness(self, column: str, assertion: Callable[[float], bool]) -> "Check":
        a = Completeness(column)
        return self._add(f"CompletenessConstraint({a.describe()})", a, assertion)

    def is_contained_in(self, column: str, allowed: list[str]) -> "Check":
        """NULL passes; every non-NULL value must be one of ``allowed``."""
        values = ",".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
                          for v in allowed)
        predicate = f"`{column}` IS NULL OR `{column}` IN ({values})"
        a = Compliance(f"{column} contained in {','.join(allowed)}", predicate)
        return self._add(f"ComplianceConstraint({a.describe()})", a, lambda v: v == 1.0)

    def is_non_negative(self, column: str) -> "Check":
        """NULL passes; values of any size are compared as they are. The constraint text
        keeps the usual spelling, whose cast would fail on large values."""
        shown = f"COALESCE(CAST(`{column}` AS DECIMAL(20,10)), 0.0) >= 0"
        a = Compliance(f"{column} is non-negative", f"`{column}` IS NULL OR `{column}` >= 0", shown)
        return self._add(f"ComplianceConstraint({a.describe()})", a, lambda v: v == 1.0)


CHECK_RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("check_level", T.StringType()),
    T.StructField("check_status", T.StringType()),
    T.StructField("constraint", T.StringType()),
    T.StructField("constraint_status", T.StringType()),
    T.StructField("constraint_message", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
])


def _evaluate(checks: list[Check], values: dict) -> list[tuple]:
    out = []
    for chk in checks:
        results = []
        for con in chk.constraints:
            value = values[con.analyzer]
            try:
                ok = value is not None and bool(con.assertion(value))
                message = "" if ok else (
                    f"Value: {value} does not meet the constraint requirement!"
                    if value is not None else "Metric could not be computed (no rows)")
            except Exception as exc:  # noqa: BLE001 - user assertion failed
                ok, message = False, f"Can't execute the assertion: {exc}!"
            results.append((con.text, "Success" if ok else "Failure", message, value))
        status = "Success" if all(r[1] == "Success" for r in results) else chk.level
        out += [(chk.description, chk.level, status, *r) for r in results]
    return out


def _metric_values(df: DataFrame, analyzers: list[Analyzer]) -> dict:
    row = _metric_row(df, analyzers).first() if analyzers else None
    return {a: (row[f"m{i}"] if row is not None else None) for i, a in enumerate(analyzers)}


def verify(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Evaluate every constraint of every check. All metrics come from ONE aggregate
    row; only the assertions (user lambdas over scalars) run on the driver."""
    analyzers = list(dict.fromkeys(c.analyzer for chk in checks for c in chk.constraints))
    values = _metric_values(df, analyzers)
    return df.sparkSession.createDataFrame(_evaluate(checks, values), CHECK_RESULT_SCHEMA)


METRIC_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("instance", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def metric_frame(spark: SparkSession, values: dict, analyzers: list[Analyzer]) -> DataFrame:
    """Long form of metric values that are at hand."""
    return spark.createDataFrame(
        [(a.entity, a.instance, a.name, None if values[a] is None else float(values[a]))
         for a in dict.fromkeys(analyzers)], METRIC_SCHEMA)


def suite_analyzers(analyzers: list[Analyzer], checks: list[Check]) -> list[Analyzer]:
    return list(dict.fromkeys(list(analyzers) + [c.analyzer for chk in checks for c in chk.constraints]))


class WriteMetrics:
    """Metrics that are gathered while a frame is written (``DataFrame.observe``).

    Exact distinct counts cannot be observed; they, and all metrics of a write whose plan Spark
    found to be empty, are computed from the written table. The observation stands on top of
    the write, where Spark counts each output task once, also if it is run again.
    """

    def __init__(self, analyzers: list[Analyzer]) -> None:
        self.analyzers = list(dict.fromkeys(analyzers))
        self.seen = [a for a in self.analyzers if a.approx or a.name not in ("CountDistinct", "Distinctness")]
        self.observation = Observation()

    def observe(self, df: DataFrame) -> DataFrame:
        return df.observe(self.observation, *[a.expr().alias(f"m{i}") for i, a in enumerate(self.seen)])

    def values(self, written: DataFrame) -> dict:
        """Values of all analyzers; ``written`` is read for those that were not observed."""
        got = self.observation.get
        found = {a: got[f"m{i}"] for i, a in enumerate(self.seen) if f"m{i}" in got}
        return found | _metric_values(written, [a for a in self.analyzers if a not in found])


def run_suite(df: DataFrame, analyzers: list[Analyzer], checks: list[Check],
              values: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Metrics AND check results from a single scan: the analyzers of both are merged
    into one aggregate; returns ``(metrics_long_form, check_results)``. Both outputs
    are a handful of rows (one per analyzer / constraint). ``values`` that a write has
    gathered (:class:`WriteMetrics`) are taken instead of a scan."""
    if values is None:
        values = _metric_values(df, suite_analyzers(analyzers, checks))
    return (metric_frame(df.sparkSession, values, analyzers),
            df.sparkSession.createDataFrame(_evaluate(checks, values), CHECK_RESULT_SCHEMA))


ROW_FAILURES = "row_failures"


def row_predicates(checks: list[Check]) -> dict[str, str]:
    """Constraint text -> SQL predicate that a row has to meet. Completeness asks for a value, a
    compliance for its predicate (in which NULL passes); Size and other table metrics have none."""
    out: dict[str, str] = {}
    for con in (c for chk in checks for c in chk.constraints):
        a = con.analyzer
        if a.name == "Completeness":
            out[con.text] = "`" + a.column.replace("`", "``") + "` IS NOT NULL"
        elif a.name == "Compliance":
            out[con.text] = a.predicate
    return out


def row_verdicts(df: DataFrame, checks: list[Check], name: str = ROW_FAILURES) -> DataFrame:
    """``df`` with the texts of the constraints that each row fails (an empty array: none).

    A predicate without an answer (NULL) is a failure, as it is for the metric. One projection:
    no shuffle and no second scan.
    """
    failed = [F.when(~F.coalesce(F.expr(p), F.lit(False)), F.lit(text)) for text, p in row_predicates(checks).items()]
    verdict = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return df.withColumn(name, verdict)


def split_rows(judged: DataFrame, name: str = ROW_FAILURES) -> tuple[DataFrame, DataFrame]:
    """Rows of :func:`row_verdicts` that meet every constraint, and the others with their verdicts."""
    return judged.where(F.size(name) == 0).drop(name), judged.where(F.size(name) > 0)


def rejection_gate(total: int, rejected: int, limit: float) -> float:
    """Share of rejected rows (0 of no rows); stops the load above ``limit``."""
    rate = rejected / total if total else 0.0
    if rate > limit:
        raise DataQualityError(f"load stopped: {rejected} of {total} rows rejected, {rate:.4f} is above {limit}")
    return rate


def failed_constraints(check_result: DataFrame) -> DataFrame:
    return check_result.filter(F.col("constraint_status") != F.lit("Success"))


def gate(check_result: DataFrame) -> int:
    """Stop the load when any constraint failed (raises :class:`DataQualityError`)."""
    n_failed = failed_constraints(check_result).count()
    if n_failed:
        failed = [r["constraint"] for r in failed_constraints(check_result).collect()]
        raise DataQualityError(f"load stopped by {n_failed} failed quality constraint(s): {failed}")
    return 0
