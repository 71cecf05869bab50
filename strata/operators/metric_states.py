"""Metric states per partition, merged to the metrics of a table.

A state is one row for each partition value: rows, and for every measured column its non-NULL
count, sum, squared deviations from its own mean, extremes, and a HyperLogLog sketch of its
values. States of different partitions add up, so a refresh of some partitions writes their
states only and the metrics of the whole table need no scan of the others.

Mean and StandardDeviation are merged from counts, sums and squared deviations (those of the
partitions plus those of their means from the common mean), exact up to rounding. CountDistinct
and Distinctness come from merged sketches, whatever their ``approx``: the standard error is
1.04 / sqrt(2 ** SKETCH_BITS), and ``DISTINCT_ERROR`` is three times that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col_ref
from strata.operators.quality import Analyzer, metric_frame

SKETCH_BITS = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)
_SKETCHED = ("int", "bigint", "string", "binary")


def _measured(analyzers: list[Analyzer]) -> list[str]:
    return list(dict.fromkeys(a.column for a in analyzers if a.column))


def _predicates(analyzers: list[Analyzer]) -> list[str]:
    return list(dict.fromkeys(a.predicate for a in analyzers if a.predicate))


def _wants(analyzers: list[Analyzer], column: str, *names: str) -> bool:
    return any(a.column == column and a.name in names for a in analyzers)


def partition_states(df: DataFrame, by: list[str], analyzers: list[Analyzer]) -> DataFrame:
    """``by`` + one state row for each of its values (NULL is a value), in one aggregate."""
    kinds = dict(df.dtypes)
    out: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(_measured(analyzers)):
        c = col_ref(name)
        out.append(F.count(c).alias(f"n_{i}"))
        if _wants(analyzers, name, "Mean", "StandardDeviation"):
            out.append(F.sum(c.cast("double")).alias(f"sum_{i}"))
            out.append((F.var_pop(c) * F.count(c)).alias(f"m2_{i}"))
        if _wants(analyzers, name, "Maximum", "Minimum"):
            out += [F.max(c).cast("double").alias(f"max_{i}"), F.min(c).cast("double").alias(f"min_{i}")]
        if _wants(analyzers, name, "CountDistinct", "Distinctness"):
            value = c if kinds[name] in _SKETCHED else c.cast("string")
            out.append(F.hll_sketch_agg(value, F.lit(SKETCH_BITS)).alias(f"hll_{i}"))
    for i, predicate in enumerate(_predicates(analyzers)):
        out.append(F.count_if(F.expr(predicate)).alias(f"hits_{i}"))
    return df.groupBy(*[col_ref(c) for c in by]).agg(*out)


def replace_states(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """States of ``new``, and those of ``old`` for partitions that ``new`` does not have."""
    fresh = new.select(*[col_ref(c).alias(f"_new_{c}") for c in by])
    same = reduce(lambda a, b: a & b, [col_ref(c).eqNullSafe(F.col(f"_new_{c}")) for c in by])
    return new.unionByName(old.join(fresh, same, "left_anti"))


def merged_values(states: DataFrame, analyzers: list[Analyzer]) -> dict[Analyzer, float | None]:
    """Metrics of the table whose partitions have these states."""
    columns, predicates = _measured(analyzers), _predicates(analyzers)
    there = set(states.columns)
    totals: list[Column] = [F.sum("n_rows").alias("n_rows")]
    for i in range(len(columns)):
        for name, merge in (("n", F.sum), ("sum", F.sum), ("max", F.max), ("min", F.min)):
            if f"{name}_{i}" in there:
                totals.append(merge(f"{name}_{i}").alias(f"{name}_{i}"))
        if f"hll_{i}" in there:
            totals.append(F.hll_sketch_estimate(F.hll_union_agg(f"hll_{i}")).alias(f"hll_{i}"))
    totals += [F.sum(f"hits_{i}").alias(f"hits_{i}") for i in range(len(predicates))]
    row = states.agg(*totals).first().asDict()
    means = {i: row[f"sum_{i}"] / row[f"n_{i}"] for i in range(len(columns)) if row.get(f"sum_{i}") is not None and row[f"n_{i}"]}
    spread = {}
    if means:
        within = [F.sum(F.col(f"m2_{i}") + F.col(f"n_{i}") * F.pow(F.col(f"sum_{i}") / F.nullif(F.col(f"n_{i}"), F.lit(0)) - mean, 2))
                  .alias(f"m2_{i}") for i, mean in means.items()]
        spread = states.agg(*within).first().asDict()

    def value(a: Analyzer) -> float | None:
        rows = row["n_rows"] or 0
        if a.name == "Size":
            return float(rows)
        if a.name == "Compliance":
            return row[f"hits_{predicates.index(a.predicate)}"] / rows if rows else None
        i = columns.index(a.column)
        n = row[f"n_{i}"] or 0
        if a.name == "Completeness":
            return n / rows if rows else None
        if a.name == "CountDistinct":
            return float(row[f"hll_{i}"] or 0)
        if a.name == "Distinctness":
            return (row[f"hll_{i}"] or 0) / n if n else None
        if a.name in ("Maximum", "Minimum"):
            return row[f"{a.name[:3].lower()}_{i}"]
        if a.name == "Mean":
            return means.get(i)
        if a.name == "StandardDeviation":
            return (spread[f"m2_{i}"] / n) ** 0.5 if i in means else None
        raise ValueError(f"unknown analyzer {a.name}")

    return {a: value(a) for a in dict.fromkeys(analyzers)}


def merged_metrics(states: DataFrame, analyzers: list[Analyzer]) -> DataFrame:
    """The long form of :func:`strata.operators.quality.analyze`, from states."""
    return metric_frame(states.sparkSession, merged_values(states, analyzers), analyzers)
