"""Projection-level operators: column lists, declarative rename+cast specs, drops,
prefix filters and header cleaning. Each one is a single logical ``Project`` /
``Filter`` so Catalyst can prune columns and push predicates to the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col_ref, safe_cast


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select columns by name, in the given order."""
    return df.select(*[col_ref(c) for c in columns])


def apply_spec(df: DataFrame, spec: list[tuple[str, str, str]],
               keep: list[str] | None = None) -> DataFrame:
    """Select + rename + cast from ``[(source, target, type), ...]`` in ONE select.

    Text sources get the tolerant cast (blank -> NULL, ``'12.0'`` -> 12); typed
    sources get ``try_cast`` (overflow -> NULL instead of an ANSI error).
    ``keep`` lists extra columns to carry unchanged after the spec columns.
    Source names resolve case-insensitively, as Spark resolves them by default.
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    exprs = []
    for source, target, dtype in spec:
        from_text = isinstance(types.get(source.lower()), T.StringType)
        exprs.append(safe_cast(source, dtype, from_text=from_text).alias(target))
    exprs += [col_ref(c) for c in (keep or [])]
    return df.select(*exprs)


def drop_cols(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def filter_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose ``column`` starts with ``prefix``. Written as ``startswith`` so the
    parquet scan receives a ``StringStartsWith`` pushed filter."""
    return df.filter(col_ref(column).startswith(prefix))


def filter_first_chars(df: DataFrame, column: str, text: str) -> DataFrame:
    """The same test written with ``substring`` (only ``IsNotNull`` is pushed down)."""
    return df.filter(F.substring(col_ref(column), 1, len(text)) == F.lit(text))


def clean_header(df: DataFrame, quote_chars: str = "\"'") -> DataFrame:
    """Strip quotes/spaces from column names; on duplicates the first column wins."""
    cleaned = [name.strip().strip(quote_chars).strip() for name in df.columns]
    positional = df.toDF(*[f"_pos{i}" for i in range(len(cleaned))])
    seen: set[str] = set()
    exprs = []
    for i, name in enumerate(cleaned):
        if name.lower() in seen:
            continue
        seen.add(name.lower())
        exprs.append(F.col(f"_pos{i}").alias(name))
    return positional.select(*exprs)
