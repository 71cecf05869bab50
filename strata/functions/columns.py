"""Column expressions for raw-text cleaning. All are built-in Spark expressions
(JVM-side, whole-stage codegen); none is a Python UDF.

ANSI mode is on by default in Spark 4, where a plain ``cast(' ' as bigint)`` or an
``element_at`` past the end raises. Raw text is messy by nature, so every conversion
here is a ``try_`` form that yields NULL instead.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import QUARTER_LAST_MONTH, UNKNOWN_QUARTER_MONTH

_INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long", "byte", "short"}


def col_ref(name: str | Column) -> Column:
    """Column by exact name; names with spaces, dashes or ``%`` are back-quoted."""
    if isinstance(name, Column):
        return name
    return F.col("`" + name.replace("`", "``") + "`")


def safe_cast(col: str | Column, dtype: str, from_text: bool = True) -> Column:
    """Tolerant cast: blank -> NULL, surrounding spaces ignored, ``'2000.0'`` -> 2000
    for integral targets, unparsable or overflowing -> NULL.

    Integral targets go through ``decimal(38,10)`` so big identifiers stay exact
    (a double path would lose digits above 2^53); the decimal is truncated toward zero.
    (A direct integer parse first is slower on messy text: a failed string->int
    ``try_cast`` is far costlier per row than the decimal parse.)
    """
    c = col_ref(col)
    dtype = dtype.lower()
    if dtype == "string":
        return c.cast("string") if not from_text else c
    if from_text:
        c = F.trim(c)
    if dtype in _INTEGRAL:
        return c.try_cast("decimal(38,10)").try_cast(dtype)
    return c.try_cast(dtype)


def parse_decimal_br(col: str | Column, dtype: str = "double") -> Column:
    """Locale number ``16.699,13`` -> 16699.13 (dot = thousands, comma = decimal).
    Blank or unparsable -> NULL. One ``translate`` maps ',' to '.' and drops '.'."""
    return F.translate(F.trim(col_ref(col)), ",.", ".").try_cast(dtype)


def format_decimal_br(col: str | Column, scale: int = 2) -> Column:
    """Inverse of :func:`parse_decimal_br`: 1234.5 -> ``1.234,50``."""
    return F.translate(F.format_number(col_ref(col), scale), ",.", ".,")


def regex_replace(col: str | Column, pattern: str, replacement: str = "") -> Column:
    """Replace every match of a Java regex."""
    return F.regexp_replace(col_ref(col), pattern, replacement)


def strip_pattern(col: str | Column, pattern: str) -> Column:
    return regex_replace(col, pattern, "")


def fold_accents(col: str | Column, source: str = "Ô", target: str = "O") -> Column:
    """Character-for-character replacement (no regex engine involved)."""
    return F.translate(col_ref(col), source, target)


def regex_extract(col: str | Column, pattern: str, group: int = 1,
                  on_no_match: str = "empty") -> Column:
    """Group ``group`` of the first match of ``pattern``.

    on_no_match: ``'empty'`` -> '' (Spark's own behaviour), ``'keep'`` -> the input
    text, ``'null'`` -> NULL. A NULL input stays NULL in every mode.
    """
    c = col_ref(col)
    extracted = F.regexp_extract(c, pattern, group)
    if on_no_match == "empty":
        return extracted
    # only an empty extract needs a second look: an empty group, or no match at all
    matched = (extracted != "") | c.rlike(pattern)
    if on_no_match == "keep":
        return F.when(matched, extracted).otherwise(c)
    if on_no_match == "null":
        return F.when(matched, extracted)
    raise ValueError(f"on_no_match must be empty|keep|null, got {on_no_match!r}")


def split_part_at(col: str | Column, sep: str, n: int) -> Column:
    """n-th (1-based) piece of ``col`` split on the literal ``sep``; NULL when missing."""
    pieces = F.split(col_ref(col), "\\Q" + sep + "\\E")
    return F.try_element_at(pieces, F.lit(n))


def quarter_to_month(col: str | Column, ordinal_mark: str = "º") -> Column:
    """Quarter text (``'3º'`` or ``'3'``) -> last month of the quarter, ``'00'`` if unknown."""
    q = F.regexp_replace(col_ref(col), ordinal_mark, "")
    expr = None
    for quarter, month in QUARTER_LAST_MONTH.items():
        expr = (F.when(q == quarter, F.lit(month)) if expr is None
                else expr.when(q == quarter, F.lit(month)))
    return expr.otherwise(F.lit(UNKNOWN_QUARTER_MONTH))


def quarter_partition(year: str | Column, quarter: str | Column) -> Column:
    """``YYYY`` + last month of quarter + ``01`` (e.g. 2021, '3º' -> '20210901')."""
    return F.concat(col_ref(year).cast("string"), quarter_to_month(quarter), F.lit("01"))


def date_key(col: str | Column) -> Column:
    """Date or timestamp -> ``yyyyMMdd`` text."""
    return F.date_format(col_ref(col), "yyyyMMdd")


def ref_date_text(ref_date: _dt.date | str | None = None) -> str:
    if ref_date is None:
        ref_date = _dt.date.today()
    if isinstance(ref_date, str):
        return ref_date.replace("-", "")
    return ref_date.strftime("%Y%m%d")


def with_ref_date(df: DataFrame, ref_date: _dt.date | str | None = None,
                  name: str = "anomesdia") -> DataFrame:
    """Constant partition date (run date injected; defaults to today)."""
    return df.withColumn(name, F.lit(ref_date_text(ref_date)))


def with_load_ts(df: DataFrame, name: str = "dat_hor_psst") -> DataFrame:
    """Load timestamp, one value per query (``current_timestamp`` is folded once)."""
    return df.withColumn(name, F.current_timestamp())
