"""Joins and set operations.

The key-or-name match ``a.k = b.k OR a.n = b.n`` has no equi-join key, so Catalyst can
only plan it as a nested-loop join (every left row against every right row). It is
rewritten here as a UNION ALL of equi-joins, which Spark runs as hash / sort-merge /
broadcast joins chosen at runtime by AQE:

    branch_i = left JOIN right ON k_i = k_i'  WHERE NOT coalesce(k_j = k_j', false), j < i

A pair (l, r) is emitted by exactly one branch iff some key pair is equal, so the
result is bag-equal to the OR join, NULL keys included (NULL never matches).

The default ``strategy="tagged"`` runs the same branches as ONE equi-join: each side
is exploded into one row per key pair (tag i, only key i set, rows with a NULL key i
dropped) and joined on (tag, key). Each input is then scanned and shuffled once,
where the UNION ALL form scans both inputs once per branch.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col_ref


def equi_join(left: DataFrame, right: DataFrame, on: str | list[str],
              how: str = "inner") -> DataFrame:
    """Plain equi-join on shared column name(s) (tax id, institution name, ...)."""
    return left.join(right, on=on, how=how)


def _rename_right(left_cols: list[str], right: DataFrame, right_cols: list[str],
                  suffix: str) -> tuple[DataFrame, dict]:
    clash = {c.lower() for c in left_cols}
    mapping = {c: (c + suffix if c.lower() in clash else c) for c in right_cols}
    if all(mapping[c] == c for c in right_cols):
        return right, mapping
    renamed = right.select(*[col_ref(c).alias(mapping[c]) for c in right_cols])
    return renamed, mapping


def or_equi_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]],
                 dedup: bool = False, right_suffix: str = "_r",
                 keep_right_keys: bool = True, strategy: str = "tagged",
                 heavy: list[HeavyKey] | None = None) -> DataFrame:
    """Inner join where ANY of the column pairs is equal.

    Output = all left columns, then all right columns (names that clash with a left
    column get ``right_suffix``); ``keep_right_keys=False`` leaves out the right-side
    join columns. ``dedup=True`` returns the set form (distinct output rows), i.e. the
    union of the per-key joins without repeats; rows that repeat within an input are
    dropped before the join, so repeats are not multiplied first.

    ``heavy`` (from :func:`heavy_keys`; tagged strategy only): right rows of these keys are spread
    over salts, and left rows of them, and of no others, are copied once for each salt. The
    pairs are the same.
    """
    if not pairs:
        raise ValueError("or_equi_join needs at least one (left, right) column pair")
    if dedup:
        left, right = left.distinct(), right.distinct()
    left_cols, right_cols = left.columns, right.columns
    right_r, mapping = _rename_right(left_cols, right, right_cols, right_suffix)
    right_keys = {rc for _, rc in pairs}
    out_cols = [col_ref(c) for c in left_cols] + [
        col_ref(mapping[c]) for c in right_cols if keep_right_keys or c not in right_keys]

    def eq(pair):
        lcol, rcol = pair
        return col_ref(lcol) == col_ref(mapping[rcol])

    if strategy == "tagged" and len(pairs) > 1:
        result = _tagged_join(left, right_r, [(lc, mapping[rc]) for lc, rc in pairs], eq, pairs, heavy)
        result = result.select(*out_cols)
        return result.distinct() if dedup else result
    if heavy:
        raise ValueError("heavy keys need the tagged strategy and two key pairs at least")
    if strategy not in ("tagged", "union"):
        raise ValueError(f"strategy must be tagged|union, got {strategy!r}")

    branches = []
    for i, pair in enumerate(pairs):
        joined = left.join(right_r, on=eq(pair), how="inner")
        for earlier in pairs[:i]:
            joined = joined.filter(~F.coalesce(eq(earlier), F.lit(False)))
        branches.append(joined.select(*out_cols))
    result = reduce(lambda a, b: a.unionByName(b), branches)
    return result.distinct() if dedup else result


def _tagged(df: DataFrame, cols: list[str], prefix: str) -> DataFrame:
    """One row per key pair i: ``{prefix}t`` = i, ``{prefix}v{i}`` = key i, other keys NULL.
    Rows whose active key is NULL can never match and are dropped here."""
    entries = []
    for i in range(len(cols)):
        fields = [F.lit(i).alias(f"{prefix}t")]
        for j, c in enumerate(cols):
            # untyped NULL: array() coerces each struct field to the key's type
            value = col_ref(c) if j == i else F.lit(None)
            fields.append(value.alias(f"{prefix}v{j}"))
        entries.append(F.struct(*fields))
    alive = reduce(lambda a, b: a | b,
                   [F.col(f"{prefix}v{j}").isNotNull() for j in range(len(cols))])
    return df.select("*", F.inline(F.array(*entries))).filter(alive)


class HeavyKey(NamedTuple):
    """A key value that many rows hold: key pair, value, and the number of salts it gets."""

    pair: int
    value: object
    salts: int


def heavy_keys(right: DataFrame, columns: list[str], share: float | None = None, k: int = 256,
               tracked: int = 10_000) -> list[HeavyKey]:
    """Heavy hitters of the key columns of the fact side, for ``or_equi_join(heavy=...)``.

    One aggregate (``approx_top_k``, a frequent-items sketch per column) over the key columns
    alone gives up to ``k`` values a column, a table of bounded size. A value is heavy if it holds
    more than ``share`` of the rows that enter the join (default: half of a shuffle
    partition's share) and gets as many salts as it holds such shares. Estimates move rows
    between tasks only; the join is exact with any list.
    """
    spark = right.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = share or 0.5 / partitions
    aggs = []
    for i, c in enumerate(columns):
        # NULL keys never enter the join
        known = F.expr("filter(transform(approx_top_k({c}, {k}, {t}), x -> struct(x.item AS item, x.count AS n)), "
                       "x -> x.item IS NOT NULL)".format(c="`" + c.replace("`", "``") + "`", k=k, t=max(tracked, k)))
        aggs += [known.alias(f"top_{i}"), F.count(col_ref(c)).alias(f"n_{i}")]
    row = right.agg(*aggs).first()
    total = sum(row[f"n_{i}"] for i in range(len(columns)))
    found = []
    for i in range(len(columns)):
        for item, n in row[f"top_{i}"] or []:
            if n > share * total:
                found.append(HeavyKey(i, item, min(partitions, math.ceil(n / (share * total)))))
    return found


def _salts(heavy: list[HeavyKey], prefix: str, n: int) -> Column:
    """Salts of the active key of a tagged row: 1 unless it is heavy."""
    per_pair = [F.lit(1)] * n
    for i in range(n):
        known = [h for h in heavy if h.pair == i]
        if known:
            salts = F.create_map(*[F.lit(x) for h in known for x in (h.value, h.salts)])
            per_pair[i] = F.coalesce(F.try_element_at(salts, F.col(f"{prefix}v{i}")), F.lit(1))
    chosen = per_pair[-1]
    for i in range(n - 1):
        chosen = F.when(F.col(f"{prefix}t") == i, per_pair[i]).otherwise(chosen)
    return chosen


def _tagged_join(left: DataFrame, right_r: DataFrame, mapped: list[tuple[str, str]],
                 eq, pairs, heavy: list[HeavyKey] | None = None) -> DataFrame:
    n = len(mapped)
    lt = _tagged(left, [lc for lc, _ in mapped], "_l")
    rt = _tagged(right_r, [rc for _, rc in mapped], "_r")
    cond = F.col("_lt") == F.col("_rt")
    if heavy:
        # the salt comes from the row's place, so equal rows spread too; whichever salt a row gets,
        # it meets each left row exactly once
        lt = lt.withColumn("_ls", F.explode(F.sequence(F.lit(0), _salts(heavy, "_l", n) - 1)))
        rt = rt.withColumn("_rs", F.pmod(F.xxhash64(F.monotonically_increasing_id()), _salts(heavy, "_r", n)).cast("int"))
        cond = cond & (F.col("_ls") == F.col("_rs"))
    for j in range(n):
        cond = cond & F.col(f"_lv{j}").eqNullSafe(F.col(f"_rv{j}"))
    joined = lt.join(rt, on=cond, how="inner")
    # tag i keeps a pair only if no earlier key pair already matched it
    for i in range(1, n):
        earlier = reduce(lambda a, b: a | b,
                         [F.coalesce(eq(p), F.lit(False)) for p in pairs[:i]])
        joined = joined.filter((F.col("_lt") != i) | ~earlier)
    return joined


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Vertical concat by column name (no dedup)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def distinct_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Whole-row distinct, or first-seen row per ``subset`` key."""
    return df.dropDuplicates(subset) if subset else df.distinct()


def join_sources(banks: DataFrame, complaints: DataFrame, employers: DataFrame,
                 key: str = "num_cnpj_instituicao", name: str = "nom_instituicao",
                 dedup: bool = False) -> DataFrame:
    """banks ⋈(key OR name) complaints ⋈(name) employers.

    Output columns: every bank column, complaint columns other than key/name,
    employer columns other than name.
    """
    comp = complaints.select(
        col_ref(key).alias("_c_key"), col_ref(name).alias("_c_name"),
        *[col_ref(c) for c in complaints.columns if c.lower() not in (key.lower(), name.lower())])
    matched = or_equi_join(banks, comp, [(key, "_c_key"), (name, "_c_name")], dedup=dedup,
                           keep_right_keys=False)
    emp = employers.select(
        col_ref(name).alias("_e_name"),
        *[col_ref(c) for c in employers.columns if c.lower() != name.lower()])
    return (matched.join(emp, col_ref(name) == F.col("_e_name"), "inner")
            .drop("_e_name"))
