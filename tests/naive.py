"""The literal OR condition (a nested-loop plan), to compare with."""

from functools import reduce

from strata.functions.columns import col_ref
from strata.operators.joins import _rename_right


def or_join_naive(left, right, pairs, right_suffix="_r"):
    left_cols, right_cols = left.columns, right.columns
    right, mapping = _rename_right(left_cols, right, right_cols, right_suffix)
    cond = reduce(lambda a, b: a | b, [col_ref(lc) == col_ref(mapping[rc]) for lc, rc in pairs])
    return left.join(right, on=cond, how="inner").select(
        *[col_ref(c) for c in left_cols], *[col_ref(mapping[c]) for c in right_cols])
