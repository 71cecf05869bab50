from strata.functions.columns import (  # noqa: F401
    col_ref, date_key, fold_accents, format_decimal_br, parse_decimal_br, quarter_partition,
    quarter_to_month, regex_extract, regex_replace, safe_cast, split_part_at, strip_pattern,
    with_load_ts, with_ref_date,
)
