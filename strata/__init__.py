"""strata: layered (raw -> trusted -> report) table jobs on Spark DataFrames.

Sub-packages
------------
functions  column expressions (tolerant casts, locale numbers, regex, dates)
operators  projection specs, key-or-name joins, report aggregations, data quality
sources    delimited / recursive / catalog readers
sinks      partitioned file writers, catalog repair, JDBC, metric append
plans      composed layer jobs, their command line and the query catalogue
streaming  incremental landing-folder ingestion (Structured Streaming)

The most used entry points are re-exported here.
"""

from strata.functions.columns import (  # noqa: F401
    parse_decimal_br, quarter_partition, regex_extract, safe_cast, split_part_at,
    with_load_ts, with_ref_date,
)
from strata.operators.joins import join_sources, or_equi_join  # noqa: F401
from strata.operators.projection import apply_spec, filter_prefix  # noqa: F401
from strata.operators.quality import Check, analyze, gate, run_suite, verify  # noqa: F401
from strata.operators.report import (  # noqa: F401
    finalize_report, quarterly_report, snapshot_report, sort_desc, top_k, with_position,
)
from strata.session import build_session, scratch_path, shared_root  # noqa: F401
from strata.sinks.writers import write_partitioned  # noqa: F401
from strata.sources.files import read_delimited  # noqa: F401
