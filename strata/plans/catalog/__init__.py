"""Query catalogue: one Spark query per operator, each with its DuckDB oracle.

Every query reads the benchmark tables (or frames Spark derives from them) in full,
so its work grows with the tables. Oracles use the same derivation expressions in SQL.
Money/ratio sums are rounded on both sides; load timestamps are never emitted.

Modules register in this order: reports, cleaning, quality, sources_sinks, layers,
landing.
"""

from strata.plans.catalog._base import ORACLES, QUERIES, register, sources  # noqa: F401
from strata.plans.catalog import reports, cleaning, quality, sources_sinks, layers, landing  # noqa: F401,E402
from strata.plans.catalog.reports import (  # noqa: F401
    SQL_FLAGSHIP, flagship_report, flagship_report_sql, quarterly_report,
)
from strata.plans.catalog.layers import REF_DATE, _sor_schema, layers as run_layers  # noqa: F401
from strata.plans.catalog.landing import _landing_with_extras, route_by_path, stream_run  # noqa: F401
