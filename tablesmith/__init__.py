"""tablesmith — versioned raw tables to curated, typed tables on Spark.

The library is a set of DataFrame operators (``operators``), column
functions (``functions``), storage helpers (``sources``) and table
definitions plus run/report plans (``plans``). Every operator takes and
returns DataFrames so Catalyst plans and optimizes the whole load.
"""

from tablesmith.operators.contract import TableContract, conform, duplicate_keys, null_counts
from tablesmith.operators.ids import assign_id, unique_id
from tablesmith.operators.lookup import header_orphans, inner_header, lookup_as, lookup_roles
from tablesmith.operators.upsert import upsert_by_key, upsert_counts
from tablesmith.operators.versions import latest_by_key, loaded_versions, superseded_versions
from tablesmith.plans.build import build_all, build_table, results_frame, run_summary, run_totals
from tablesmith.plans.report import inspect, missing_sources, snapshot_total, source_readiness, table_snapshot
from tablesmith.plans.tabledef import TableDef, default_definitions, definitions, sql_build
from tablesmith.session import build_session, ensure_checkpoint_dir
from tablesmith.sources.store import Store

__all__ = [
    "Store",
    "TableContract",
    "TableDef",
    "assign_id",
    "build_all",
    "build_session",
    "build_table",
    "conform",
    "default_definitions",
    "definitions",
    "duplicate_keys",
    "ensure_checkpoint_dir",
    "header_orphans",
    "inner_header",
    "inspect",
    "latest_by_key",
    "loaded_versions",
    "lookup_as",
    "lookup_roles",
    "missing_sources",
    "null_counts",
    "results_frame",
    "run_summary",
    "run_totals",
    "snapshot_total",
    "source_readiness",
    "sql_build",
    "superseded_versions",
    "table_snapshot",
    "unique_id",
    "upsert_by_key",
    "upsert_counts",
]
__version__ = "0.1.0"
