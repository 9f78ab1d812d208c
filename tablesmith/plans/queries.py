"""One query per operator of the inventory, over the test tables (``sf_dir``).

Every query reads the star tables and derives the raw-shaped tables from
them (``tablesmith.sources.adapter``), so its work grows with the data.
The DuckDB oracles live in ``oracle_queries.py`` at the repository root.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.functions import clean as C
from tablesmith.operators import contract as K
from tablesmith.operators import lookup as L
from tablesmith.operators import versions as V
from tablesmith.operators.ids import assign_id
from tablesmith.operators.upsert import upsert_by_key, upsert_counts as _upsert_counts
from tablesmith.plans import build as B
from tablesmith.plans import firm_transport_rate as FTR
from tablesmith.plans import report as R
from tablesmith.plans.tabledef import default_definitions
from tablesmith.session import checkpoint_root
from tablesmith.sources.adapter import RAW_TABLES, raw_tables
from tablesmith.sources.store import Store

# Fixed value: the upsert scenario splits rate versions at this ingestion time
# (earlier versions were loaded before; later ones arrive as the next batch).
UPSERT_CUTOFF = "1996-01-01 00:00:00"

FIRM_KEY = ["firmid"]
RATE_KEY = ["firmid", "uniqueid"]
LOC_KEY = ["firmid", "loc"]


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return raw_tables(spark, sf_dir)


def on_raw(fn):
    """Register ``fn(raw) -> DataFrame`` as a query ``(spark, sf_dir)`` over
    the raw tables derived from ``sf_dir``; ``query.from_raw(raw)`` runs the
    same query over any raw tables (for example stored ones)."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_raw(spark, sf_dir))

    query.__name__ = fn.__name__
    query.__doc__ = fn.__doc__
    query.from_raw = fn
    return query


# ------------------------------------------------------------ dedup / filters
@on_raw
def status_filter(raw):
    return V.loaded_versions(raw["gtran_firm"])


@on_raw
def latest_single_key(raw):
    return V.latest_by_key(raw["gtran_firm"], FIRM_KEY)


@on_raw
def latest_composite_key(raw):
    return V.latest_by_key(raw["gtran_rates"], RATE_KEY, narrow_first=True)


@on_raw
def latest_lookup(raw):
    return V.latest_by_key(raw["gtran_loc"], LOC_KEY)


@on_raw
def superseded_versions(raw):
    return V.superseded_versions(raw["gtran_rates"], RATE_KEY)


# ------------------------------------------------------------------- joins
@on_raw
def inner_latest_header(raw):
    return FTR.latest_with_header(raw)


@on_raw
def header_orphans(raw):
    return FTR.latest_orphans(raw)


@on_raw
def dual_role_lookup(raw):
    _, _, loc = FTR.latest_inputs(raw)
    return FTR.with_point_quantities(FTR.latest_points(raw), loc)


@on_raw
def flagship(raw):
    """The curated load: 42 loaded columns of ``firm_transport_rate``."""
    return FTR.build(raw)


@on_raw
def conform_columns(raw):
    built = FTR.build(raw)
    shuffled = built.select(*reversed(built.columns), F.lit(1).alias("not_in_contract"))
    return K.conform(shuffled, FTR.CONTRACT)


# ------------------------------------------------------------------ scalars
@on_raw
def blank_to_null(raw):
    firm = raw["gtran_firm"]
    return firm.select(
        "firmid",
        "bronze_row_id",
        C.blank_to_null("tspduns").alias("tspduns"),
        C.blank_to_null("kqtyk").alias("kqtyk"),
        C.blank_to_null("kenddatetime").alias("kenddatetime"),
        C.blank_to_null("ngtdrateind").alias("ngtdrateind"),
    )


@on_raw
def cast_long(raw):
    firm = raw["gtran_firm"]
    return firm.select("firmid", "bronze_row_id", C.strict_long("tspduns").alias("tsp_duns"))


@on_raw
def cast_decimal(raw):
    rate = raw["gtran_rates"]
    return rate.select(
        "firmid",
        "uniqueid",
        "bronze_row_id",
        C.strict_decimal("ratechgd").alias("rate_charged"),
        C.strict_decimal("maxtrfrate").alias("max_tariff_rate"),
        C.strict_decimal("totsurchg").alias("total_surcharge"),
    )


@on_raw
def cast_timestamp(raw):
    firm = raw["gtran_firm"]
    return firm.select(
        "firmid",
        "bronze_row_id",
        C.strict_timestamp("kbegdatetime").alias("contract_begin_ts"),
        C.strict_timestamp("kenddatetime").alias("contract_end_ts"),
    )


@on_raw
def cast_date(raw):
    rate = raw["gtran_rates"]
    return rate.select(
        "firmid",
        "uniqueid",
        "bronze_row_id",
        C.strict_date("seasnlst").alias("season_start_date"),
        C.strict_date("seasnlend").alias("season_end_date"),
    )


@on_raw
def ts_to_date(raw):
    firm = raw["gtran_firm"]
    return firm.select(
        "firmid",
        "bronze_row_id",
        C.ts_to_date("ingestion_timestamp").alias("ingestion_date"),
        C.instant_to_date(C.strict_timestamp_sql("kenddatetime")).alias("contract_end_date"),
    )


@on_raw
def term_days(raw):
    firm = raw["gtran_firm"]
    begin = C.instant_to_date_sql(C.strict_timestamp_sql("kbegdatetime"))
    end = C.instant_to_date_sql(C.strict_timestamp_sql("kenddatetime"))
    return firm.select("firmid", "bronze_row_id", C.days_between(begin, end).alias("contract_term_days"))


@on_raw
def yes_no_flag(raw):
    firm = raw["gtran_firm"]
    return firm.select(
        "firmid", "bronze_row_id", "ngtdrateind", C.yes_no_flag("ngtdrateind").alias("is_negotiated_rate")
    )


@on_raw
def all_in_amount(raw):
    rate = raw["gtran_rates"]
    return rate.select(
        "firmid",
        "uniqueid",
        "bronze_row_id",
        C.sum_missing_as_zero(C.strict_decimal_sql("ratechgd"), C.strict_decimal_sql("totsurchg")).alias("all_in_rate"),
    )


# ------------------------------------------------------- ids and upserts
@on_raw
def surrogate_id(raw):
    keys = FTR.build(raw).select(*FTR.KEY)
    return assign_id(keys, FTR.KEY, FTR.ID_COL)


def _split_sources(raw):
    """Raw tables as of the previous load, and the batch that arrived since."""
    ts = F.col("ingestion_timestamp")
    cutoff = F.lit(UPSERT_CUTOFF).cast("timestamp_ntz")
    before = dict(raw, gtran_rates=raw["gtran_rates"].filter(ts < cutoff))
    # an unknown ingestion time counts as new, as it does among versions
    batch = dict(raw, gtran_rates=raw["gtran_rates"].filter((ts >= cutoff) | ts.isNull()))
    return before, batch


def _upsert_inputs(raw):
    before, batch = _split_sources(raw)
    target = assign_id(FTR.build(before), FTR.KEY, FTR.ID_COL)
    incoming = FTR.build(batch)
    return target, incoming


@on_raw
def upsert_by_key_query(raw):
    target, incoming = _upsert_inputs(raw)
    return upsert_by_key(target, incoming, FTR.KEY, FTR.ID_COL)


@on_raw
def upsert_counts(raw):
    target, incoming = _upsert_inputs(raw)
    return _upsert_counts(target, incoming, FTR.KEY, FTR.ID_COL)


# ----------------------------------------------------------- contract checks
@on_raw
def duplicate_keys(raw):
    return K.duplicate_keys(raw["gtran_rates"], RATE_KEY)


@on_raw
def null_key_counts(raw):
    cols = ["firm_id", "rate_unique_id", "receipt_loc_code", "tsp_duns", "contract_qty_dth", "receipt_point_qty_dth"]
    return K.null_counts(FTR.build(raw), cols)


# ---------------------------------------------------------- store reports
def _query_store(spark, sf_dir, root=None) -> Store:
    store = Store(spark, root or checkpoint_root(spark), locations={"bronze": sf_dir})
    for name, df in raw_tables(spark, sf_dir).items():
        store.register_view("bronze", name, df)
    return store


def table_snapshot(spark, sf_dir):
    store = _query_store(spark, sf_dir)
    return R.table_snapshot(store, store.raw_schema)


def snapshot_total(spark, sf_dir):
    store = _query_store(spark, sf_dir)
    return R.snapshot_total(R.table_snapshot(store, store.raw_schema))


def source_readiness(spark, sf_dir):
    store = _query_store(spark, sf_dir)
    return R.source_readiness(store, default_definitions())


# ------------------------------------------------------------- run results
def load_row_count(spark, sf_dir):
    """Build every definition into a scratch store and remove it again; what
    the loads reported."""
    root = f"{checkpoint_root(spark).rstrip('/')}/query-store-{uuid.uuid4().hex}"
    store = _query_store(spark, sf_dir, root=root)
    try:
        results = B.build_all(store, default_definitions())
    finally:
        store.discard(root)
    return B.results_frame(spark, results).select("name", "status", "rows")


QUERIES = {
    "status_filter": status_filter,
    "latest_single_key": latest_single_key,
    "latest_composite_key": latest_composite_key,
    "latest_lookup": latest_lookup,
    "inner_latest_header": inner_latest_header,
    "dual_role_lookup": dual_role_lookup,
    "flagship": flagship,
    "conform_columns": conform_columns,
    "blank_to_null": blank_to_null,
    "cast_long": cast_long,
    "cast_decimal": cast_decimal,
    "cast_timestamp": cast_timestamp,
    "cast_date": cast_date,
    "ts_to_date": ts_to_date,
    "term_days": term_days,
    "yes_no_flag": yes_no_flag,
    "all_in_amount": all_in_amount,
    "surrogate_id": surrogate_id,
    "upsert_by_key": upsert_by_key_query,
    "upsert_counts": upsert_counts,
    "load_row_count": load_row_count,
    "duplicate_keys": duplicate_keys,
    "null_key_counts": null_key_counts,
    "table_snapshot": table_snapshot,
    "snapshot_total": snapshot_total,
    "source_readiness": source_readiness,
    "header_orphans": header_orphans,
    "superseded_versions": superseded_versions,
}

assert set(RAW_TABLES) == set(FTR.SOURCES)
