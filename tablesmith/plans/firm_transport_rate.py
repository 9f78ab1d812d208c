"""Curated table ``firm_transport_rate``: one row per current contract rate/path.

Grain: one row per ``(firmid, uniqueid)`` whose newest loaded rate version
has a loaded contract header. Inputs:

* ``gtran_firm``  — contract header, key ``firmid``;
* ``gtran_rates`` — rate and path, key ``(firmid, uniqueid)``;
* ``gtran_loc``   — point quantity, key ``(firmid, loc)``, looked up twice:
  as the receipt point (``recloc``) and as the delivery point (``delloc``).

Plan: the rows of a firm meet once. Each raw table is shuffled by ``firmid``;
the dedups, the header join and the lookup of both points (a map of the firm's
points beside its header) then run where the rows are, and a projection makes
the 42 typed columns. Everything is a built-in expression.

That puts all rows of a firm into one task, so firms of more than ``LARGE_FIRM``
rows (found by a count of the keys) go another way: ``latest_by_key`` dedups by
the whole key, a join to the header and two joins to the location set, which
adaptive execution splits. The wide rows of these firms are shuffled once for
their dedup and once for the header; the lookups run on a dedup of the key and
the point codes alone, a narrow scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions import clean as C
from tablesmith.operators.contract import TableContract
from tablesmith.operators.lookup import header_orphans, inner_header, lookup_as, lookup_roles
from tablesmith.operators.versions import ROW_ID_COL, STATUS_COL, TS_COL, latest_by_key, loaded_versions
from tablesmith.plans.tabledef import Increment, TableDef

# Definition and table names, raw sources, natural key and the
# curated column names and types below must equal the published table's.
NAME = "silver_firm_transport_rate"
TABLE = "firm_transport_rate"
SOURCES = ("gtran_firm", "gtran_rates", "gtran_loc")
KEY = ("firm_id", "rate_unique_id")
ID_COL = "firm_transport_rate_id"
LOADED_TS_COL = "silver_loaded_ts"

Build = Callable[[dict[str, DataFrame]], DataFrame]

_DEC = C.decimal_type()
_SUM_DEC = T.DecimalType(38, C.DECIMAL_SCALE)

# Curated columns in table order: (name, type, nullable).
COLUMNS: list[tuple[str, T.DataType, bool]] = [
    (ID_COL, T.LongType(), False),
    ("firm_id", T.StringType(), False),
    ("rate_unique_id", T.StringType(), False),
    ("contract_id", T.StringType(), True),
    ("tsp_name", T.StringType(), True),
    ("tsp_duns", T.LongType(), True),
    ("contract_holder_name", T.StringType(), True),
    ("rate_schedule", T.StringType(), True),
    ("service_request_k", T.StringType(), True),
    ("contract_qty_dth", _DEC, True),
    ("contract_begin_ts", T.TimestampType(), True),
    ("contract_end_ts", T.TimestampType(), True),
    ("contract_term_days", T.IntegerType(), True),
    ("contract_status_code", T.StringType(), True),
    ("contract_status_desc", T.StringType(), True),
    ("is_negotiated_rate", T.BooleanType(), True),
    ("receipt_loc_code", T.StringType(), True),
    ("receipt_loc_name", T.StringType(), True),
    ("receipt_zone", T.StringType(), True),
    ("receipt_point_qty_dth", _DEC, True),
    ("delivery_loc_code", T.StringType(), True),
    ("delivery_loc_name", T.StringType(), True),
    ("delivery_zone", T.StringType(), True),
    ("delivery_point_qty_dth", _DEC, True),
    ("rate_form_type", T.StringType(), True),
    ("rate_form_type_desc", T.StringType(), True),
    ("rate_id", T.StringType(), True),
    ("rate_charged", _DEC, True),
    ("max_tariff_rate", _DEC, True),
    ("total_surcharge", _DEC, True),
    ("all_in_rate", _SUM_DEC, True),
    ("is_market_based_rate", T.BooleanType(), True),
    ("has_surcharge", T.BooleanType(), True),
    ("season_start_date", T.DateType(), True),
    ("season_end_date", T.DateType(), True),
    ("rate_begin_ts", T.TimestampType(), True),
    ("rate_end_ts", T.TimestampType(), True),
    ("posted_ts", T.TimestampType(), True),
    ("source_system", T.StringType(), True),
    ("source_api", T.StringType(), True),
    ("pipeline_run_id", T.StringType(), True),
    ("firm_hash_key", T.StringType(), True),
    ("rate_hash_key", T.StringType(), True),
    (LOADED_TS_COL, T.TimestampType(), True),
]

CONTRACT = TableContract(
    schema=T.StructType([T.StructField(n, t, nullable) for n, t, nullable in COLUMNS]),
    key=KEY,
    id_col=ID_COL,
    loaded_ts_col=LOADED_TS_COL,
)

# Columns produced by the load (all but the generated id and load time).
LOADED_COLUMNS = [n for n, _, _ in COLUMNS if n not in (ID_COL, LOADED_TS_COL)]


# The raw columns this table is made of (besides the control columns).
RAW_COLUMNS = {
    "gtran_firm": "firmid id tspname tspduns kholdername ratesch svcreqk kqtyk kbegdatetime kenddatetime kstat kstatdesc ngtdrateind hash_key".split(),
    "gtran_rates": (
        "firmid uniqueid recloc reclocname recloczn delloc dellocname delloczn rateformtype rateformtypedesc rateid ratechgd maxtrfrate "
        "totsurchg mktbasedrateind surchgind seasnlst seasnlend kentbegdatetime kentenddatetime posteddatetime source_system source_api "
        "pipeline_run_id hash_key"
    ).split(),
    "gtran_loc": "firmid loc kqtyloc".split(),
}


def latest_inputs(sources: dict[str, DataFrame], by_firm: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Newest loaded version of each firm, rate and location. Other raw
    columns are left out first, so that ties are decided by, and scans read,
    only what the table is made of. ``by_firm`` brings the rows of a firm
    together first, for joins that need no other shuffle, and leaves out rows
    without a firm."""

    def latest(table: str, *key: str, **ties) -> DataFrame:
        rows = sources[table].select(*RAW_COLUMNS[table], STATUS_COL, TS_COL, ROW_ID_COL)
        if not by_firm:
            return latest_by_key(rows, list(key), **ties)
        rows = loaded_versions(rows).where("firmid is not null").repartition("firmid")
        return latest_by_key(rows, list(key), status_col=None, **ties)

    rates = latest("gtran_rates", "firmid", "uniqueid", tie_columns=POINT_COLUMNS)
    return latest("gtran_firm", "firmid"), rates, latest("gtran_loc", "firmid", "loc")


#: Firms with more loaded rows than this, in all raw tables, are not kept together.
LARGE_FIRM = 1000
#: Up to so many firms are pushed into the scans as values.
FIRMS_PUSHED = 1000


def large_firms(sources: dict[str, DataFrame]) -> list[str] | None:
    """The firms of more than ``LARGE_FIRM`` rows; none when they are too many to name."""
    rows = None
    for name in SOURCES:
        firms = loaded_versions(sources[name]).where("firmid is not null").select("firmid")
        rows = firms if rows is None else rows.unionByName(firms)
    large = rows.groupBy("firmid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LARGE_FIRM)
    found = [r[0] for r in large.select("firmid").limit(FIRMS_PUSHED + 1).collect()]
    return found if len(found) <= FIRMS_PUSHED else None


def in_parts(sources: dict[str, DataFrame], by_firm: Build, by_key: Build) -> DataFrame:
    """``by_firm`` of the firms that can be kept together, with ``by_key`` of the
    large ones (of all rows, if there are too many large firms)."""
    large = large_firms(sources)
    if large is None:
        return by_key(sources)
    if not large:
        return by_firm(sources)
    named = F.col("firmid").isin(large)
    small, rest = ({name: df.where(part) for name, df in sources.items()} for part in (~named, named))
    return by_firm(small).unionByName(by_key(rest))


#: What the lookup of point quantities needs of a rate.
POINT_COLUMNS = ("firmid", "uniqueid", "recloc", "delloc")


def latest_points(sources: dict[str, DataFrame]) -> DataFrame:
    """Key and point codes of the newest loaded rates: the same rows as those of
    :func:`latest_inputs`, from a scan of these columns only."""
    narrow = sources["gtran_rates"].select(*POINT_COLUMNS, STATUS_COL, TS_COL, ROW_ID_COL)
    return latest_by_key(narrow, ["firmid", "uniqueid"], tie_columns=POINT_COLUMNS).select(*POINT_COLUMNS)


def rates_with_header(rate: DataFrame, firm: DataFrame, skew_safe: bool = True) -> DataFrame:
    """Latest rates joined to their latest loaded header (``f_`` columns)."""
    return inner_header(rate, firm, {"firmid": "firmid"}, header_prefix="f_", skew_safe=skew_safe)


def latest_with_header(sources: dict[str, DataFrame]) -> DataFrame:
    """Latest rates with the latest loaded header of their firm."""

    def joined(sources: dict[str, DataFrame], by_firm: bool) -> DataFrame:
        firm, rate, _ = latest_inputs(sources, by_firm)
        return rates_with_header(rate, firm, skew_safe=not by_firm)

    return in_parts(sources, lambda s: joined(s, True), lambda s: joined(s, False))


def latest_orphans(sources: dict[str, DataFrame]) -> DataFrame:
    """Latest rates without a loaded header. Whether a version has one is told by
    its key, so the others go before the dedup, which then has few rows."""
    firm, _, _ = latest_inputs(sources)
    rates = loaded_versions(sources["gtran_rates"].select(*RAW_COLUMNS["gtran_rates"], STATUS_COL, TS_COL, ROW_ID_COL))
    orphans = header_orphans(rates, firm, ["firmid"])
    return latest_by_key(orphans, ["firmid", "uniqueid"], status_col=None, tie_columns=POINT_COLUMNS)


def with_point_quantities(df: DataFrame, loc: DataFrame) -> DataFrame:
    """Receipt and delivery point quantity text of each rate (``POINT_COLUMNS``
    are kept), from one lookup of the location set."""
    return lookup_roles(df, ("firmid", "uniqueid"), loc, {"firmid": "firmid"}, "loc", "kqtyloc", {"recloc": "lr_kqtyloc", "delloc": "ld_kqtyloc"})


def loaded_column_sql() -> list[tuple[str, str]]:
    """(curated column, SQL over the joined raw columns) for the 42 loaded
    columns; header columns carry the ``f_`` prefix."""
    begin_ts = C.strict_timestamp_sql("f_kbegdatetime")
    end_ts = C.strict_timestamp_sql("f_kenddatetime")
    return [
        ("firm_id", "firmid"),
        ("rate_unique_id", "uniqueid"),
        ("contract_id", "f_id"),
        ("tsp_name", "f_tspname"),
        ("tsp_duns", C.strict_long_sql("f_tspduns")),
        ("contract_holder_name", "f_kholdername"),
        ("rate_schedule", "f_ratesch"),
        ("service_request_k", "f_svcreqk"),
        ("contract_qty_dth", C.strict_decimal_sql("f_kqtyk")),
        ("contract_begin_ts", begin_ts),
        ("contract_end_ts", end_ts),
        ("contract_term_days", C.days_between_sql(C.instant_to_date_sql(begin_ts), C.instant_to_date_sql(end_ts))),
        ("contract_status_code", "f_kstat"),
        ("contract_status_desc", "f_kstatdesc"),
        ("is_negotiated_rate", C.yes_no_flag_sql("f_ngtdrateind")),
        ("receipt_loc_code", "recloc"),
        ("receipt_loc_name", "reclocname"),
        ("receipt_zone", "recloczn"),
        ("receipt_point_qty_dth", C.strict_decimal_sql("lr_kqtyloc")),
        ("delivery_loc_code", "delloc"),
        ("delivery_loc_name", "dellocname"),
        ("delivery_zone", "delloczn"),
        ("delivery_point_qty_dth", C.strict_decimal_sql("ld_kqtyloc")),
        ("rate_form_type", "rateformtype"),
        ("rate_form_type_desc", "rateformtypedesc"),
        ("rate_id", "rateid"),
        ("rate_charged", C.strict_decimal_sql("ratechgd")),
        ("max_tariff_rate", C.strict_decimal_sql("maxtrfrate")),
        ("total_surcharge", C.strict_decimal_sql("totsurchg")),
        ("all_in_rate", C.sum_missing_as_zero_sql(C.strict_decimal_sql("ratechgd"), C.strict_decimal_sql("totsurchg"))),
        ("is_market_based_rate", C.yes_no_flag_sql("mktbasedrateind")),
        ("has_surcharge", C.yes_no_flag_sql("surchgind")),
        ("season_start_date", C.strict_date_sql("seasnlst")),
        ("season_end_date", C.strict_date_sql("seasnlend")),
        ("rate_begin_ts", C.strict_timestamp_sql("kentbegdatetime")),
        ("rate_end_ts", C.strict_timestamp_sql("kentenddatetime")),
        ("posted_ts", C.strict_timestamp_sql("posteddatetime")),
        ("source_system", "source_system"),
        ("source_api", "source_api"),
        ("pipeline_run_id", "pipeline_run_id"),
        ("firm_hash_key", "f_hash_key"),
        ("rate_hash_key", "hash_key"),
    ]


def project(df: DataFrame) -> DataFrame:
    """Raw text columns -> the 42 loaded curated columns (one projection)."""
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in loaded_column_sql()])


def rates_with_quantities(rate: DataFrame, points: DataFrame, loc: DataFrame) -> DataFrame:
    """Latest rates with the quantities of both points.

    The lookups run on the rates' ``points`` only; the result is joined back on
    the key, by which the latest rates are already partitioned, so the wide rows
    are not shuffled for it. Rates without a full key keep no quantities: they
    have no header or stop the load. The roles are looked up one after the other:
    the narrow rows then move three times, not four as in
    :func:`with_point_quantities`, and a point that only one role makes hot is
    not diluted by the other role's rows, so it is split earlier.
    """
    found = lookup_as(points, loc, {"firmid": "firmid", "recloc": "loc"}, {"kqtyloc": "lr_kqtyloc"}, role="receipt")
    found = lookup_as(found, loc, {"firmid": "firmid", "delloc": "loc"}, {"kqtyloc": "ld_kqtyloc"}, role="delivery")
    found = found.selectExpr("firmid AS __q_firmid", "uniqueid AS __q_uniqueid", "lr_kqtyloc", "ld_kqtyloc")
    on = (rate["firmid"] == found["__q_firmid"]) & (rate["uniqueid"] == found["__q_uniqueid"])
    return rate.join(found, on, "left").drop("__q_firmid", "__q_uniqueid")


def _joined_by_firm(sources: dict[str, DataFrame]) -> DataFrame:
    """Latest rates, their header and the quantities of both points, all joined
    on the firm, by which the rows are partitioned. As in
    :func:`rates_with_quantities`, rates without a full key keep no quantities."""
    firm, rate, loc = latest_inputs(sources, by_firm=True)
    point = F.struct("loc", "kqtyloc")
    points = loc.where("loc is not null").groupBy("firmid").agg(F.map_from_entries(F.collect_list(point)).alias("__points"))
    joined = rates_with_header(rate, firm.join(points, "firmid", "left"), skew_safe=False)
    found = "CASE WHEN uniqueid IS NOT NULL THEN try_element_at(f___points, {}) END AS {}"
    return joined.selectExpr("*", found.format("recloc", "lr_kqtyloc"), found.format("delloc", "ld_kqtyloc"))


def _joined_by_key(sources: dict[str, DataFrame]) -> DataFrame:
    firm, rate, loc = latest_inputs(sources)
    return rates_with_header(rates_with_quantities(rate, latest_points(sources), loc), firm)


def build(sources: dict[str, DataFrame]) -> DataFrame:
    """The 42 loaded columns of ``firm_transport_rate`` from the raw tables."""
    return in_parts(sources, lambda s: project(_joined_by_firm(s)), lambda s: project(_joined_by_key(s)))


# ------------------------------------------------------------- increments
def firm_sizes(sources: dict[str, DataFrame]) -> DataFrame:
    """About how many rows each firm has: its loaded rate versions."""
    rates = loaded_versions(sources["gtran_rates"]).where("firmid is not null")
    return rates.groupBy(F.col("firmid").alias("firm_id")).agg(F.count(F.lit(1)).alias("n"))


def changed_keys(sources: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """``firmid, uniqueid`` of all rates that new loaded rows may change.

    A new rate version changes its own key; a new header all rates of its firm;
    a new point quantity the rates with that point in either role, in any of
    their versions. Rates are read once: each names its firm and both points,
    and what changed is looked up by (firm, kind, code).
    """
    new = {name: loaded_versions(df) for name, df in new.items()}
    firms = new["gtran_firm"].select("firmid", F.lit("firm").alias("kind"), F.lit("").alias("code"))
    points = new["gtran_loc"].where("loc is not null").select("firmid", F.lit("point").alias("kind"), F.col("loc").alias("code"))
    changed = firms.unionByName(points).where("firmid is not null").distinct().withColumnRenamed("firmid", "__firm")
    rates = loaded_versions(sources["gtran_rates"]).where("firmid is not null")
    named = rates.selectExpr("firmid", "uniqueid", "stack(3, 'firm', '', 'point', recloc, 'point', delloc) AS (__kind, __code)")
    on = (F.col("firmid") == F.col("__firm")) & (F.col("__kind") == F.col("kind")) & (F.col("__code") == F.col("code"))
    touched = named.join(changed, on, "left_semi").select("firmid", "uniqueid")
    own = new["gtran_rates"].where("firmid is not null").select("firmid", "uniqueid")
    return touched.unionByName(own).distinct()


def changed_sources(sources: dict[str, DataFrame], keys: DataFrame) -> dict[str, DataFrame]:
    """The source rows that the rates of ``keys`` are built from.

    The firms of a small increment are a predicate of all three scans; those of
    a large one are joined. The rates are joined on the whole key in both cases.
    A key without ``uniqueid`` stays, so that it stops the load.
    """
    firms = keys.select("firmid").distinct()
    few = [r[0] for r in firms.limit(FIRMS_PUSHED + 1).collect()]
    if len(few) <= FIRMS_PUSHED:
        out = {name: df.where(F.col("firmid").isin(few)) for name, df in sources.items()}
    else:
        out = dict(sources)
        for name in ("gtran_firm", "gtran_loc"):
            out[name] = out[name].join(firms, "firmid", "left_semi")
    named = keys.toDF("__firmid", "__uniqueid")
    rates = out["gtran_rates"]
    out["gtran_rates"] = rates.join(named, (rates["firmid"] == named["__firmid"]) & rates["uniqueid"].eqNullSafe(named["__uniqueid"]), "left_semi")
    return out


DEFINITION = TableDef(
    name=NAME,
    table=TABLE,
    sources=SOURCES,
    contract=CONTRACT,
    build=build,
    lead=("firm_id",),
    sizes=firm_sizes,
    increment=Increment(changed_keys, changed_sources),
)
