"""DuckDB SQL oracles for the ``queries()`` in ``__spark_entry__.py``.

Each string runs on DuckDB with the star tables registered as views
(``orders``, ``lineitem``, ...). The raw-shaped tables are rebuilt here
with the same expressions as ``tablesmith.sources.adapter``; everything
after that states the result in plain SQL.

Differences between engines handled here:
* date difference: ``CAST(end - start AS INTEGER)``;
* casts to ``DECIMAL(37,10)`` so ``a + b`` is ``DECIMAL(38,10)`` on both sides.
"""

from __future__ import annotations

# ---------------------------------------------------------------- raw tables
RAW_FIRM = """
gtran_firm AS (
  SELECT
    CAST(o_orderkey AS VARCHAR) AS firmid,
    'K' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(ver AS VARCHAR) AS id,
    o_orderpriority AS tspname,
    CASE WHEN o_custkey % 10 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS tspduns,
    'holder ' || CAST(o_custkey AS VARCHAR) AS kholdername,
    o_orderstatus AS ratesch,
    'S' || CAST(o_orderkey AS VARCHAR) AS svcreqk,
    CASE WHEN o_orderkey % 7 = 0 THEN ''
         ELSE CAST(CAST(o_totalprice + ver AS DECIMAL(18,2)) AS VARCHAR) END AS kqtyk,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || CASE WHEN o_orderkey % 3 = 1 THEN ' 07:30:05' ELSE '' END AS kbegdatetime,
    CASE WHEN o_orderkey % 13 = 0 THEN ''
         ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS VARCHAR)
              || CASE WHEN o_orderkey % 5 = 2 THEN ' 23:45:10' ELSE '' END END AS kenddatetime,
    o_orderstatus AS kstat,
    'status ' || o_orderstatus AS kstatdesc,
    CASE o_orderkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'n' WHEN 2 THEN '' ELSE 'X' END AS ngtdrateind,
    'hf' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(ver AS VARCHAR) AS hash_key,
    CASE WHEN ver = 3 THEN 'FAILED' WHEN o_orderkey % 50 = 49 THEN 'FAILED' ELSE 'LOADED' END AS ingestion_status,
    CASE WHEN o_orderkey % 11 = 0 AND ver = 1 THEN NULL
         WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00'
         ELSE TIMESTAMP '2024-01-01 00:00:00' + ver * INTERVAL 1 DAY END AS ingestion_timestamp,
    o_orderkey * 10 + ver AS bronze_row_id
  FROM (SELECT *, unnest([1, 2, 3]) AS ver FROM orders) o
  WHERE ver = 1 OR o_orderkey % 2 = 0
)"""

RAW_RATES = """
gtran_rates AS (
  SELECT
    CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS firmid,
    CAST(l_linenumber AS VARCHAR) AS uniqueid,
    CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS recloc,
    'rec ' || CAST(l_suppkey AS VARCHAR) AS reclocname,
    l_returnflag AS recloczn,
    CAST(l_suppkey + l_linenumber % 2 AS VARCHAR) AS delloc,
    'del ' || CAST(l_suppkey AS VARCHAR) AS dellocname,
    l_linestatus AS delloczn,
    l_returnflag AS rateformtype,
    'form ' || l_returnflag AS rateformtypedesc,
    CAST(l_partkey AS VARCHAR) AS rateid,
    CASE WHEN l_partkey % 9 = 0 THEN '' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS ratechgd,
    CAST(CAST(l_extendedprice * 2 AS DECIMAL(18,2)) AS VARCHAR) AS maxtrfrate,
    CASE WHEN l_partkey % 5 = 0 THEN '' ELSE CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) END AS totsurchg,
    l_returnflag AS mktbasedrateind,
    CASE WHEN l_tax > 0 THEN 'y' ELSE 'N' END AS surchgind,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS seasnlst,
    CASE WHEN l_suppkey % 6 = 0 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) + 30 AS VARCHAR) END AS seasnlend,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS kentbegdatetime,
    CASE WHEN l_suppkey % 4 = 0 THEN ''
         ELSE CAST(CAST(l_shipdate AS DATE) + 90 AS VARCHAR) || ' 12:00:00' END AS kentenddatetime,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS posteddatetime,
    'star' AS source_system,
    'lineitem' AS source_api,
    'run-' || CAST(l_suppkey % 3 AS VARCHAR) AS pipeline_run_id,
    'hr' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS hash_key,
    CASE WHEN l_partkey % 20 = 0 THEN 'FAILED' ELSE 'LOADED' END AS ingestion_status,
    CASE WHEN l_suppkey % 23 <> 0 THEN l_shipdate END AS ingestion_timestamp,
    l_suppkey * 1000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS bronze_row_id
  FROM lineitem
)"""

RAW_LOC = """
gtran_loc AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) AS firmid,
    CASE WHEN l_suppkey % 29 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS loc,
    CASE WHEN l_linenumber = 3 THEN '' ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) END AS kqtyloc,
    CASE WHEN l_partkey % 25 = 0 THEN 'FAILED' ELSE 'LOADED' END AS ingestion_status,
    l_shipdate AS ingestion_timestamp,
    l_partkey * 1000 + l_linenumber AS bronze_row_id
  FROM lineitem
)"""

RAW = {"gtran_firm": RAW_FIRM, "gtran_rates": RAW_RATES, "gtran_loc": RAW_LOC}

FIRM_COLS = (
    "firmid, id, tspname, tspduns, kholdername, ratesch, svcreqk, kqtyk, kbegdatetime, "
    "kenddatetime, kstat, kstatdesc, ngtdrateind, hash_key, ingestion_status, ingestion_timestamp, bronze_row_id"
)
RATE_COLS = (
    "firmid, uniqueid, recloc, reclocname, recloczn, delloc, dellocname, delloczn, rateformtype, "
    "rateformtypedesc, rateid, ratechgd, maxtrfrate, totsurchg, mktbasedrateind, surchgind, seasnlst, "
    "seasnlend, kentbegdatetime, kentenddatetime, posteddatetime, source_system, source_api, "
    "pipeline_run_id, hash_key, ingestion_status, ingestion_timestamp, bronze_row_id"
)
LOC_COLS = "firmid, loc, kqtyloc, ingestion_status, ingestion_timestamp, bronze_row_id"


def newest(name: str, source: str, keys: str, cols: str, where: str = "TRUE") -> str:
    """The good version of each key that no other good version comes after;
    an unknown time or number comes last of all."""
    return f"""
{name} AS (
  SELECT {cols} FROM {source}
  WHERE ingestion_status = 'LOADED' AND ({where})
  QUALIFY 1 = count(*) OVER (
    PARTITION BY {keys}
    ORDER BY ingestion_timestamp IS NULL DESC, ingestion_timestamp DESC, bronze_row_id IS NULL DESC, bronze_row_id DESC
    ROWS UNBOUNDED PRECEDING)
)"""


CONTRACTS = newest("contracts", "gtran_firm", "firmid", FIRM_COLS)
PATHS = newest("paths", "gtran_rates", "firmid, uniqueid", RATE_COLS)
POINTS = newest("points", "gtran_loc", "firmid, loc", LOC_COLS)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def dec(x: str) -> str:
    return f"CAST(NULLIF({x}, '') AS DECIMAL(37,10))"


def ts(x: str) -> str:
    return f"CAST(NULLIF({x}, '') AS TIMESTAMP)"


def flag(x: str) -> str:
    return f"CASE upper(NULLIF({x}, '')) WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END"



def point_qty(code: str) -> str:
    """The quantity text of a path's point; there is one row per firm and point."""
    return f"(SELECT max(q.kqtyloc) FROM points q WHERE q.firmid = p.firmid AND q.loc = p.{code})"


# (curated column, expression over a path ``p`` and its contract ``c``)
_CURATED = [
    ("firm_id", "p.firmid"), ("rate_unique_id", "p.uniqueid"), ("contract_id", "c.id"), ("tsp_name", "c.tspname"),
    ("tsp_duns", "CAST(NULLIF(c.tspduns, '') AS BIGINT)"), ("contract_holder_name", "c.kholdername"),
    ("rate_schedule", "c.ratesch"), ("service_request_k", "c.svcreqk"), ("contract_qty_dth", dec("c.kqtyk")),
    ("contract_begin_ts", ts("c.kbegdatetime")), ("contract_end_ts", ts("c.kenddatetime")),
    ("contract_term_days", f"CAST(CAST({ts('c.kenddatetime')} AS DATE) - CAST({ts('c.kbegdatetime')} AS DATE) AS INTEGER)"),
    ("contract_status_code", "c.kstat"), ("contract_status_desc", "c.kstatdesc"), ("is_negotiated_rate", flag("c.ngtdrateind")),
    ("receipt_loc_code", "p.recloc"), ("receipt_loc_name", "p.reclocname"), ("receipt_zone", "p.recloczn"),
    ("receipt_point_qty_dth", dec(point_qty("recloc"))),
    ("delivery_loc_code", "p.delloc"), ("delivery_loc_name", "p.dellocname"), ("delivery_zone", "p.delloczn"),
    ("delivery_point_qty_dth", dec(point_qty("delloc"))),
    ("rate_form_type", "p.rateformtype"), ("rate_form_type_desc", "p.rateformtypedesc"), ("rate_id", "p.rateid"),
    ("rate_charged", dec("p.ratechgd")), ("max_tariff_rate", dec("p.maxtrfrate")), ("total_surcharge", dec("p.totsurchg")),
    ("all_in_rate", f"COALESCE({dec('p.ratechgd')}, 0) + COALESCE({dec('p.totsurchg')}, 0)"),
    ("is_market_based_rate", flag("p.mktbasedrateind")), ("has_surcharge", flag("p.surchgind")),
    ("season_start_date", "CAST(NULLIF(p.seasnlst, '') AS DATE)"), ("season_end_date", "CAST(NULLIF(p.seasnlend, '') AS DATE)"),
    ("rate_begin_ts", ts("p.kentbegdatetime")), ("rate_end_ts", ts("p.kentenddatetime")), ("posted_ts", ts("p.posteddatetime")),
    ("source_system", "p.source_system"), ("source_api", "p.source_api"), ("pipeline_run_id", "p.pipeline_run_id"),
    ("firm_hash_key", "c.hash_key"), ("rate_hash_key", "p.hash_key"),
]


def curated(paths: str = "paths") -> str:
    """The loaded columns of each path that has a contract."""
    columns = ",\n    ".join(f"{sql} AS {name}" for name, sql in _CURATED)
    return f"SELECT\n    {columns}\n  FROM contracts c, {paths} p WHERE c.firmid = p.firmid"


LOADED_COLS = [name for name, _ in _CURATED]

ALL_RAW_LATEST = with_ctes(RAW_FIRM, RAW_RATES, RAW_LOC, CONTRACTS, PATHS, POINTS)
FLAGSHIP = ALL_RAW_LATEST + curated()
FLAGSHIP_CTES = ALL_RAW_LATEST + ", flagship AS (" + curated() + ")"


def prefixed(alias: str, cols: str, prefix: str = "") -> str:
    return ", ".join(f"{alias}.{c.strip()} AS {prefix}{c.strip()}" for c in cols.split(","))


# ------------------------------------------------------------ the upsert case
UPSERT_CUTOFF = "TIMESTAMP '1996-01-01 00:00:00'"
UPSERT_CTES = with_ctes(
    RAW_FIRM, RAW_RATES, RAW_LOC, CONTRACTS, POINTS,
    newest("paths_before", "gtran_rates", "firmid, uniqueid", RATE_COLS, f"ingestion_timestamp < {UPSERT_CUTOFF}"),
    newest(
        "paths_batch", "gtran_rates", "firmid, uniqueid", RATE_COLS, f"ingestion_timestamp >= {UPSERT_CUTOFF} OR ingestion_timestamp IS NULL"
    ),
) + f""",
target_rows AS ({curated("paths_before")}),
target AS (
  SELECT row_number() OVER (ORDER BY firm_id, rate_unique_id) AS firm_transport_rate_id, *
  FROM target_rows),
incoming AS ({curated("paths_batch")})"""

_I_COLS = ", ".join(f"i.{c}" for c in LOADED_COLS)
_T_COLS = ", ".join(f"t.{c}" for c in LOADED_COLS)

UPSERT_BY_KEY = UPSERT_CTES + f"""
SELECT t.firm_transport_rate_id, {_I_COLS}
FROM target t JOIN incoming i ON t.firm_id = i.firm_id AND t.rate_unique_id = i.rate_unique_id
UNION ALL
SELECT t.firm_transport_rate_id, {_T_COLS}
FROM target t
WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE t.firm_id = i.firm_id AND t.rate_unique_id = i.rate_unique_id)
UNION ALL
SELECT (SELECT coalesce(max(firm_transport_rate_id), 0) FROM target)
         + row_number() OVER (ORDER BY i.firm_id, i.rate_unique_id) AS firm_transport_rate_id, {_I_COLS}
FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.firm_id = i.firm_id AND t.rate_unique_id = i.rate_unique_id)
"""

UPSERT_COUNTS = UPSERT_CTES + """
SELECT
  count(*) FILTER (WHERE t.firm_id IS NULL) AS inserted,
  count(*) FILTER (WHERE t.firm_id IS NOT NULL AND i.firm_id IS NOT NULL) AS updated,
  count(*) FILTER (WHERE i.firm_id IS NULL) AS untouched,
  count(*) AS total_after
FROM target t FULL OUTER JOIN incoming i
  ON t.firm_id = i.firm_id AND t.rate_unique_id = i.rate_unique_id
"""

# ------------------------------------------------------------ table reports
STAR_TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders "
    "pages part region supplier"
).split()


def _snapshot_rows() -> str:
    parts = [f"SELECT 'bronze' AS \"schema\", '{t}' AS name, count(*) AS row_count FROM {t}" for t in STAR_TABLES]
    parts += [f"SELECT 'bronze' AS \"schema\", '{t}' AS name, count(*) AS row_count FROM {t}" for t in RAW]
    return "\nUNION ALL ".join(parts)


SNAPSHOT_CTES = with_ctes(RAW_FIRM, RAW_RATES, RAW_LOC) + f", snapshot AS ({_snapshot_rows()})"

DEF_NAME = "silver_firm_transport_rate"

READINESS = SNAPSHOT_CTES + f""",
required AS (
  SELECT * FROM (VALUES ('{DEF_NAME}', 0, 'gtran_firm'), ('{DEF_NAME}', 1, 'gtran_rates'),
                        ('{DEF_NAME}', 2, 'gtran_loc')) v(definition, source_order, source))
SELECT q.definition,
       CASE WHEN max(CASE WHEN s.row_count IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY q.definition) = 1
            THEN 'BLOCKED' ELSE 'READY' END AS status,
       'bronze.' || q.source AS source,
       s.row_count,
       FALSE AS target_exists
FROM required q LEFT JOIN snapshot s ON s.name = q.source
"""

# ------------------------------------------------------------- the queries
_F = with_ctes(RAW_FIRM)
_R = with_ctes(RAW_RATES)

ORACLE: dict[str, str] = {
    "status_filter": _F + f" SELECT {FIRM_COLS} FROM gtran_firm WHERE ingestion_status = 'LOADED'",
    "latest_single_key": with_ctes(RAW_FIRM, CONTRACTS) + " SELECT * FROM contracts",
    "latest_composite_key": with_ctes(RAW_RATES, PATHS) + " SELECT * FROM paths",
    "latest_lookup": with_ctes(RAW_LOC, POINTS) + " SELECT * FROM points",
    "inner_latest_header": with_ctes(RAW_FIRM, RAW_RATES, CONTRACTS, PATHS)
    + f" SELECT {prefixed('r', RATE_COLS)}, {prefixed('f', FIRM_COLS, 'f_')}"
    " FROM paths r JOIN contracts f ON f.firmid = r.firmid",
    "dual_role_lookup": with_ctes(RAW_RATES, RAW_LOC, PATHS, POINTS)
    + f""" SELECT p.firmid, p.uniqueid, p.recloc, p.delloc, {point_qty("recloc")} AS lr_kqtyloc, {point_qty("delloc")} AS ld_kqtyloc
  FROM paths p""",
    "flagship": FLAGSHIP,
    "conform_columns": FLAGSHIP,
    "blank_to_null": _F
    + """ SELECT firmid, bronze_row_id, NULLIF(tspduns, '') AS tspduns, NULLIF(kqtyk, '') AS kqtyk,
  NULLIF(kenddatetime, '') AS kenddatetime, NULLIF(ngtdrateind, '') AS ngtdrateind FROM gtran_firm""",
    "cast_long": _F + " SELECT firmid, bronze_row_id, CAST(NULLIF(tspduns, '') AS BIGINT) AS tsp_duns FROM gtran_firm",
    "cast_decimal": _R
    + f""" SELECT firmid, uniqueid, bronze_row_id, {dec('ratechgd')} AS rate_charged,
  {dec('maxtrfrate')} AS max_tariff_rate, {dec('totsurchg')} AS total_surcharge FROM gtran_rates""",
    "cast_timestamp": _F
    + f""" SELECT firmid, bronze_row_id, {ts('kbegdatetime')} AS contract_begin_ts,
  {ts('kenddatetime')} AS contract_end_ts FROM gtran_firm""",
    "cast_date": _R
    + """ SELECT firmid, uniqueid, bronze_row_id, CAST(NULLIF(seasnlst, '') AS DATE) AS season_start_date,
  CAST(NULLIF(seasnlend, '') AS DATE) AS season_end_date FROM gtran_rates""",
    "ts_to_date": _F
    + f""" SELECT firmid, bronze_row_id, CAST(ingestion_timestamp AS DATE) AS ingestion_date,
  CAST({ts('kenddatetime')} AS DATE) AS contract_end_date FROM gtran_firm""",
    "term_days": _F
    + f""" SELECT firmid, bronze_row_id,
  CAST(CAST({ts('kenddatetime')} AS DATE) - CAST({ts('kbegdatetime')} AS DATE) AS INTEGER) AS contract_term_days
  FROM gtran_firm""",
    "yes_no_flag": _F + f" SELECT firmid, bronze_row_id, ngtdrateind, {flag('ngtdrateind')} AS is_negotiated_rate FROM gtran_firm",
    "all_in_amount": _R
    + f""" SELECT firmid, uniqueid, bronze_row_id,
  COALESCE({dec('ratechgd')}, 0) + COALESCE({dec('totsurchg')}, 0) AS all_in_rate FROM gtran_rates""",
    "surrogate_id": FLAGSHIP_CTES
    + """ SELECT row_number() OVER (ORDER BY firm_id, rate_unique_id) AS firm_transport_rate_id,
  firm_id, rate_unique_id FROM flagship""",
    "upsert_by_key": UPSERT_BY_KEY,
    "upsert_counts": UPSERT_COUNTS,
    "load_row_count": FLAGSHIP_CTES
    + f" SELECT '{DEF_NAME}' AS name, 'succeeded' AS status, count(*) AS rows FROM flagship",
    "duplicate_keys": _R
    + """ SELECT firmid, uniqueid, count(*) AS n_rows FROM gtran_rates
  WHERE firmid IS NOT NULL AND uniqueid IS NOT NULL GROUP BY firmid, uniqueid HAVING count(*) > 1""",
    "null_key_counts": FLAGSHIP_CTES
    + """ SELECT count(*) FILTER (WHERE firm_id IS NULL) AS null_firm_id,
  count(*) FILTER (WHERE rate_unique_id IS NULL) AS null_rate_unique_id,
  count(*) FILTER (WHERE receipt_loc_code IS NULL) AS null_receipt_loc_code,
  count(*) FILTER (WHERE tsp_duns IS NULL) AS null_tsp_duns,
  count(*) FILTER (WHERE contract_qty_dth IS NULL) AS null_contract_qty_dth,
  count(*) FILTER (WHERE receipt_point_qty_dth IS NULL) AS null_receipt_point_qty_dth
  FROM flagship""",
    "table_snapshot": SNAPSHOT_CTES + ' SELECT "schema", name, row_count FROM snapshot',
    "snapshot_total": SNAPSHOT_CTES + " SELECT CAST(sum(row_count) AS BIGINT) AS total_rows, count(*) AS n_tables FROM snapshot",
    "source_readiness": READINESS,
    "header_orphans": with_ctes(RAW_FIRM, RAW_RATES, CONTRACTS, PATHS)
    + " SELECT r.* FROM paths r WHERE NOT EXISTS (SELECT 1 FROM contracts f WHERE f.firmid = r.firmid)",
    "superseded_versions": with_ctes(RAW_RATES, PATHS)
    + f""" SELECT {RATE_COLS} FROM gtran_rates WHERE ingestion_status = 'LOADED'
  EXCEPT ALL SELECT {RATE_COLS} FROM paths""",
}
