"""Raw-shaped (versioned, text-typed) tables derived from the star tables.

The raw tables the curated load reads are not part of the test data, so
they are derived from ``orders`` and ``lineitem`` with plain column
expressions (no shuffles: each raw table is a projection of one star
table; the header table is additionally exploded into versions). The
same expressions are written for the DuckDB oracle, so both sides see
identical raw rows.

* ``gtran_firm`` — one header per order, up to three ingested versions
  (version 3 and some other rows FAILED; some timestamps NULL).
* ``gtran_rates`` — one rate version per line item; key
  ``(firmid, uniqueid)`` = ``(l_orderkey, l_linenumber)`` is not unique in
  the data, which gives several versions per key.
* ``gtran_loc`` — one location quantity per line item, key
  ``(firmid, loc)`` = ``(l_orderkey, l_suppkey)``.

Each table is one ``selectExpr`` (parsed on the JVM side) over a Parquet
scan with a declared schema, so no schema-inference job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Schemas of the star tables read here (declared, not inferred).
STAR_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}

# The version-timestamp base of the header table.
FIRM_TS_BASE = "2024-01-01 00:00:00"

FIRM_EXPRS = [
    "CAST(o_orderkey AS STRING) AS firmid",
    "concat('K', CAST(o_orderkey AS STRING), '-', CAST(ver AS STRING)) AS id",
    "o_orderpriority AS tspname",
    "CASE WHEN o_custkey % 10 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS tspduns",
    "concat('holder ', CAST(o_custkey AS STRING)) AS kholdername",
    "o_orderstatus AS ratesch",
    "concat('S', CAST(o_orderkey AS STRING)) AS svcreqk",
    "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(CAST(o_totalprice + ver AS DECIMAL(18,2)) AS STRING) END AS kqtyk",
    "concat(CAST(CAST(o_orderdate AS DATE) AS STRING), CASE WHEN o_orderkey % 3 = 1 THEN ' 07:30:05' ELSE '' END) AS kbegdatetime",
    "CASE WHEN o_orderkey % 13 = 0 THEN '' "
    "ELSE concat(CAST(date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 400 AS INT)) AS STRING), "
    "CASE WHEN o_orderkey % 5 = 2 THEN ' 23:45:10' ELSE '' END) END AS kenddatetime",
    "o_orderstatus AS kstat",
    "concat('status ', o_orderstatus) AS kstatdesc",
    "CASE o_orderkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'n' WHEN 2 THEN '' ELSE 'X' END AS ngtdrateind",
    "concat('hf', CAST(o_orderkey AS STRING), '-', CAST(ver AS STRING)) AS hash_key",
    "CASE WHEN ver = 3 THEN 'FAILED' WHEN o_orderkey % 50 = 49 THEN 'FAILED' ELSE 'LOADED' END AS ingestion_status",
    "CASE WHEN o_orderkey % 11 = 0 AND ver = 1 THEN CAST(NULL AS TIMESTAMP) "
    f"WHEN o_orderkey % 3 = 0 THEN TIMESTAMP'{FIRM_TS_BASE}' "
    f"ELSE TIMESTAMP'{FIRM_TS_BASE}' + make_dt_interval(ver) END AS ingestion_timestamp",
    "o_orderkey * 10 + ver AS bronze_row_id",
]

RATE_EXPRS = [
    "CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_orderkey AS STRING) END AS firmid",
    "CAST(l_linenumber AS STRING) AS uniqueid",
    "CASE WHEN l_partkey % 17 = 0 THEN CAST(NULL AS STRING) ELSE CAST(l_suppkey AS STRING) END AS recloc",
    "concat('rec ', CAST(l_suppkey AS STRING)) AS reclocname",
    "l_returnflag AS recloczn",
    "CAST(l_suppkey + l_linenumber % 2 AS STRING) AS delloc",
    "concat('del ', CAST(l_suppkey AS STRING)) AS dellocname",
    "l_linestatus AS delloczn",
    "l_returnflag AS rateformtype",
    "concat('form ', l_returnflag) AS rateformtypedesc",
    "CAST(l_partkey AS STRING) AS rateid",
    "CASE WHEN l_partkey % 9 = 0 THEN '' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS ratechgd",
    "CAST(CAST(l_extendedprice * 2 AS DECIMAL(18,2)) AS STRING) AS maxtrfrate",
    "CASE WHEN l_partkey % 5 = 0 THEN '' ELSE CAST(CAST(l_tax AS DECIMAL(18,2)) AS STRING) END AS totsurchg",
    "l_returnflag AS mktbasedrateind",
    "CASE WHEN l_tax > 0 THEN 'y' ELSE 'N' END AS surchgind",
    "CAST(CAST(l_shipdate AS DATE) AS STRING) AS seasnlst",
    "CASE WHEN l_suppkey % 6 = 0 THEN '' ELSE CAST(date_add(CAST(l_shipdate AS DATE), 30) AS STRING) END AS seasnlend",
    "CAST(CAST(l_shipdate AS DATE) AS STRING) AS kentbegdatetime",
    "CASE WHEN l_suppkey % 4 = 0 THEN '' "
    "ELSE concat(CAST(date_add(CAST(l_shipdate AS DATE), 90) AS STRING), ' 12:00:00') END AS kentenddatetime",
    "CAST(CAST(l_shipdate AS DATE) AS STRING) AS posteddatetime",
    "'star' AS source_system",
    "'lineitem' AS source_api",
    "concat('run-', CAST(l_suppkey % 3 AS STRING)) AS pipeline_run_id",
    "concat('hr', CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS hash_key",
    "CASE WHEN l_partkey % 20 = 0 THEN 'FAILED' ELSE 'LOADED' END AS ingestion_status",
    "CASE WHEN l_suppkey % 23 <> 0 THEN l_shipdate END AS ingestion_timestamp",
    "l_suppkey * 1000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS bronze_row_id",
]

LOC_EXPRS = [
    "CAST(l_orderkey AS STRING) AS firmid",
    "CASE WHEN l_suppkey % 29 <> 0 THEN CAST(l_suppkey AS STRING) END AS loc",
    "CASE WHEN l_linenumber = 3 THEN '' ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING) END AS kqtyloc",
    "CASE WHEN l_partkey % 25 = 0 THEN 'FAILED' ELSE 'LOADED' END AS ingestion_status",
    "l_shipdate AS ingestion_timestamp",
    "l_partkey * 1000 + l_linenumber AS bronze_row_id",
]


def read_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in STAR_SCHEMAS:
        reader = reader.schema(STAR_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def firm_versions(orders: DataFrame) -> DataFrame:
    """``gtran_firm``: versions 1..3 of each order header (2, 3 only for even keys)."""
    versions = orders.selectExpr("*", "explode(array(1, 2, 3)) AS ver").where("ver = 1 OR o_orderkey % 2 = 0")
    return versions.selectExpr(*FIRM_EXPRS)


def rate_versions(lineitem: DataFrame) -> DataFrame:
    """``gtran_rates``: one rate/path version per line item."""
    return lineitem.selectExpr(*RATE_EXPRS)


def loc_versions(lineitem: DataFrame) -> DataFrame:
    """``gtran_loc``: one point-quantity version per line item."""
    return lineitem.selectExpr(*LOC_EXPRS)


RAW_TABLES = ("gtran_firm", "gtran_rates", "gtran_loc")


def raw_from_star(orders: DataFrame, lineitem: DataFrame) -> dict[str, DataFrame]:
    """All three raw-shaped tables from the two star tables."""
    return {
        "gtran_firm": firm_versions(orders),
        "gtran_rates": rate_versions(lineitem),
        "gtran_loc": loc_versions(lineitem),
    }


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All three raw-shaped tables, keyed by raw table name."""
    return raw_from_star(read_star(spark, sf_dir, "orders"), read_star(spark, sf_dir, "lineitem"))
