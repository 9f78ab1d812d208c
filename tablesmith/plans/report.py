"""Read-only reports over a store: table snapshot and source readiness.

Both are DataFrames. Row counts for all tables of a schema run as one
Spark job (a union of per-table counts); for Parquet tables a count decodes no
column: the read schema of the scan is empty, its rows come from the footers.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.plans.gate import BLOCKED, READY, SKIP, gate  # noqa: F401 — the statuses are part of this module's interface
from tablesmith.plans.tabledef import TableDef
from tablesmith.sources.store import Store

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("schema", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
    ]
)


def table_snapshot(store: Store, schema: str) -> DataFrame:
    """``(schema, name, row_count)`` for every table and view of ``schema``,
    sorted by name; no rows when the schema does not exist."""
    spark = store.spark
    names = store.tables(schema) if store.schema_exists(schema) else []
    if not names:
        return spark.createDataFrame([], SNAPSHOT_SCHEMA)
    return reduce(DataFrame.unionByName, [_counted(store, schema, n) for n in names]).orderBy("name")


def _counted(store: Store, schema: str, name: str) -> DataFrame:
    count = store.read(schema, name).agg(F.count(F.lit(1)).alias("row_count"))
    return count.select(F.lit(schema).alias("schema"), F.lit(name).alias("name"), "row_count")


def snapshot_total(snapshot: DataFrame) -> DataFrame:
    """One row: total rows and number of tables of a snapshot."""
    return snapshot.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("total_rows"),
        F.count(F.lit(1)).alias("n_tables"),
    )


def missing_sources(store: Store, defs: Mapping[str, TableDef]) -> DataFrame:
    """``(definition, source)`` for each required raw source that is absent,
    schema-qualified, in declared order."""
    rows = [(name, source) for name, d in sorted(defs.items()) for source in gate(store, d).absent]
    return store.spark.createDataFrame(rows, "definition string, source string")


def source_readiness(store: Store, defs: Mapping[str, TableDef]) -> DataFrame:
    """Per definition and source: status, the source's row count (NULL when
    missing) and whether the target exists. A definition without sources has
    one row without a source.

    The status is the one the build decides by (:mod:`tablesmith.plans.gate`).
    Each required source is counted once; other tables are not read.
    """
    rows, needed = [], {}
    for name, d in sorted(defs.items()):
        g = gate(store, d)
        for i, source in enumerate(d.sources or [None]):
            rows.append((name, g.status, source, g.target_exists, i))
            if source is not None and f"{store.raw_schema}.{source}" not in g.absent:
                needed.setdefault(source.lower(), source)
    required = store.spark.createDataFrame(
        rows, "definition string, status string, source string, target_exists boolean, source_order int"
    )
    counts = store.spark.createDataFrame([], SNAPSHOT_SCHEMA)
    if needed:
        counts = reduce(DataFrame.unionByName, [_counted(store, store.raw_schema, s) for s in needed.values()])
    joined = required.join(counts, F.lower("source") == F.lower("name"), "left").orderBy("definition", "source_order")
    qualified = F.concat(F.lit(store.raw_schema + "."), F.col("source")).alias("source")
    return joined.select("definition", "status", qualified, "row_count", "target_exists")


def inspect(store: Store, defs: Mapping[str, TableDef]) -> dict:
    """Read-only state of a store, as DataFrames.

    ``raw_schema_exists`` (bool), ``raw`` and ``curated`` snapshots (an
    absent schema gives an empty snapshot) and per-definition ``readiness``.
    Nothing is written.
    """
    return {
        "raw_schema_exists": store.schema_exists(store.raw_schema),
        "raw": table_snapshot(store, store.raw_schema),
        "curated": table_snapshot(store, store.curated_schema),
        "readiness": source_readiness(store, defs),
    }
