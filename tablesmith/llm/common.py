"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Scratch:
    """Intermediate tables in the shared folder of ``spark.checkpoint.dir``.

    Written Parquet cuts the lineage: a lost executor re-reads the table
    instead of recomputing everything before it. Outside local mode the folder
    must be configured, because only a shared one is seen by all executors.
    """

    def __init__(self, spark: SparkSession):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
        self.spark = spark
        self.root = f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame, wide: bool = False) -> DataFrame:
        """``df`` written and read again; ``wide``: its rows hold megabytes each."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.options(**WIDE_ROWS if wide else {}).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def drop(self, kept: DataFrame) -> None:
        """Remove a table of ``keep`` that nothing reads any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(kept.scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of an Arrow batch of rows that hold megabytes each.
BATCH_BYTES = 4 << 20
#: How a task writes such rows: it otherwise looks at its buffers every 100 rows only.
WIDE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1", "parquet.page.size.row.check.min": "1"}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs within hand rows to Python about ``BATCH_BYTES`` at a time. Rows of
    some MB otherwise fill batches of 64 MB, which a task's JVM and its Python
    worker hold several times, outside the heap."""
    with _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        yield


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs within read rows that hold megabytes each, one at a time. The Parquet
    reader otherwise fills batches of 4,096 rows, as many as a file has of such."""
    with small_batches(spark), _setting(spark, "spark.sql.parquet.columnarReaderBatchSize", "1"):
        yield


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def hash_sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The ``n`` rows with the smallest hash of the first column (ties: of the
    other ones). Rows above a threshold, set from the number of rows, are
    filtered out where they are read, so that the tasks together send a few
    times ``n`` rows at any size of the table, not ``n`` rows each."""
    total, wanted = df.count(), 4 * n + 64
    chosen = df
    first = F.xxhash64(columns[0])
    while wanted < total:
        chosen = df.where(first <= F.lit(-(1 << 63) + (wanted << 64) // total))
        if chosen.select(columns[0]).limit(n).count() == n:
            break
        wanted *= 8  # many rows share a value of the first column
        chosen = df
    return chosen.orderBy(*(F.xxhash64(c) for c in columns)).limit(n)


def own_exchange(col: str):
    """The same integer key as an expression of its own. A join on it gets an
    exchange for this side even where an aggregation has already partitioned
    it, and adaptive execution can then split a hot key of the other side."""
    return F.expr(f"`{col}` ^ 0L")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(own_exchange("u").alias("u"), F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("hi").agg(F.min("lo").alias("m"))
    near = e.join(least.select(own_exchange("hi").alias("hi"), "m"), "hi").where("lo <> m")
    return (
        near.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        .unionByName(least.select("hi", F.col("m").alias("lo")))
        .distinct()
    )


def components(edges: DataFrame, a: str, b: str, scratch: Scratch) -> DataFrame:
    """Connected components of an undirected graph of long ids.

    Alternates the large-star and small-star steps until all edges lead to the
    root of a star (Kiveris et al., Connected Components in MapReduce and
    Beyond, 2014); each round is two joins and aggregations, and only one
    number reaches the driver.

    Returns ``(id, component_id)`` for each id that is not the smallest of its
    component; ids without edges and the smallest ones are their own component.
    """
    e = scratch.keep(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    while not _is_stars(e):
        e2 = scratch.keep(_small_star(_large_star(e)))
        scratch.drop(e)
        e = e2
    return e.select(F.col("hi").alias("id"), F.col("lo").alias("component_id"))


def _is_stars(e: DataFrame) -> bool:
    """No id leads to two others, or to one that leads on."""
    ends = e.select(F.col("hi").alias("id"), F.lit(1).alias("leads")).unionByName(
        e.select(F.col("lo").alias("id"), F.lit(0).alias("leads")).distinct()
    )
    wrong = ends.groupBy("id").agg(F.sum("leads").alias("n"), F.count(F.lit(1)).alias("rows")).where("n > 0 and rows > 1")
    return wrong.isEmpty()


def join_forest(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of linked places, in memory; ``parent`` points to
    the smallest place of each."""
    while len(i):
        x, y = parent[i], parent[j]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent != parent[parent]).any():
            parent[:] = parent[parent]
        left = parent[i] != parent[j]
        i, j = i[left], j[left]
