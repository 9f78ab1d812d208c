"""Plan shape of the curated load over stored raw tables."""

from conftest import raw_firm, raw_loc, raw_rates
from pyspark.sql import functions as F

from tablesmith.plans import firm_transport_rate as FTR


def _stored_raw(spark, root):
    tables = {
        "gtran_firm": raw_firm(spark, [{"firmid": str(i)} for i in range(30)]),
        "gtran_rates": raw_rates(spark, [{"firmid": str(i % 30), "uniqueid": str(i)} for i in range(90)]),
        "gtran_loc": raw_loc(spark, [{"firmid": str(i), "loc": "L1"} for i in range(30)]),
    }
    for name, df in tables.items():
        df.withColumn("unused_payload", F.lit("x" * 50)).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in tables}


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_shape(spark, scratch_dir):
    raw = _stored_raw(spark, scratch_dir)
    out = FTR.build(raw)
    plan = _plan(out)
    # unused raw columns never leave the scan
    assert "unused_payload" not in plan
    # the status filter reaches the Parquet reader
    assert "PushedFilters: [IsNotNull(ingestion_status), EqualTo(ingestion_status,LOADED)" in plan
    # top-1 per key is limited before each dedup shuffle
    assert plan.count("WindowGroupLimit") >= 6
    # no Python evaluation, no single-partition exchange, no cross product
    for bad in ("BatchEvalPython", "ArrowEvalPython", "SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    # whole-stage code generation is in use
    assert "*(" in out._jdf.queryExecution().executedPlan().treeString()


def test_projection_is_one_codegen_stage(spark, scratch_dir):
    raw = _stored_raw(spark, scratch_dir)
    out = FTR.build(raw)
    out.collect()
    tree = out._jdf.queryExecution().executedPlan().treeString()
    final = tree.split("Initial Plan")[0]  # the adaptive plan as executed
    projects = [line for line in final.splitlines() if "Project [" in line and "AS firm_id" in line]
    assert len(projects) == 1 and "*(" in projects[0]


def test_upsert_plan_shape(spark):
    from tablesmith.operators.upsert import upsert_by_key

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(0, 200).selectExpr("id + 1 AS rid", "CAST(id AS STRING) AS k", "id AS v")
        incoming = spark.range(100, 300).selectExpr("CAST(id AS STRING) AS k", "id * 10 AS v")
        out = upsert_by_key(target, incoming, ["k"], "rid")
        assert out.count() == 300
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FullOuter") == 1
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
