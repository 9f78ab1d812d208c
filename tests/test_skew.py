"""A firm holding a third of all rate rows (all at one receipt point): AQE
splits it in the header join and in the receipt lookup."""

from pyspark.sql import functions as F

from tablesmith.plans import firm_transport_rate as FTR
from tablesmith.sources.adapter import raw_tables

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_firm_is_split_and_results_are_whole(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        raw = raw_tables(spark, "/root/testdata/sf0.001")
        rates = raw["gtran_rates"]
        hot = F.col("firmid").cast("long") % 3 == 0
        cols = []
        for c in rates.columns:
            if c == "firmid":
                cols.append(F.when(hot, F.lit("HOT")).otherwise(F.col("firmid")).alias("firmid"))
            elif c == "recloc":  # every hot rate is received at the same point
                cols.append(F.when(hot, F.lit("HOTLOC")).otherwise(F.col("recloc")).alias("recloc"))
            elif c == "uniqueid":
                cols.append(F.when(hot, F.concat_ws("-", "firmid", "uniqueid")).otherwise(F.col("uniqueid")).alias("uniqueid"))
            else:
                cols.append(F.col(c))
        firm = raw["gtran_firm"]
        hot_firm = firm.where("firmid = '1'").withColumn("firmid", F.lit("HOT"))
        loc = raw["gtran_loc"]
        hot_loc = loc.limit(1).withColumn("firmid", F.lit("HOT")).withColumn("loc", F.lit("HOTLOC"))
        sources = dict(raw, gtran_rates=rates.select(*cols), gtran_firm=firm.unionByName(hot_firm), gtran_loc=loc.unionByName(hot_loc))
        out = FTR.build(sources)
        rows = out.groupBy((F.col("firm_id") == "HOT").alias("hot")).count().collect()
        counts = {r.hot: r["count"] for r in rows}
        assert counts[True] > (counts[True] + counts[False]) / 4  # the hot firm really is hot
        out.collect()  # runs the query whose final adaptive plan is inspected
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # the header join and the receipt lookup (hot firm + hot location) are split
        assert plan.count("SortMergeJoin(skew=true)") >= 2
        hot_qty = out.where("firm_id = 'HOT'").select("receipt_point_qty_dth").distinct().count()
        assert hot_qty == 1  # every hot rate found the hot location's quantity
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
