"""Latest version per key and the header / lookup joins (FIXTURES §3 rows 1-8)."""

import datetime as dt

import pytest
from conftest import T0, raw_firm, raw_loc, raw_rates

from tablesmith.operators.lookup import header_orphans, inner_header, lookup_as
from tablesmith.operators.versions import latest_by_key, superseded_versions
from tablesmith.plans import firm_transport_rate as FTR

T1 = T0 + dt.timedelta(days=1)
T2 = T0 + dt.timedelta(days=2)


def ids(df, col="id"):
    return sorted(r[col] for r in df.collect())


def test_failed_newer_version_does_not_hide_loaded_one(spark):
    firm = raw_firm(
        spark,
        [
            {"id": "good", "ingestion_timestamp": T1, "bronze_row_id": 1},
            {"id": "bad", "ingestion_timestamp": T2, "bronze_row_id": 2, "ingestion_status": "FAILED"},
        ],
    )
    assert ids(latest_by_key(firm, ["firmid"])) == ["good"]


def test_row_id_breaks_timestamp_tie(spark):
    firm = raw_firm(
        spark,
        [{"id": "five", "ingestion_timestamp": T1, "bronze_row_id": 5}, {"id": "nine", "ingestion_timestamp": T1, "bronze_row_id": 9}],
    )
    assert ids(latest_by_key(firm, ["firmid"])) == ["nine"]


def test_null_timestamp_ranks_newest(spark):
    firm = raw_firm(
        spark,
        [{"id": "dated", "ingestion_timestamp": T2, "bronze_row_id": 5}, {"id": "undated", "ingestion_timestamp": None, "bronze_row_id": 1}],
    )
    assert ids(latest_by_key(firm, ["firmid"])) == ["undated"]


def test_only_failed_versions_means_absent(spark):
    firm = raw_firm(spark, [{"firmid": "A", "ingestion_status": "FAILED"}, {"firmid": "B"}, {"firmid": "C", "ingestion_status": None}])
    assert ids(latest_by_key(firm, ["firmid"]), "firmid") == ["B"]


def test_null_key_is_one_group_and_never_joins(spark):
    firm = raw_firm(spark, [{"firmid": None, "id": "a", "bronze_row_id": 1}, {"firmid": None, "id": "b", "bronze_row_id": 2}])
    latest = latest_by_key(firm, ["firmid"])
    assert ids(latest) == ["b"]
    rate = raw_rates(spark, [{"firmid": None}])
    assert inner_header(rate, latest, ["firmid"], "f_").count() == 0


def test_superseded_is_the_complement(spark):
    firm = raw_firm(
        spark,
        [
            {"firmid": "A", "id": "a1", "ingestion_timestamp": T0},
            {"firmid": "A", "id": "a2", "ingestion_timestamp": T1},
            {"firmid": "A", "id": "a3", "ingestion_timestamp": T2},
            {"firmid": "B", "id": "b1"},
            {"firmid": "A", "id": "ax", "ingestion_timestamp": T2, "ingestion_status": "FAILED"},
        ],
    )
    latest = ids(latest_by_key(firm, ["firmid"]))
    old = superseded_versions(firm, ["firmid"])
    assert latest == ["a3", "b1"]
    assert sorted(r.id for r in old.collect()) == ["a1", "a2"]


def test_superseded_handles_null_timestamps_and_keys(spark):
    firm = raw_firm(
        spark,
        [
            {"firmid": None, "id": "n1", "ingestion_timestamp": None, "bronze_row_id": 1},
            {"firmid": None, "id": "n2", "ingestion_timestamp": None, "bronze_row_id": 2},
            {"firmid": "A", "id": "a-null", "ingestion_timestamp": None, "bronze_row_id": 3},
            {"firmid": "A", "id": "a-old", "ingestion_timestamp": T2, "bronze_row_id": 4},
        ],
    )
    assert ids(superseded_versions(firm, ["firmid"])) == ["a-old", "n1"]


def test_latest_plan_limits_before_shuffle(spark):
    firm = raw_firm(spark, [{"firmid": str(i % 3)} for i in range(20)])
    plan = latest_by_key(firm, ["firmid"])._jdf.queryExecution().executedPlan().toString()
    # a partial top-1 runs before the exchange, the final one after it
    assert "WindowGroupLimit" in plan
    assert plan.index("Partial") > plan.index("Exchange")  # deeper in the tree = printed later


def test_rate_without_loaded_header_is_dropped(spark):
    firm = raw_firm(spark, [{"firmid": "F1"}, {"firmid": "F2", "ingestion_status": "FAILED"}])
    rate = raw_rates(spark, [{"firmid": "F1", "uniqueid": "a"}, {"firmid": "F2", "uniqueid": "b"}])
    f = latest_by_key(firm, ["firmid"])
    joined = inner_header(rate, f, ["firmid"], "f_")
    assert ids(joined, "uniqueid") == ["a"]
    assert ids(header_orphans(rate, f, ["firmid"]), "uniqueid") == ["b"]


def test_dual_role_lookup(spark):
    rate = raw_rates(
        spark,
        [
            {"uniqueid": "null-rec", "recloc": None, "delloc": "L2"},
            {"uniqueid": "unknown", "recloc": "nope", "delloc": "L2"},
            {"uniqueid": "same", "recloc": "L1", "delloc": "L1"},
        ],
    )
    loc = latest_by_key(raw_loc(spark, [{"loc": "L1", "kqtyloc": "10"}, {"loc": "L2", "kqtyloc": "20"}]), ["firmid", "loc"])
    out = FTR.with_point_quantities(rate, loc)
    got = {r.uniqueid: (r.lr_kqtyloc, r.ld_kqtyloc) for r in out.collect()}
    assert got == {"null-rec": (None, "20"), "unknown": (None, "20"), "same": ("10", "10")}


def test_lookup_reuses_the_lookup_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rate = raw_rates(spark, [{"uniqueid": str(i), "recloc": "L1", "delloc": "L2"} for i in range(10)])
        loc = latest_by_key(raw_loc(spark, [{"loc": "L1"}, {"loc": "L2"}]), ["firmid", "loc"])
        df = lookup_as(rate, loc, {"firmid": "firmid", "recloc": "loc"}, {"kqtyloc": "a"}, role="r")
        df = lookup_as(df, loc, {"firmid": "firmid", "delloc": "loc"}, {"kqtyloc": "b"}, role="d")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_latest_and_superseded_partition_the_loaded_rows_with_ties(spark):
    """Exact ties, copies, NULL timestamps and keys: nothing is lost, nothing doubled."""
    from collections import Counter

    from tablesmith.operators.versions import latest_by_key, superseded_versions

    rows = [
        ("a", 1, 5, "LOADED", "x"), ("a", 1, 5, "LOADED", "y"), ("a", 1, 5, "LOADED", "y"), ("a", None, 2, "LOADED", "n"), ("a", None, 2, "LOADED", "m"),
        ("b", 3, None, "LOADED", "p"), ("b", 3, None, "LOADED", "p"), (None, 1, 1, "LOADED", "q"), (None, 2, 1, "LOADED", "r"), ("c", 9, 9, "FAILED", "z"),
    ]
    schema = "k string, ingestion_timestamp int, bronze_row_id long, ingestion_status string, v string"
    winners = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, schema).repartition(parts)
        latest = [tuple(r) for r in latest_by_key(df, ["k"]).collect()]
        rest = [tuple(r) for r in superseded_versions(df, ["k"]).collect()]
        assert Counter(latest + rest) == Counter(r for r in rows if r[3] == "LOADED")
        assert sorted(str(r[0]) for r in latest) == ["None", "a", "b"]
        winners.add(tuple(sorted(map(str, latest))))
    assert len(winners) == 1  # the same choice for any partitioning


@pytest.mark.parametrize("kind", ["string", "int", "bigint", "double", "date", "timestamp", "timestamp_ntz", "decimal(12,2)"])
def test_header_side_has_its_own_exchange_for_every_key_type(spark, kind):
    from tablesmith.operators.lookup import inner_header

    text = "2024-01-01" if "date" in kind or "timestamp" in kind else "7"
    rows = spark.createDataFrame([(text, 1), (text, 2), (None, 3)], "k string, v int").selectExpr(f"CAST(k AS {kind}) AS k", "v")
    header = rows.groupBy("k").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = inner_header(rows, header, ["k"])
        assert sorted(r.v for r in out.collect()) == [1, 2]
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert plan.count("Exchange hashpartitioning") == 3  # detail, aggregation, header
        assert dict(out.dtypes)["h_k"] == kind
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_other_key_types_are_refused(spark):
    from tablesmith.operators.lookup import inner_header

    rows = spark.createDataFrame([(True, 1)], "k boolean, v int")
    with pytest.raises(TypeError, match="skew_safe=False"):
        inner_header(rows, rows.select("k"), ["k"])
    assert inner_header(rows, rows.select("k"), ["k"], skew_safe=False).count() == 1


def _no_broadcast(spark, on):
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1") if on else spark.conf.unset(key)


ODD_RATES = [
    {"uniqueid": "a", "ratechgd": "1"}, {"uniqueid": "a", "ratechgd": "2", "ingestion_timestamp": T1}, {"uniqueid": "a", "ratechgd": "2", "ingestion_timestamp": T1, "bronze_row_id": 2},
    {"uniqueid": "b", "bronze_row_id": 7, "recloc": "L2"}, {"uniqueid": "b", "bronze_row_id": 7, "recloc": "L2"}, {"uniqueid": "b", "bronze_row_id": 7, "recloc": None},
    {"uniqueid": None, "recloc": "L1"}, {"firmid": None, "uniqueid": "a"}, {"firmid": None, "uniqueid": "a", "ingestion_timestamp": None, "bronze_row_id": None},
    {"firmid": "F2", "uniqueid": "c", "delloc": "L1"}, {"firmid": "F3", "uniqueid": "d"}, {"firmid": "F3", "uniqueid": "d", "ingestion_status": "FAILED", "ingestion_timestamp": T2},
]


def test_narrow_first_finds_the_same_rows(spark):
    rates = raw_rates(spark, ODD_RATES)
    key = ["firmid", "uniqueid"]
    for ties in ((), FTR.POINT_COLUMNS):
        plain, narrow = (latest_by_key(rates, key, tie_columns=ties, narrow_first=n) for n in (False, True))
        assert narrow.columns == plain.columns
        assert sorted(map(str, narrow.collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(ValueError):
        latest_by_key(rates, key, order=[rates.uniqueid.desc()], narrow_first=True)


def test_wide_versions_are_shuffled_once(spark):
    """The narrow dedup and the two sides of the join; copies are numbered where they are."""
    rates = raw_rates(spark, ODD_RATES)
    _no_broadcast(spark, True)
    try:
        for df in (superseded_versions(rates, ["firmid", "uniqueid"]), latest_by_key(rates, ["firmid", "uniqueid"], narrow_first=True)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 3
            below = plan[plan.index("Partial") :]
            assert "ratechgd" not in below[below.index("Project") :].splitlines()[0].split("xxhash64")[0]  # the partial top-1 sorts narrow rows
    finally:
        _no_broadcast(spark, False)


def _odd_sources(spark):
    firm = raw_firm(spark, [{"firmid": "F1"}, {"firmid": "F1", "id": "K2", "ingestion_timestamp": T1}, {"firmid": "F2"}, {"firmid": None}])
    loc = raw_loc(spark, [{"loc": "L1"}, {"loc": "L1", "kqtyloc": "11"}, {"loc": "L2", "kqtyloc": ""}, {"loc": None}, {"firmid": "F2", "loc": "L1", "kqtyloc": "7"}, {"firmid": None}])
    return {"gtran_firm": firm, "gtran_rates": raw_rates(spark, ODD_RATES), "gtran_loc": loc}


@pytest.mark.parametrize("large,pushed", [(1000, 1000), (4, 1000), (0, 1000), (0, 1)])
def test_firms_kept_together_and_large_firms_give_the_same_rows(spark, monkeypatch, large, pushed):
    sources = _odd_sources(spark)
    monkeypatch.setattr(FTR, "LARGE_FIRM", large)
    monkeypatch.setattr(FTR, "FIRMS_PUSHED", pushed)
    named = FTR.large_firms(sources)
    assert (named if named is None else sorted(named)) == {(1000, 1000): [], (4, 1000): ["F1"], (0, 1000): ["F1", "F2", "F3"], (0, 1): None}[large, pushed]
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(FTR.build(sources)) == rows(FTR.project(FTR._joined_by_key(sources)))
    firm, rate, _ = FTR.latest_inputs(sources)
    assert rows(FTR.latest_with_header(sources)) == rows(FTR.rates_with_header(rate, firm))
    got = {r.rate_unique_id: (r.receipt_point_qty_dth, r.delivery_point_qty_dth) for r in FTR.build(sources).where("firm_id = 'F2'").collect()}
    assert {k: tuple(map(float, v)) for k, v in got.items()} == {"c": (7.0, 7.0)}


def test_rows_of_a_firm_meet_in_one_shuffle_of_each_table(spark):
    sources = _odd_sources(spark)
    _no_broadcast(spark, True)
    try:
        for df, n in ((FTR.build(sources), 3), (FTR.latest_with_header(sources), 2)):
            assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == n
    finally:
        _no_broadcast(spark, False)


def test_orphans_are_told_apart_before_the_dedup(spark):
    sources = _odd_sources(spark)
    firm, rate, _ = FTR.latest_inputs(sources)
    orphans = FTR.latest_orphans(sources)
    assert sorted(map(str, orphans.collect())) == sorted(map(str, header_orphans(rate, firm, ["firmid"]).collect()))
    assert sorted(str(r.uniqueid) for r in orphans.collect()) == ["a", "d"]
    plan = orphans._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window ") < plan.index("LeftAnti")  # the dedup is above the join
