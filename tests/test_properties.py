"""Property tests: random version histories against a plain-Python brute force.

Covers: at most one row per key, the chosen version is the newest loaded
one (NULL timestamps newest, row id breaks ties), adding FAILED versions
changes nothing, and partitioning / input order change nothing.
"""

import datetime as dt
import random

from conftest import T0, raw_firm, raw_loc, raw_rates
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablesmith.operators.versions import latest_by_key
from tablesmith.plans import firm_transport_rate as FTR

version = st.tuples(
    st.sampled_from(["A", "B", "C", None]),  # key
    st.one_of(st.none(), st.integers(0, 5)),  # day offset, NULL allowed
    st.sampled_from(["LOADED", "LOADED", "FAILED", None]),
)


def brute_latest(rows):
    """rows: (key, day, status, row_id, id) -> {key: id} of the newest loaded version."""
    best = {}
    for key, day, status, rid, ident in rows:
        if status != "LOADED":
            continue
        rank = (day is None, day if day is not None else 0, rid)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, ident)
    return {k: v[1] for k, v in best.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(version, min_size=0, max_size=25), st.integers(1, 5))
def test_latest_by_key_matches_brute_force(spark, versions, parts):
    rows = [(k, d, s, i + 1, f"v{i}") for i, (k, d, s) in enumerate(versions)]
    df = raw_firm(
        spark,
        [
            {"firmid": k, "ingestion_timestamp": None if d is None else T0 + dt.timedelta(days=d), "ingestion_status": s, "id": ident}
            for k, d, s, _, ident in rows
        ],
    )
    got = {r.firmid: r.id for r in latest_by_key(df.repartition(parts), ["firmid"]).collect()}
    assert got == brute_latest(rows)
    # extra FAILED versions that are newer than everything change nothing
    failed = raw_firm(spark, [{"firmid": k, "ingestion_timestamp": None, "ingestion_status": "FAILED", "id": "f"} for k in "ABC"])
    again = {r.firmid: r.id for r in latest_by_key(df.unionByName(failed), ["firmid"]).collect()}
    assert again == got


def _random_raw(seed):
    rnd = random.Random(seed)
    firms = [str(i) for i in range(12)]
    firm_rows, rate_rows, loc_rows = [], [], []
    for i in range(40):
        firm_rows.append(
            {
                "firmid": rnd.choice(firms),
                "id": f"K{i}",
                "ingestion_timestamp": rnd.choice([None, T0 + dt.timedelta(days=rnd.randint(0, 3))]),
                "ingestion_status": rnd.choice(["LOADED", "LOADED", "FAILED"]),
                "bronze_row_id": i,
                "ngtdrateind": rnd.choice(["Y", "n", "", "X"]),
            }
        )
    for i in range(120):
        rate_rows.append(
            {
                "firmid": rnd.choice(firms),
                "uniqueid": str(rnd.randint(0, 5)),
                "recloc": rnd.choice(["L1", "L2", None]),
                "delloc": rnd.choice(["L1", "L2", "L3"]),
                "ratechgd": rnd.choice(["", "1.5", "2.25"]),
                "totsurchg": rnd.choice(["", "0.1"]),
                "ingestion_timestamp": T0 + dt.timedelta(hours=rnd.randint(0, 50)),
                "ingestion_status": rnd.choice(["LOADED", "LOADED", "LOADED", "FAILED"]),
                "bronze_row_id": i,
                "hash_key": f"r{i}",
            }
        )
    for i in range(60):
        loc_rows.append(
            {
                "firmid": rnd.choice(firms),
                "loc": rnd.choice(["L1", "L2", "L3"]),
                "kqtyloc": rnd.choice(["", "10", "20.5"]),
                "ingestion_timestamp": T0 + dt.timedelta(hours=rnd.randint(0, 50)),
                "bronze_row_id": i,
            }
        )
    return firm_rows, rate_rows, loc_rows


def _newest(rows, key):
    best = {}
    for r in rows:
        if r.get("ingestion_status", "LOADED") != "LOADED":
            continue
        ts = r["ingestion_timestamp"]
        rank = (ts is None, ts or T0, r["bronze_row_id"])
        k = tuple(r[c] for c in key)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, r)
    return {k: v[1] for k, v in best.items()}


def test_curated_load_matches_brute_force(spark):
    for seed in range(3):
        firm_rows, rate_rows, loc_rows = _random_raw(seed)
        raw = {
            "gtran_firm": raw_firm(spark, firm_rows),
            "gtran_rates": raw_rates(spark, rate_rows),
            "gtran_loc": raw_loc(spark, loc_rows),
        }
        got = {
            (r.firm_id, r.rate_unique_id): (r.contract_id, r.rate_hash_key, r.receipt_point_qty_dth, r.delivery_point_qty_dth)
            for r in FTR.build(raw).collect()
        }
        firms = _newest(firm_rows, ["firmid"])
        rates = _newest(rate_rows, ["firmid", "uniqueid"])
        locs = _newest(loc_rows, ["firmid", "loc"])

        def qty(firm, loc):
            row = locs.get((firm, loc))
            if row is None or row["kqtyloc"] in ("", None):
                return None
            return float(row["kqtyloc"])

        expected = {
            (f, u): (firms[(f,)]["id"], r["hash_key"], qty(f, r["recloc"]), qty(f, r["delloc"]))
            for (f, u), r in rates.items()
            if (f,) in firms
        }
        norm = {k: (a, b, None if c is None else float(c), None if d is None else float(d)) for k, (a, b, c, d) in got.items()}
        assert norm == expected, seed


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.text("abc", min_size=1, max_size=3), st.integers(0, 9), max_size=12),
    st.dictionaries(st.text("abcd", min_size=1, max_size=3), st.integers(10, 19), max_size=12),
)
def test_upsert_matches_brute_force(spark, target_rows, incoming_rows):
    from tablesmith.operators.upsert import upsert_by_key

    target_keys = sorted(target_rows)
    target = spark.createDataFrame(
        [(i + 1, k, target_rows[k]) for i, k in enumerate(target_keys)], "rid long, k string, v long"
    )
    incoming = spark.createDataFrame(list(incoming_rows.items()), "k string, v long")
    got = {r.k: (r.rid, r.v) for r in upsert_by_key(target, incoming, ["k"], "rid").collect()}

    expected = {k: (i + 1, target_rows[k]) for i, k in enumerate(target_keys)}
    next_id = len(target_keys) + 1
    for k in sorted(incoming_rows):
        if k in expected:
            expected[k] = (expected[k][0], incoming_rows[k])
        else:
            expected[k] = (next_id, incoming_rows[k])
            next_id += 1
    assert got == expected
