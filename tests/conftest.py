import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from tablesmith.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-tests-", dir="/tmp")
    session = build_session(
        "local[4]",
        app_name="tablesmith-tests",
        shuffle_partitions=4,
        extra_conf={
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    # keep the configured checkpoint folder; only an unset one gets a scratch folder
    ensure_checkpoint_dir(session, fallback=f"{scratch}/checkpoints")
    yield session
    session.stop()


@pytest.fixture
def scratch_dir():
    return tempfile.mkdtemp(prefix="run-store-", dir="/tmp")


# ----------------------------------------------------------------- raw rows
FIRM_COLS = [
    "firmid", "id", "tspname", "tspduns", "kholdername", "ratesch", "svcreqk", "kqtyk", "kbegdatetime",
    "kenddatetime", "kstat", "kstatdesc", "ngtdrateind", "hash_key",
]
RATE_COLS = [
    "firmid", "uniqueid", "recloc", "reclocname", "recloczn", "delloc", "dellocname", "delloczn",
    "rateformtype", "rateformtypedesc", "rateid", "ratechgd", "maxtrfrate", "totsurchg", "mktbasedrateind",
    "surchgind", "seasnlst", "seasnlend", "kentbegdatetime", "kentenddatetime", "posteddatetime",
    "source_system", "source_api", "pipeline_run_id", "hash_key",
]
LOC_COLS = ["firmid", "loc", "kqtyloc"]
CONTROL = [
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("bronze_row_id", T.LongType()),
    T.StructField("ingestion_status", T.StringType()),
]

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _schema(cols):
    return T.StructType([T.StructField(c, T.StringType()) for c in cols] + CONTROL)


def _rows(cols, rows, defaults):
    out = []
    for i, r in enumerate(rows):
        full = {**defaults, "ingestion_timestamp": T0, "bronze_row_id": i + 1, "ingestion_status": "LOADED", **r}
        out.append(tuple(full.get(c) for c in cols + ["ingestion_timestamp", "bronze_row_id", "ingestion_status"]))
    return out


FIRM_DEFAULTS = {
    "id": "K1", "tspname": "tsp", "tspduns": "12", "kholdername": "holder", "ratesch": "FT",
    "svcreqk": "S1", "kqtyk": "100.5", "kbegdatetime": "2024-03-01", "kenddatetime": "2024-03-10",
    "kstat": "A", "kstatdesc": "active", "ngtdrateind": "Y", "hash_key": "hf",
}
RATE_DEFAULTS = {
    "uniqueid": "u1", "recloc": "L1", "reclocname": "rec", "recloczn": "Z1", "delloc": "L2", "dellocname": "del",
    "delloczn": "Z2", "rateformtype": "R", "rateformtypedesc": "form", "rateid": "r1", "ratechgd": "1.25",
    "maxtrfrate": "2.5", "totsurchg": "0.10", "mktbasedrateind": "N", "surchgind": "y", "seasnlst": "2024-01-01",
    "seasnlend": "2024-12-31", "kentbegdatetime": "2024-01-01 00:00:00", "kentenddatetime": "",
    "posteddatetime": "2024-01-02T10:00:00", "source_system": "sys", "source_api": "api",
    "pipeline_run_id": "run-1", "hash_key": "hr",
}
LOC_DEFAULTS = {"kqtyloc": "10"}


def raw_firm(spark, rows):
    return spark.createDataFrame(_rows(FIRM_COLS, rows, {"firmid": "F1", **FIRM_DEFAULTS}), _schema(FIRM_COLS))


def raw_rates(spark, rows):
    return spark.createDataFrame(_rows(RATE_COLS, rows, {"firmid": "F1", **RATE_DEFAULTS}), _schema(RATE_COLS))


def raw_loc(spark, rows):
    return spark.createDataFrame(_rows(LOC_COLS, rows, {"firmid": "F1", "loc": "L1", **LOC_DEFAULTS}), _schema(LOC_COLS))
