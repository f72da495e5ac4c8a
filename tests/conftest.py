import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"

RAW_SCHEMA = (
    "hash string, block_number bigint, block_timestamp timestamp, block_timestamp_month date, "
    "size bigint, virtual_size bigint, version bigint, input_count bigint, output_count bigint, "
    "fee bigint, is_coinbase boolean, input_value bigint, output_value bigint, "
    "inputs array<struct<index:int,addresses:array<string>>>, "
    "outputs array<struct<index:int,addresses:array<string>>>")


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import get_session

    s = get_session("local[8]", 8, app_name="tidewatch-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


def slot(*addrs, index=0):
    """An input/output struct; ``slot(None)`` is a NULL address list."""
    if addrs == (None,):
        return (index, None)
    return (index, list(addrs))


def make_raw(spark, rows):
    """Hand-made raw transactions.  Each row is a dict; missing fields get
    defaults (1 input, 1 output, value 1 coin, not coinbase)."""
    out = []
    for i, r in enumerate(rows):
        ts = r.get("ts", dt.datetime(2020, 1, 1, 12, 0, 0))
        ins = r.get("inputs", [slot(f"I{i}")])
        outs = r.get("outputs", [slot(f"O{i}")])
        ic = r.get("input_count", len(ins) if ins is not None else 0)
        oc = r.get("output_count", len(outs) if outs is not None else 0)
        out.append((
            r.get("hash", f"h{i:04d}"), r.get("block_number", i), ts,
            dt.date(ts.year, ts.month, 1), 100, 100, 1, ic, oc, r.get("fee", 0),
            r.get("cb", False), r.get("in_sat", r.get("out_sat", 100_000_000)),
            r.get("out_sat", 100_000_000), ins, outs))
    return spark.createDataFrame(out, RAW_SCHEMA)
