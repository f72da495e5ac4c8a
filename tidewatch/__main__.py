"""Job entry point (``spark-submit -m tidewatch`` or ``python -m tidewatch``).

    python -m tidewatch setup      --raw PATH --root PATH --month 2012-01-01
    python -m tidewatch slide      --raw PATH --root PATH [--times 1]
    python -m tidewatch run-slides --raw PATH --root PATH --n 15
    python -m tidewatch refresh    --raw PATH --root PATH
    python -m tidewatch verdict    --raw PATH --root PATH

``--raw`` is the month-partitioned raw table (or ``--table`` a catalog
table); ``--root`` the shared output folder (state, window and KPI tables).
A scheduler runs ``slide`` once per period; ``run-slides`` backfills many
slides in one pass.
"""

from __future__ import annotations

import argparse
import json
import sys

from tidewatch.plans import Pipeline
from tidewatch.schema import SAT_PER_COIN, SLIDE_DAYS, WHALE_THRESHOLD_COINS
from tidewatch.session import get_session
from tidewatch.sources import read_raw


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tidewatch")
    ap.add_argument("command", choices=["setup", "slide", "run-slides", "refresh", "verdict"])
    ap.add_argument("--raw")
    ap.add_argument("--table")
    ap.add_argument("--root", required=True)
    ap.add_argument("--month", default=None)
    ap.add_argument("--times", type=int, default=1)
    ap.add_argument("--n", type=int, default=15)
    ap.add_argument("--step-days", type=int, default=SLIDE_DAYS)
    ap.add_argument("--whale-coins", type=int, default=WHALE_THRESHOLD_COINS,
                    help="least output value, in coins, of a whale transaction")
    ap.add_argument("--keep", type=int, default=None, help="versions whose tables stay; all by default")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="initial AQE shuffle partitions, ~1 per 128 MB shuffled")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    if not (a.raw or a.table):
        ap.error("--raw or --table is required")

    spark = get_session(a.master)
    p = Pipeline(spark, read_raw(spark, a.raw, a.table), a.root, a.step_days,
                 a.whale_coins * SAT_PER_COIN, a.shuffle_partitions, keep=a.keep)
    if a.command == "setup":
        if not a.month:
            ap.error("setup needs --month")
        v = p.setup(a.month)
    elif a.command == "slide":
        v = p.run(a.times)
    elif a.command == "run-slides":
        v = p.run_slides(a.n)
    elif a.command == "refresh":
        v = p.refresh_kpis()
    else:
        r = p.verdict().first().asDict()
        print(json.dumps({k: str(x) for k, x in r.items()}))
        return 0 if (r["non_empty"] and r["in_bounds"]) else 1
    start, end, version = p.state.bounds()
    print(json.dumps({"version": v, "start_date": str(start), "end_date": str(end)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
