"""Print the scan / exchange / join / aggregate nodes of key plans.

Usage: python tests/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def nodes(df) -> list[str]:
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    tree = text.split("\n\n")[0]
    out = []
    for ln in tree.splitlines():
        m = re.search(r"(Scan parquet|Exchange|\w*Join\w*|HashAggregate|ObjectHashAggregate|"
                      r"SortAggregate|Generate|Expand|BroadcastExchange)", ln)
        if m:
            out.append(ln.rstrip())
    details = {}
    for block in text.split("\n\n")[1:]:
        head = block.strip().splitlines()[0] if block.strip() else ""
        if "Scan parquet" in head or "Exchange" in head:
            keep = [x for x in block.splitlines()
                    if x.startswith(("PartitionFilters", "PushedFilters", "ReadSchema", "Arguments"))]
            details[head] = keep
    return out, details


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tidewatch.operators import extract_window, kpi_daily, kpi_global
    from tidewatch.plans import kpi_daily_slides, kpi_global_slides
    from tidewatch.session import get_session, scratch_path
    from tidewatch.sources import read_raw, tx, write_raw

    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    path = scratch_path(spark, "plan-raw")
    write_raw(tx(spark, sf_dir), path)
    raw = read_raw(spark, path)
    st = ("1995-01-01", "1995-01-31")
    w = extract_window(raw, "1995-02-05", "1995-03-07")
    cases = {
        "kpi_daily(extract_window)": kpi_daily(w),
        "kpi_global(extract_window)": kpi_global(w),
        "kpi_global_slides(15)": kpi_global_slides(raw, st, 15),
        "kpi_daily_slides(15)": kpi_daily_slides(raw, st, 15),
    }
    for name, df in cases.items():
        tree, details = nodes(df)
        print(f"### {name}\n\n```")
        print("\n".join(tree))
        for head, keep in details.items():
            print(head)
            for x in keep:
                print("    " + x[:220])
        print("```\n")


if __name__ == "__main__":
    main()
