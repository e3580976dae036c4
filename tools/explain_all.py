"""Summarise the physical plan of every registered query (AQE initial plan).

    python tools/explain_all.py [sf_dir] > PLANS.md

Per query: shuffles (Exchange), broadcasts, sort-merge joins, partial
top-1-per-key (WindowGroupLimit Partial), hash aggregates, window nodes,
scalar subqueries, Python UDF nodes (must be 0) and what each scan reads.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SKIP = {"stream_ingest", "stream_upsert", "stream_tumbling", "stream_tumbling_hourly",
        "stream_tumbling_watermark", "stream_daily_signals",
        "medallion_gold"}  # these run jobs while they are built; see tests instead


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n")[0], text


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from signalmart.plans.registry import QUERIES
    from signalmart.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=16)
    print("# Plan summary per query\n")
    print(f"Generated by `tools/explain_all.py` on `{sf_dir}` (AQE initial plans; at run time "
          "AQE may also turn a shuffle join into a broadcast from the exact sizes).\n")
    print("| query | shuffle Exchange | BroadcastExchange | SMJ | WGL partial | HashAgg | Window | "
          "Subquery | PyUDF | scans: read schema |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        head, full = tree(fn(spark, sf_dir))
        c = lambda pat: len(re.findall(pat, head))
        scans = re.findall(r"Location: \w+ \[[^\]]*/([\w.]+)\]\n(?:.*\n)*?ReadSchema: struct<(.*)>\n",
                           full)
        scan_txt = "; ".join(f"{t}: {s}" for t, s in scans)
        print(f"| {name} | {c(r'(?<![A-Za-z])Exchange \(')} | {c(r'BroadcastExchange \(')} | "
              f"{c(r'SortMergeJoin')} | {len(re.findall(r'row_number\(\), 1, Partial', full))} | "
              f"{c(r'HashAggregate')} | {c(r' Window \(')} | {c(r'Subquery')} | "
              f"{c(r'ArrowEvalPython|BatchEvalPython|InPandas')} | {scan_txt} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
