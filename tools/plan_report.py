"""Execute queries and summarise their final (post-AQE) physical plans.

    python tools/plan_report.py [--no-broadcast] [sf_dir] [key ...]

Counts shuffles (Exchange hashpartitioning / rangepartitioning), single-
partition exchanges, broadcast exchanges, join strategies, windows, Python
(Arrow) evaluation, and whether parquet scans carry pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tradecast.registry import queries  # noqa: E402
from tradecast.session import get_session  # noqa: E402


def plan_text(df) -> str:
    sc = df.sparkSession.sparkContext
    return sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarise(txt: str) -> dict:
    tree = txt.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"^\(\d+\) Exchange", txt, re.M)),
        "single_partition": len(re.findall(r"SinglePartition", txt)),
        "broadcasts": len(re.findall(r"^\(\d+\) BroadcastExchange", txt, re.M)),
        "smj": tree.count("SortMergeJoin"),
        "bhj": tree.count("BroadcastHashJoin"),
        "windows": tree.count("Window"),
        "python": tree.count("FlatMapGroupsInPandas") + tree.count("ArrowEvalPython"),
        "scans": len(re.findall(r"^\(\d+\) Scan parquet", txt, re.M)),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", txt)),
    }


def main():
    args = [a for a in sys.argv[1:] if a != "--no-broadcast"]
    sf_dir, keys = (args or ["/root/testdata/sf0.01"])[0], args[1:]
    spark = get_session(shuffle_partitions=8)
    if len(args) < len(sys.argv) - 1:  # what joins become when no side is small
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    qs = queries()
    keys = keys or [k for k in qs if not k.startswith(("m7", "m8", "m9_metrics_all", "m10_metrics_h12_all",
                                                      "m12_capacity_gbt", "m2_direct_features_by_product"))]
    print("| key | shuffles | single-partition | broadcasts | SMJ | BHJ | windows | python | scans | scans with pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for k in keys:
        df = qs[k](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarise(plan_text(df))
        print(f"| {k} | {s['shuffles']} | {s['single_partition']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} "
              f"| {s['windows']} | {s['python']} | {s['scans']} | {s['pushed']} |")


if __name__ == "__main__":
    main()
