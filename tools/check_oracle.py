"""Run registered queries against their DuckDB oracle (local development aid).

    python tools/check_oracle.py [sf_dir] [key-substring ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tests"))

from harness import compare, duck  # noqa: E402

from tradecast.registry import oracle_sql, queries  # noqa: E402
from tradecast.session import get_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    filt = sys.argv[2:]
    spark = get_session(shuffle_partitions=8)
    # e.g. TRADECAST_EXTRA_CONF="spark.sql.ansi.enabled=false,spark.sql.session.timeZone=Asia/Tokyo"
    for kv in filter(None, os.environ.get("TRADECAST_EXTRA_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        spark.conf.set(k, v)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if filt and not any(f in k for f in filt):
            continue
        t = time.time()
        if k not in sqls:
            try:
                n = fn(spark, sf_dir).count()
                print(f"{k:36s} ROWS-ONLY rows={n} {time.time() - t:.1f}s")
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"{k:36s} ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        try:
            r = compare(spark, sf_dir, fn, sqls[k], con)
            ok = r["hash_match"] and r["spark_rows"] == r["oracle_rows"]
            bad += not ok
            print(f"{k:36s} {'OK ' if ok else 'BAD'} rows={r['spark_rows']}/{r['oracle_rows']} {time.time() - t:.1f}s"
                  + ("" if ok else "\n    " + json.dumps({x: r[x] for x in r if x not in ('spark_rows', 'oracle_rows')},
                                                          default=str)[:1500]))
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{k:36s} ERROR {type(e).__name__}: {str(e)[:600]}")
    print("failures:", bad)


if __name__ == "__main__":
    main()
