"""CLI: python tests/run_oracle.py [sf_dir] [name ...] — compare queries with their oracles."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from netquery.plans.registry import load_all  # noqa: E402
from netquery.session import build_session  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    q, o = load_all()
    extra = {}
    if os.environ.get("ORACLE_TZ"):
        extra["spark.sql.session.timeZone"] = os.environ["ORACLE_TZ"]
    spark = build_session(extra=extra)
    only_sql = bool(os.environ.get("ORACLE_ONLY_SQL"))
    con = duck(sf)
    bad = 0
    for name in sorted(q):
        if names and name not in names:
            continue
        if only_sql and name not in o:
            continue
        t = time.time()
        try:
            if name in o:
                r = compare(spark, name, q[name], o[name], sf, con)
            else:
                rows = q[name](spark, sf).collect()
                r = {"name": name, "spark_rows": len(rows), "ok": True, "rows_only": True,
                     "sample": [tuple(x) for x in rows[:2]]}
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "error": repr(e)[:600]}
        r["sec"] = round(time.time() - t, 2)
        bad += not r["ok"]
        print(json.dumps(r, default=str), flush=True)
    print(json.dumps({"failed": bad}))


if __name__ == "__main__":
    main()
