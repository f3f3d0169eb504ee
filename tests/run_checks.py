"""Compare all queries, or those named, with their SQL: ``python -m tests.run_checks [sf_dir] [names...]``."""

import sys

from eventweft.checks import ORACLES, QUERIES
from eventweft.session import local_session
from tests.compare import compare, database

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), database(sf_dir)
    bad = []
    for name in names:
        try:
            result = compare(spark, sf_dir, name, QUERIES[name], ORACLES.get(name), con)
        except Exception as e:
            result = {"name": name, "ok": False, "error": f"{type(e).__name__}: {str(e)[:600]}"}
        print(result, flush=True)
        if result["ok"] is False:
            bad.append(name)
    print("failed:", bad)
