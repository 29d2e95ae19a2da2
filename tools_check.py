"""Run registered queries against their DuckDB oracles: python tools_check.py [sf_dir] [names...]"""

import json
import sys
import time

from strata.plans.catalog import load_all
from strata.plans.check import check_query, duckdb_conn
from strata.session import get_session

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_conn(sf_dir)
    reg = load_all()
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            res = check_query(spark, q, sf_dir, con)
        except Exception as e:  # report and continue
            res = {"name": name, "problems": [f"error: {type(e).__name__}: {str(e)[:400]}"]}
        res["sec"] = round(time.time() - t, 2)
        bad += bool(res["problems"])
        print(json.dumps(res, default=str)[:1500], flush=True)
    print(f"# {len(reg)} registered, {bad} with problems")
