"""python tests/run_oracle.py [name ...]: compare registered queries with their SQL at sf0.01."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle
from parley import catalog, runtime

if __name__ == "__main__":
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    catalog.load()
    spark = runtime.session(spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    con = oracle.connect(sf)
    for name in sys.argv[1:] or catalog.QUERIES:
        start = time.time()
        try:
            df = catalog.QUERIES[name](spark, sf)
            if name in catalog.ORACLE:
                result = oracle.difference(df, con, catalog.ORACLE[name], timing := []) or "ok"
                result += f"   (spark {timing[0] - start:.1f}s)"
            else:
                result = f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:500]}"
        print(f"{name:32s} {time.time() - start:6.1f}s  {result}", flush=True)
