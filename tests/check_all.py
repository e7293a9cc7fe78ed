"""Runs registered queries against their SQL: python tests/check_all.py SF_DIR [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from compare import compare, connect

sf_dir, wanted = sys.argv[1], sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf_dir)
oracles = entry.oracle_sql()
bad = 0
for name, query in entry.queries().items():
    if wanted and name not in wanted:
        continue
    begin = time.time()
    try:
        found, expected = compare(spark, con, query, oracles[name], sf_dir)
    except Exception as fault:
        bad += 1
        print(f"{name}: FAILED {str(fault)[:1500]}", flush=True)
        continue
    same = found == expected
    bad += not same
    print(f"{name}: {'ok' if same else 'DIFFERENT'} {len(found[1])}/{len(expected[1])} rows, {time.time() - begin:.1f} s", flush=True)
    if not same:
        print("  columns", found[0], expected[0])
        print("  only here", [r for r in found[1] if r not in set(expected[1])][:3])
        print("  only there", [r for r in expected[1] if r not in set(found[1])][:3])
print("bad:", bad)
sys.exit(bool(bad))
