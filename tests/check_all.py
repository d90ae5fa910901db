"""Run every query against its SQL: ``python tests/check_all.py FOLDER [NAME ...]``."""
import faulthandler
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.oracle import connect, mismatch  # noqa: E402

folder, wanted = sys.argv[1], sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
    .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con, oracles, bad = connect(folder), oracle_sql(), 0
for name, run in queries().items():
    if name not in oracles:
        continue
    if wanted and name not in wanted:
        continue
    start = time.time()
    faulthandler.dump_traceback_later(120, exit=True)
    try:
        problem = mismatch(run(spark, folder), con, oracles[name])
    except Exception as error:  # noqa: BLE001
        problem = f"{type(error).__name__}: {str(error)[:1200]}"
    bad += problem is not None
    print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if problem is None else problem[:1500]}", flush=True)
print("failed:", bad)
