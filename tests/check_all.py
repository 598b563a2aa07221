"""Print one line per registered query: time and first difference, if any."""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from oracle import difference  # noqa: E402

from tidemark.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

sf_dir = sys.argv[1]
names = sys.argv[2:] or list(QUERIES)
spark = build_session(
    master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
)
spark.sparkContext.setLogLevel("ERROR")
bad = 0
for name in names:
    start = time.time()
    try:
        found = difference(spark, name, sf_dir)
    except Exception as error:
        traceback.print_exc(limit=-4)
        found = f"{type(error).__name__}: {str(error)[:600]}"
    bad += found is not None
    print(f"{'ok  ' if found is None else 'FAIL'} {time.time() - start:6.2f}s {name} {(found or '')[:900]}", flush=True)
print(f"{bad} failed of {len(names)}")
