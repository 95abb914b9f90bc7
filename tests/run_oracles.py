"""Run all queries (or those named) at a scale and print what differs from SQL.

    python tests/run_oracles.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from opine.session import local_session  # noqa: E402
from oracle import connect, differences  # noqa: E402


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            result = queries()[name](spark, folder)
            if name in oracle_sql():
                found = differences(result.toArrow(), connection.sql(oracle_sql()[name]).to_arrow_table())
                state = "MATCH" if not found else "DIFFER"
            else:
                found, state = [], f"rows={result.count()}"
        except Exception as error:  # noqa: BLE001
            found, state = [str(error)[:1500]], "ERROR"
        bad += bool(found)
        print(f"{name:32s} {state:10s} {time.time() - start:6.2f}s", flush=True)
        for line in found:
            print("    ", line, flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
