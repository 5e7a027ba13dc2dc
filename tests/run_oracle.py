"""Compare all or some registered queries with DuckDB: run_oracle.py SF_DIR [name ...]."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from stratavid.session import local_session  # noqa: E402
from tests.compare import check, connect  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    queries, oracle = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(oracle)), "unknown:", sorted(set(oracle) - set(queries)))
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in names or queries:
        start = time.time()
        try:
            found = check(spark, sf_dir, name, queries[name], oracle[name], con)
        except Exception as error:  # report and go on with the next query
            traceback.print_exc(limit=2)
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print("bad:", bad)
