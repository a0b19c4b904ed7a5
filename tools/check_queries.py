"""Run queries against their SQL and print one line each.

    python tools/check_queries.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from hearthspark.plans.catalog import all_queries  # noqa: E402
from hearthspark.session import local_session  # noqa: E402
from tests.comparison import difference, duck  # noqa: E402


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark, con, bad = local_session(), duck(sf_dir), []
    for name, q in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = q(spark, sf_dir)
            found = f"no SQL, {df.count()} rows" if q.sql is None else difference(df, con, q.sql)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        ok = found is None or found.startswith("no SQL")
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
        if not ok:
            bad.append(name)
    print("bad:", bad)
    return len(bad)


if __name__ == "__main__":
    sys.exit(main())
