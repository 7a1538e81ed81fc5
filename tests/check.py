"""Run queries against their SQL and report: python tests/check.py SF_DIR [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402

from codequarry.session import local_session  # noqa: E402


def main(sf: str, names: list[str]) -> int:
    spark = local_session()
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                diff = differences(queries[name](spark, sf), con, oracles[name])
            else:
                diff = [] if queries[name](spark, sf).count() else ["no rows"]
        except Exception as e:  # reported, the run goes on
            diff = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - start:.1f}s", *diff, sep="\n     " if diff else " ", flush=True)
    print(f"{bad} failed; without SQL: {sorted(set(queries) - set(oracles))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
