"""Compare queries with their SQL: ``python check.py [sf_dir] [name-part …]``."""

import sys

from gatelake.plans.queries import ORACLES, QUERIES
from gatelake.session import local_session
from tests.harness import compare, duck


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    names = [n for n in QUERIES if not parts or any(p in n for p in parts)]
    spark, con, bad = local_session(8), duck(sf), 0
    for n in names:
        try:
            r = compare(spark, con, n, QUERIES[n], ORACLES.get(n), sf)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:700]}"}
        bad += r["ok"] is False
        print({True: "ok  ", False: "BAD ", None: "rows"}[r["ok"]], r, flush=True)
    print(f"{len(names)} queries, {bad} bad, {sum(n in ORACLES for n in names)} with SQL")


if __name__ == "__main__":
    main()
