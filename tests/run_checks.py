"""Compare queries with their SQL: ``python tests/run_checks.py [folder] [names…]``."""

import sys
import traceback

sys.path.insert(0, "/root/repo")

import __spark_entry__ as entry
from shelfwise.session import build_session
from tests.harness import check, connect


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    from_module = lambda n: queries[n].__doc__ or ""
    for name in [n for n in queries if not args or any(a in n or a == from_module(n) for a in args)]:
        try:
            problem, rows, took = check(spark, con, name, queries[name], oracles.get(name), folder)
        except Exception as err:
            problem, rows, took = f"{type(err).__name__}: {str(err)[:600]}", -1, 0.0
            if len(args) == 1:
                traceback.print_exc()
        bad += problem is not None
        mark = "BAD" if problem else ("ok " if name in oracles else "row")
        print(f"{mark} {name:34s} {rows:8d} rows {took:6.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
