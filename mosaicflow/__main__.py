"""python -m mosaicflow list | run QUERY FOLDER [--out FOLDER] | sql QUERY

Runs a registered query over a folder of Parquet tables in the session that spark-submit or the environment sets up, and
shows its first rows or writes them all as Parquet.
"""

from __future__ import annotations

import argparse


def main(argv: list[str] | None = None) -> int:
    from .plans import all_queries

    ap = argparse.ArgumentParser(prog="mosaicflow", description=__doc__)
    todo = ap.add_subparsers(dest="todo", required=True)
    todo.add_parser("list")
    for name in ("run", "sql"):
        sub = todo.add_parser(name)
        sub.add_argument("query")
        if name == "run":
            sub.add_argument("folder")
            sub.add_argument("--out")
    args = ap.parse_args(argv)
    queries, sql = all_queries()
    if args.todo == "list":
        print("\n".join(sorted(queries)))
        return 0
    if args.query not in queries:
        ap.error(f"no such query: {args.query}")
    if args.todo == "sql":
        print(sql.get(args.query, "-- cannot be said in SQL"))
        return 0
    from pyspark.sql import SparkSession

    df = queries[args.query](SparkSession.builder.getOrCreate(), args.folder)
    df.write.parquet(args.out) if args.out else df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
