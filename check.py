"""Run every registered query next to its SQL counterpart: ``python check.py [folder] [name ...]``."""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

import oracle_queries
import registry
from tests import oracle


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(folder)
    statements = oracle_queries.oracle_sql()
    failures = 0
    for name, query in registry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            got = df.toPandas()
            took = time.time() - start
            if name not in statements:
                print(f"rows  {name} {len(got)} rows {took:.1f}s", flush=True)
                continue
            result = con.execute(statements[name])
            types = [(d[0], d[1]) for d in result.description]
            problems = oracle.differences(got, result.df()) + oracle.kinds(df.schema, types)
        except Exception as error:
            took, problems, got = time.time() - start, [str(error)[:1500]], []
        failures += bool(problems)
        print(f"{'FAIL ' if problems else 'ok   '} {name} {len(got)} rows {took:.1f}s", flush=True)
        for p in problems:
            print("      ", p, flush=True)
    return failures


if __name__ == "__main__":
    arguments = sys.argv[1:]
    target = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    sys.exit(main(target, arguments))
