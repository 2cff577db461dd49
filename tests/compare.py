"""Compare registered queries with their DuckDB SQL, value by value."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def compare(name: str, spark_df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    duck_columns = [d[0] for d in result.description]
    duck_types = {d[0]: str(d[1]) for d in result.description}
    duck_rows = result.fetchall()
    spark_rows = spark_df.collect()
    problems = []
    if sorted(duck_columns) != sorted(spark_df.columns):
        extra = set(spark_df.columns) ^ set(duck_columns)
        return [f"{name}: columns differ {sorted(extra)}"]
    for c, t in spark_df.dtypes:
        duck_t = duck_types[c].lower()
        same = {
            "int": ("integer",), "bigint": ("bigint",), "double": ("double",), "string": ("varchar",),
            "date": ("date",), "boolean": ("boolean",),
        }.get(t, (t,))
        if duck_t not in same:
            problems.append(f"{name}.{c}: type {t} against {duck_t}")
    if len(duck_rows) != len(spark_rows):
        problems.append(f"{name}: {len(spark_rows)} rows against {len(duck_rows)}")
    a, b = rows_of(spark_df.columns, spark_rows), rows_of(duck_columns, duck_rows)
    if a != b:
        cols = sorted(duck_columns)
        left, right = list((a - b).elements()), list((b - a).elements())
        problems.append(f"{name}: {len(left)} spark-only and {len(right)} duck-only rows of {len(spark_rows)}")
        for x, y in list(zip(sorted(left), sorted(right)))[:3]:
            problems.append("   " + "; ".join(f"{c}: {u} | {v}" for c, u, v in zip(cols, x, y) if u != v)[:600])
            problems.append("   row " + str(dict(zip(cols, x)))[:500])
    return problems


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").appName("compare").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name not in sqls:
                print(f"rows {name} {df.count()} (no sql) {time.time() - start:.1f}s", flush=True)
                continue
            problems = compare(name, df, con, sqls[name])
        except Exception as e:  # report and go on with the next query
            problems = [f"{name}: {type(e).__name__} {str(e)[:700]}"]
        bad += bool(problems)
        print(("BAD " if problems else "ok  ") + f"{name} {time.time() - start:.1f}s", flush=True)
        for line in problems:
            print("   " + line, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
