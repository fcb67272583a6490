"""Side-by-side run of the registered queries and their SQL: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted(rows, columns, wanted):
    order = [columns.index(c) for c in wanted]
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


FAMILIES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree in columns, types and rows; otherwise a short account."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    kinds = dict(con.execute(f"DESCRIBE {sql}").fetchall() and [
        (r[0], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()
    ])
    ours_names = spark_df.columns
    if sorted(names) != sorted(ours_names):
        return f"columns {sorted(ours_names)} != {sorted(names)}"
    for name, kind in spark_df.dtypes:
        if FAMILIES.get(kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    ours = [tuple(r) for r in spark_df.collect()]
    wanted = sorted(names)
    a, b = _sorted(ours, ours_names, wanted), _sorted(theirs, names, wanted)
    if len(a) != len(b):
        extra = [x for x in a if x not in b][:2], [x for x in b if x not in a][:2]
        return f"{len(a)} rows != {len(b)}; {str(extra)[:600]}"
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{dict(zip(wanted, x))} != {dict(zip(wanted, y))}"[:1200]
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(folder), oracle_sql(), 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            df = query(spark, folder)
            if name in oracles:
                problem = difference(df, con, oracles[name])
            else:
                problem, count = None, df.count()
                name = f"{name} (rows only: {count})"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
