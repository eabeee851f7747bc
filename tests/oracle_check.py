"""Compare every catalogued query with its DuckDB equivalent: ``python tests/oracle_check.py [dir] [names...]``."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return value if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}


def compare(spark, con, name, function, sql, sf_dir):
    """Problem text, or None if columns, types and values agree."""
    df = function(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    con.execute(sql)
    columns = [d[0] for d in con.description]
    kinds = {d[0]: str(d[1]) for d in con.description}
    want = rows_of(columns, con.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    wrong = {n: (t, kinds[n]) for n, t in types.items() if t != kinds[n]}
    if wrong:
        return f"types {wrong}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"\n  got  {a}\n  want {b}"[:900]
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, oracles = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, function in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, function, oracles[name], sf_dir)
            else:
                problem = None if function(spark, sf_dir).count() > 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    spark.stop()


if __name__ == "__main__":
    main()
