"""Run queries beside their SQL and compare rows: ``python -m checks.compare [sf_dir] [name ...]``."""

import sys
import time

import duckdb

from checks import oracle, queries
from subscope.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns, rows):
    """Rows with columns in name order, sorted; values as text so that NULLs sort too."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    """What differs between a DataFrame and a SQL result; empty when they are equal."""
    mine = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    theirs = {column[0]: str(column[1]) for column in result.description}
    rows = result.fetchall()
    found = []
    if mine != theirs:
        found.append(f"schema {sorted(set(mine.items()) ^ set(theirs.items()))}")
        if set(mine) != set(theirs):
            return found
    left, right = rows_of(df.columns, [tuple(row) for row in df.collect()]), rows_of(names, rows)
    if len(left) != len(right):
        found.append(f"{len(left)} rows against {len(right)}")
    if left != right:
        extra, absent = [r for r in left if r not in set(right)], [r for r in right if r not in set(left)]
        found.append(f"columns {sorted(names)}\n   mine {extra[:3]}\n   sql  {absent[:3]}\n   {len(extra)} differ")
    return found


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle.oracle_sql()
    failed = []
    for name, query in queries.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in sql:
                found = differences(query(spark, sf_dir), con, sql[name])
            else:
                rows = query(spark, sf_dir).collect()
                found = [] if rows else ["no rows"]
        except Exception as error:  # one broken query must not hide the others
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        kind = "sql " if name in sql else "rows"
        print(f"{'ok  ' if not found else 'FAIL'} {kind} {time.time() - start:6.2f}s {name}", flush=True)
        for line in found:
            print("   ", line, flush=True)
        if found:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
