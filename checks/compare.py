"""Run each query in Spark and its SQL in DuckDB, and compare names and values."""

import sys
import tempfile
import time
from decimal import Decimal
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from spoolway.session import session


def plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def main(sf_dir: str, names: list[str]) -> int:
    shared = tempfile.mkdtemp(prefix="spoolway-compare-")
    spark = session("local[8]", 8, **{"spark.ui.enabled": "false", "spark.checkpoint.dir": shared})
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    failed = 0
    for name in names or QUERIES:
        begin = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            rows = df.collect()
            took = time.time() - begin
            if name not in ORACLE:
                print(f"rows  {name:26} {len(rows):8} {took:6.2f}s")
                continue
            found = con.execute(ORACLE[name])
            columns = [d[0] for d in found.description]
            types = [str(d[1]) for d in found.description]
            want = normal(columns, found.fetchall())
            have = normal(df.columns, rows)
        except Exception as e:
            failed += 1
            print(f"ERROR {name:26} {str(e)[:600]}")
            continue
        if sorted(columns) != sorted(df.columns):
            failed += 1
            print(f"NAMES {name:26} {sorted(columns)} {sorted(df.columns)}")
        elif want != have:
            failed += 1
            print(f"DIFF  {name:26} duckdb {len(want)} spark {len(have)}")
            missing, extra = set(map(repr, want)) - set(map(repr, have)), set(map(repr, have)) - set(map(repr, want))
            print("   only duckdb", sorted(missing)[:3], "\n   only spark ", sorted(extra)[:3])
        else:
            print(f"ok    {name:26} {len(have):8} {took:6.2f}s {dict(df.dtypes)} {dict(zip(columns, types))}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
