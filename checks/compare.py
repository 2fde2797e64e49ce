"""Run every registered query and its SQL check side by side: ``python -m checks.compare DIR``."""

from __future__ import annotations

import sys
import time

import duckdb

from checks.oracle import ORACLES
from checks.queries import REGISTRY
from palaver.session import local_session

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
    "date": "DATE", "boolean": "BOOLEAN", "double": "DOUBLE",
}
SOURCES = "nation customer orders lineitem events documents".split()


def _rows(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    base = duckdb.connect()
    for source in SOURCES:
        base.execute(f"CREATE VIEW {source} AS SELECT * FROM '{sf_dir}/{source}.parquet'")
    failures = 0
    for name in names or REGISTRY:
        start = time.time()
        try:
            frame = REGISTRY[name](spark, sf_dir)
            ours = _rows(frame.columns, frame.collect())
            middle = time.time()
            if name not in ORACLES:
                print(f"{name:28s} rows only {len(ours):7d} {middle - start:6.2f}s", flush=True)
                continue
            result = base.execute(ORACLES[name])
            columns = [d[0] for d in result.description]
            theirs = _rows(columns, result.fetchall())
            described = base.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
            schema = sorted((d[0], d[1]) for d in described)
            expected = sorted((column, TYPES[kind]) for column, kind in frame.dtypes)
            same = ours == theirs and schema == expected
        except Exception as error:  # report and go on with the next query
            failures += 1
            print(f"{name:28s} ERROR {str(error)[:1500]}", flush=True)
            continue
        failures += not same
        print(
            f"{name:28s} {'same' if same else 'DIFFERENT'} {len(ours):7d} {len(theirs):7d} "
            f"{middle - start:6.2f}s {time.time() - middle:6.2f}s",
            flush=True,
        )
        if not same:
            print("   ", sorted(set(schema) ^ set(expected)))
            extra = [r for r in ours if r not in set(theirs)][:3]
            missing = [r for r in theirs if r not in set(ours)][:3]
            for label, rows in (("spark", extra), ("sql", missing)):
                for row in rows:
                    print("   ", label, row[:600])
    return failures


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
