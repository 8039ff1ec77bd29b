"""Run queries next to their check SQL and compare rows. Also a script: ``python tests/compare.py FOLDER [NAME...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return 0.0 if value == 0 else value
        return value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Values must be equal to the last bit."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = canonical(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = canonical(df.collect(), df.columns)
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, first {wrong[0]} ({sorted(names)})"
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}
    off = {c: (t, types[c]) for c, t in df.dtypes if kinds[t] != types[c]}
    return f"types differ: {off}" if off else None


def main() -> None:
    import __spark_entry__ as entry
    from quayside.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    con = connect(folder)
    checks, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = run(spark, folder)
            if name in checks:
                verdict = difference(df, con, checks[name]) or "match"
            else:
                verdict = f"{df.count()} rows, no check"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = f"ERROR {str(error)[:900]}"
        bad += verdict.startswith("ERROR") or not (verdict == "match" or verdict.endswith("no check"))
        print(f"{name:34s} {time.time() - began:6.2f}s  {verdict}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
