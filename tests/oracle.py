"""Runs catalogue queries in Spark and their reference SQL in DuckDB and compares rows.

usage: python tests/oracle.py [sf] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(r[i]) for i in order) for r in rows))


def compare(spark, db, name, fn, text, sf_dir):
    """(ok, message) for one query."""
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if text is None:
        return True, f"{len(rows)} rows (no SQL)"
    relation = db.sql(text)
    expected = relation.fetchall()
    if sorted(df.columns) != sorted(relation.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    got, want = normal(rows, df.columns), normal(expected, relation.columns)
    if got == want:
        kinds = [(f.name, f.dataType.simpleString(), str(t)) for f, t in
                 zip(sorted(df.schema, key=lambda f: f.name),
                     [t for _, t in sorted(zip(relation.columns, relation.types), key=lambda p: p[0])])]
        odd = [k for k in kinds if KIND.get(k[1], k[1]) != k[2]]
        return True, f"{len(rows)} rows" + (f"  types differ: {odd}" if odd else "")
    known, found = set(want), set(got)
    extra = [r for r in got if r not in known][:3]
    missing = [r for r in want if r not in found][:3]
    return False, f"rows {len(got)} vs {len(want)}\n   spark only {extra}\n   sql only   {missing}\n   {sorted(df.columns)}"


KIND = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def main():
    import __spark_entry__ as entry
    from cyclelake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("oracle", "local[4]", 4)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    queries, texts, bad = entry.queries(), entry.oracle_sql(), []
    for name, fn in queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            ok, message = compare(spark, db, name, fn, texts.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - start:6.2f}s {message}", flush=True)
        bad += [] if ok else [name]
    print(f"{len(bad)} failing: {bad}")


if __name__ == "__main__":
    main()
