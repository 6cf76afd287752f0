"""Compare every query with its SQL: python tests/oracle.py SF_DIR [name ...]"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (bool, int, str)) or value is None:
        return repr(value)
    return str(value)


def table_hash(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_cell(r[i]) for i in order) for r in rows)
    return lines, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, db, name, query, sql, sf_dir):
    """(ok, note) for one query; sql may be None for rows only."""
    begin = time.time()
    frame = query(spark, sf_dir)
    got = frame.collect()
    took = time.time() - begin
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL, {took:.1f}s"
    answer = db.execute(sql)
    columns = [c[0] for c in answer.description]
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(columns)}"
    want = answer.fetchall()
    a, ha = table_hash(frame.columns, got)
    b, hb = table_hash(columns, want)
    if ha == hb:
        return True, f"{len(a)} rows, {took:.1f}s"
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return False, f"rows {len(a)} / {len(b)}, differ {len(only_a)} / {len(only_b)}\n  {only_a[:3]}\n  {only_b[:3]}"


def main(sf_dir: str, *names: str) -> int:
    import __spark_entry__ as entry
    from tapeloom import session

    spark = session.create("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    db, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        try:
            ok, note = compare(spark, db, name, query, sqls.get(name), sf_dir)
        except Exception as problem:  # noqa: BLE001
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name}: {note}", flush=True)
    print(f"{bad} bad; SQL without query: {sorted(set(sqls) - set(entry.queries()))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
