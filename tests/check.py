"""Compare the registered queries with their SQL: ``python tests/check.py [folder] [names]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, db, folder: str, name: str) -> str | None:
    """None when rows, names and values are equal; otherwise what differs."""
    import __spark_entry__ as entry

    frame = entry.queries()[name](spark, folder)
    ours = rows_of(frame.columns, frame.collect())
    relation = db.sql(entry.oracle_sql()[name])
    theirs = rows_of(relation.columns, relation.fetchall())
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} and {sorted(relation.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    for mine, other in zip(ours, theirs, strict=True):
        if mine != other:
            pairs = [(a, b) for a, b in zip(mine, other, strict=True) if a != b]
            return f"values {mine[:1]}: {str(pairs)[:600]}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from postmill.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.oracle_sql())
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, db, folder, name)
        except Exception as failure:  # noqa: BLE001 - report every query
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += problem is not None
        print(f"{name:24} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("all equal" if not bad else f"{bad} differ")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
