"""Runs check queries and compares them with DuckDB, row for row."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> str:
    """Empty when the result of ``df`` and of ``sql`` are the same bag of rows."""
    result = connection.execute(sql)
    theirs_columns = [d[0] for d in result.description]
    theirs = _rows(theirs_columns, result.fetchall())
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(set(df.columns) ^ set(theirs_columns))}"
    if ours == theirs:
        return ""
    names = sorted(df.columns)
    extra, lacking = list((ours - theirs).elements()), list((theirs - ours).elements())
    shown = [f"{len(extra)} only here, {len(lacking)} only in the oracle"]
    if extra and lacking:
        same = max(lacking, key=lambda r: sum(a == b for a, b in zip(r, extra[0])))
        shown += [f"{n}: {a!r} / {b!r}" for n, a, b in zip(names, extra[0], same) if a != b]
    else:
        shown += [str(dict(zip(names, row))) for row in (extra or lacking)[:2]]
    return "; ".join(shown)


def main(sf_dir: str, *wanted: str) -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = differences(df, connection, oracle[name]) if name in oracle else f"({df.count()} rows, no oracle)"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem) and not problem.startswith("(")
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'same'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1], *sys.argv[2:])
