"""Run registered queries next to their DuckDB SQL: ``python -m fieldgauge.checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from fieldgauge.checks.oracles import ORACLES
from fieldgauge.checks.queries import REGISTRY
from fieldgauge.session import build_session

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def rows_of(table) -> list[tuple]:
    """Rows as tuples over the columns in name order, in a definite order."""
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(spark_table, duck_table) -> list[str]:
    if sorted(spark_table.column_names) != sorted(duck_table.column_names):
        return [f"columns {sorted(spark_table.column_names)} against {sorted(duck_table.column_names)}"]
    found = []
    for name in sorted(spark_table.column_names):
        ours, theirs = str(spark_table.schema.field(name).type), str(duck_table.schema.field(name).type)
        if ours.replace("large_", "") != theirs.replace("large_", ""):
            found.append(f"type of {name}: {ours} against {theirs}")
    if spark_table.num_rows != duck_table.num_rows:
        return [*found, f"rows {spark_table.num_rows} against {duck_table.num_rows}"]
    for ours, theirs in zip(rows_of(spark_table), rows_of(duck_table)):
        if ours != theirs:
            return [*found, f"{ours} against {theirs}"]
    return found


def compare(spark, db, sf_dir: str, name: str) -> list[str]:
    ours = REGISTRY[name](spark, sf_dir).toArrow()
    if name not in ORACLES:
        return [] if ours.num_rows else ["no rows"]
    theirs = db.execute(ORACLES[name]).to_arrow_table()
    return differences(ours, theirs)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else DEFAULT_DIR
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, db, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on to the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n      ")
    print(f"{len(names) - bad} of {len(names)} agree; without SQL: {sorted(set(REGISTRY) - set(ORACLES))}; "
          f"SQL without query: {sorted(set(ORACLES) - set(REGISTRY))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
