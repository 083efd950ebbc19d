"""Run queries next to their SQL and compare the rows, whatever their order."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("skillframe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.10g}".replace("-0", "0") if value == 0 else f"{value:.10g}"
    return repr(value)


def rows_of(df: DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted(tuple(_cell(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def expected(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(_cell(r[i]) for i in order) for r in cursor.fetchall())
    return sorted(names), rows


def check(spark: SparkSession, name: str, fn, sql: str | None, sf_dir: str) -> str:
    began = time.time()
    df = fn(spark, sf_dir)
    got = rows_of(df)
    seconds = time.time() - began
    if sql is None:
        return f"rows {name}: {len(got)} rows, {seconds:.1f}s"
    names, want = expected(sql, sf_dir)
    if sorted(df.columns) != names:
        return f"FAIL {name}: columns {sorted(df.columns)} against {names}"
    if got != want:
        missing = [r for r in want if r not in set(got)][:3]
        surplus = [r for r in got if r not in set(want)][:3]
        return f"FAIL {name}: {len(got)} rows against {len(want)}; missing {missing}; surplus {surplus}"
    return f"ok   {name}: {len(got)} rows, {seconds:.1f}s"


def main() -> int:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    from skillframe.queries import all_oracles, all_queries

    spark = session()
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    oracles = all_oracles()
    failed = 0
    for name, fn in all_queries().items():
        if wanted and name not in wanted:
            continue
        try:
            line = check(spark, name, fn, oracles.get(name), sf_dir)
        except Exception as problem:  # report and go on with the next query
            line = f"FAIL {name}: {type(problem).__name__}: {str(problem)[:600]}"
        failed += line.startswith("FAIL")
        print(line, flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
