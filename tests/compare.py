"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

DATA = os.environ.get("STAYLINE_DATA", "/root/testdata")


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stayline")
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


_SAME = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def compare(spark, con, function, sql, sf_dir) -> list[str]:
    """Differences between the two results; empty when they agree."""
    df = function(spark, sf_dir)
    names = sorted(df.columns)
    if len(set(names)) != len(names):
        return ["duplicate column names"]
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    expected_rows = result.fetchall()
    if sorted(described) != names:
        return [f"columns {names} != {sorted(described)}"]
    problems = []
    for field in df.schema:
        want = _SAME.get(field.dataType.simpleString())
        if want and described[field.name] != want:
            problems.append(f"type {field.name}: {field.dataType.simpleString()} vs {described[field.name]}")
    order = [list(described).index(n) for n in names]
    expected = _sorted([tuple(_plain(r[i]) for i in order) for r in expected_rows])
    actual = _sorted([tuple(_plain(v) for v in r) for r in df.select(*names).collect()])
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if bad:
        problems.append(f"{len(bad)} rows differ in {names}, first: {bad[0][0]} vs {bad[0][1]}")
    if not expected:
        problems.append("both results are empty" if not actual else "oracle is empty")
    return problems


def main(argv: list[str]) -> int:
    from stayline.queries import ORACLES, QUERIES

    sf_dir = argv[0] if argv and "/" in argv[0] else f"{DATA}/sf0.01"
    names = [a for a in argv if "/" not in a] or list(QUERIES)
    spark = session()
    con = connect(sf_dir)
    failures = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                problems = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
            else:
                count = QUERIES[name](spark, sf_dir).count()
                problems = [] if count else ["no rows"]
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        status = "ok" if not problems else "FAIL"
        failures += bool(problems)
        print(f"{status:5}{time.time() - start:7.2f}s {name}" + "".join(f"\n      {p}" for p in problems), flush=True)
    print(f"{len(names) - failures} of {len(names)} agree")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
