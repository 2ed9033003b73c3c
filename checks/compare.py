"""Run the queries on Spark and their SQL on DuckDB, and compare: python -m checks.compare SF_DIR [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barloom")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and a SQL result; empty when they agree."""
    cols = sorted(df.columns)
    mine = sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=_key)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return [f"columns {cols} != {sorted(names)}"]
    at = [names.index(c) for c in cols]
    theirs = sorted((tuple(_plain(row[i]) for i in at) for row in cur.fetchall()), key=_key)
    if len(mine) != len(theirs):
        return [f"rows {len(mine)} != {len(theirs)}", f"{mine[:2]} / {theirs[:2]}"]
    out = []
    for a, b in zip(mine, theirs):
        if a != b:
            out.append(", ".join(f"{c}: {x!r} != {y!r}" for c, x, y in zip(cols, a, b) if x != y))
    return out


def main() -> None:
    from checks.queries import ORACLE, QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con = session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        t = time.perf_counter()
        try:
            df = QUERIES[name](spark, sf_dir)
            diff = differences(df, con, ORACLE[name]) if name in ORACLE else [f"(no SQL) {df.count()} rows"]
            n = "" if diff else f"{df.count()} rows"
        except Exception as e:  # noqa: BLE001
            diff, n = [f"{type(e).__name__}: {str(e)[:600]}"], ""
        bad += bool(diff)
        print(f"{name:24} {time.perf_counter() - t:6.1f}s {'ok ' + n if not diff else f'{len(diff)} differences'}", flush=True)
        for d in diff[:3]:
            print("   ", d[:700], flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
