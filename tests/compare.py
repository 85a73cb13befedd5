"""Run registered queries beside their SQL oracles in DuckDB and compare the whole results.

    python tests/compare.py [sf folder] [name or module prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.runtime import drop_stages  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def kind(name: str) -> str:
    name = str(name).lower()
    return {"string": "varchar", "long": "bigint", "int": "integer", "short": "smallint", "byte": "tinyint",
            "timestamp_ntz": "timestamp"}.get(name, name)


def compare(spark, name, run, sql, folder):
    """Return (ok, message)."""
    began = time.time()
    df = run(spark, folder)
    rows = df.collect()
    drop_stages(spark)
    took = time.time() - began
    cols = sorted(df.columns)
    if not sql:
        return True, f"rows-only {len(rows)} rows {took:.1f}s"
    rel = duck(folder).execute(sql)
    dcols = [d[0] for d in rel.description]
    dkinds = {d[0]: kind(d[1]) for d in rel.description}
    drows = rel.fetchall()
    if sorted(dcols) != cols:
        return False, f"columns {cols} vs {sorted(dcols)}"
    skinds = {c: kind(t) for c, t in df.dtypes}
    skinds = {c: ("bigint" if t == "bigint" else t) for c, t in skinds.items()}
    bad = {c: (skinds[c], dkinds[c]) for c in cols if skinds[c] != dkinds[c]}
    key = lambda r: tuple((v is None, str(type(v)), v) for v in r)
    left = sorted((tuple(plain(r[c]) for c in cols) for r in rows), key=key)
    right = sorted((tuple(plain(r[dcols.index(c)]) for c in cols) for r in drows), key=key)
    if len(left) != len(right):
        return False, f"rows {len(left)} vs {len(right)} {took:.1f}s"
    diff = [(a, b) for a, b in zip(left, right) if a != b]
    if diff:
        return False, f"{len(diff)}/{len(left)} rows differ, e.g. {cols}\n    spark {diff[0][0]}\n    duck  {diff[0][1]}"
    if bad:
        return False, f"types {bad}"
    return True, f"match {len(left)} rows {took:.1f}s" + ("  EMPTY" if not left else "")


def main():
    from tallyloom.plans import load_all
    from tallyloom.runtime import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    registry = load_all()
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                                                    "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    failed = []
    for name, run in registry.QUERIES.items():
        module = registry.MODULE_OF[name]
        if wanted and not any(name == w or module == w for w in wanted):
            continue
        try:
            ok, message = compare(spark, name, run, registry.ORACLES.get(name), folder)
        except Exception as exc:  # noqa: BLE001 - report and go on
            ok, message = False, f"{type(exc).__name__}: {str(exc)[:1200]}"
        print("ok  " if ok else "FAIL", name, message, flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
