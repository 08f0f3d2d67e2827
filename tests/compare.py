"""Run named queries beside their SQL twins and report differences."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def _cell(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value


def compare(spark, name, fn, sql, sf_dir, con) -> dict:
    start = time.time()
    df = fn(spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    took = time.time() - start
    if sql is None:
        return {"name": name, "rows": len(got), "ok": True, "spark_s": took, "duck_s": None}
    start = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    want = normal(cursor.fetchall(), names)
    duck_s = time.time() - start
    ok = got == want and sorted(df.columns) == sorted(names)
    info = {"name": name, "rows": len(got), "ok": ok, "spark_s": took, "duck_s": duck_s}
    spark_types = dict(df.dtypes)
    pairs = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}
    info["types"] = {
        n: (spark_types.get(n), t)
        for n, t in zip(names, types)
        if pairs.get(spark_types.get(n)) != t
        and not (t == "NUMBER" or t == "STRING" or t == "bool")
    }
    if not ok:
        info["columns"] = (sorted(df.columns), sorted(names))
        info["want_rows"] = len(want)
        only = [r for r in got if r not in set(want)][:3] if len(got) < 20000 else got[:3]
        miss = [r for r in want if r not in set(got)][:3] if len(want) < 20000 else want[:3]
        info["only_spark"], info["only_sql"] = only, miss
    return info


if __name__ == "__main__":
    from txgraph.session import build_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if chosen and name not in chosen:
            continue
        try:
            info = compare(spark, name, fn, oracle.get(name), sf_dir, con)
        except Exception as error:  # noqa: BLE001
            info = {"name": name, "ok": False, "error": str(error)[:700]}
        if info["ok"]:
            print(
                f"ok   {name:26s} rows={info['rows']:<7d} spark={info['spark_s']:.1f}s duck="
                f"{info['duck_s'] if info['duck_s'] is None else round(info['duck_s'], 1)}s {info.get('types') or ''}",
                flush=True,
            )
        else:
            print("FAIL", info, flush=True)
