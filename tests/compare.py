"""Run a query and its SQL twin and compare the rows, order aside."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from runweave.plans.views import BASE


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(names, raw):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in raw), key=lambda r: repr(r)
    )


def differences(spark_df, sql: str, con) -> list[str]:
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = rows(want_names, cur.fetchall())
    got = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    problems = []
    if sorted(spark_df.columns) != sorted(want_names):
        problems.append(f"columns {sorted(spark_df.columns)} != {sorted(want_names)}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows, SQL gives {len(want)}")
    if not want:
        problems.append("SQL gives no rows")
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w][:3]
        problems.extend(f"got  {str(g)[:300]}\n   want {str(w)[:300]}" for g, w in bad)
    return problems


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from runweave.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8)
    con, sql = connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                found = differences(fn(spark, sf_dir), sql[name], con)
                note = "ok" if not found else "DIFF\n   " + "\n   ".join(found)
            else:
                note = f"{len(fn(spark, sf_dir).collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            note = f"ERROR {type(error).__name__}: {str(error)[:900]}"
        failed += note.startswith(("DIFF", "ERROR"))
        print(f"{name}: {note} ({time.time() - start:.1f}s)", flush=True)
    print(f"{failed} failed")
