"""Run registered queries next to their SQL in an in-process DuckDB and compare.

usage: python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, float):
        return "nan" if v != v else repr(v + 0.0)
    return f"{type(v).__name__}:{v!r}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def sql_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), _rows(columns, cur.fetchall())


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def compare(df, con, sql) -> str | None:
    """None if equal, else a short description of the difference."""
    sc, sr = spark_rows(df)
    dc, dr = sql_rows(con, sql)
    if sc != dc:
        return f"columns {sc} != {dc}"
    if len(sr) != len(dr):
        a, b = set(sr), set(dr)
        return f"rows {len(sr)} != {len(dr)}; {list(a - b)[:2]} / {list(b - a)[:2]}"
    if sr != dr:
        a, b = set(sr), set(dr)
        return f"{len(a - b)} values differ: {sorted(a - b)[:3]} / {sorted(b - a)[:3]}"
    return None


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from casegrid.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark, con = local_session(), connect(folder)
    sqls, bad = oracle_sql(), []
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                verdict = compare(df, con, sqls[name])
            else:
                n = len(df.collect())
                verdict = None if n else "no rows"
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:700]}"
        kind = "sql" if name in sqls else "rows"
        print(f"{'ok  ' if verdict is None else 'BAD '} {name} [{kind}] {time.time() - start:.1f}s"
              + (f"\n     {verdict}" if verdict else ""), flush=True)
        if verdict:
            bad.append(name)
    print(f"bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
