"""Run registered queries in Spark and their DuckDB oracle; compare results.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.  Comparison is
order-insensitive over column-name-sorted rows: row count, column names, type
family, and values (exact, with a float-tolerant fallback that is reported).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, tol: bool):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}" if tol else repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v != 0 else "0"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x, tol) for x in v) + "]"
    return str(v)


def rows_of(names, rows, tol):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i], tol) for i in order) for r in rows)


def family(t: str) -> str:
    t = t.lower()
    for k, fam in [("decimal", "decimal"), ("double", "float"), ("float", "float"),
                   ("real", "float"), ("bigint", "int"), ("hugeint", "int"),
                   ("smallint", "int"), ("tinyint", "int"), ("int", "int"),
                   ("bool", "bool"), ("timestamp", "ts"), ("date", "date"),
                   ("string", "str"), ("varchar", "str"), ("array", "list"), ("[]", "list")]:
        if k in t:
            return fam
    return t


def exact_type(t: str) -> str:
    """DuckDB type name → Spark simpleString (for the strict schema report)."""
    t = t.strip()
    m = {"INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "smallint", "TINYINT": "tinyint",
         "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean",
         "DATE": "date", "TIMESTAMP": "timestamp_ntz", "HUGEINT": "hugeint",
         "TIMESTAMP WITH TIME ZONE": "timestamp"}
    if t.endswith("[]"):
        return f"array<{exact_type(t[:-2])}>"
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return m.get(t, t.lower())


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_names = df.columns
    s_types = [f.dataType.simpleString() for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, status="rows-only", rows=len(s_rows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_types = [str(d[1]) for d in res.description]
    d_rows = res.fetchall()
    out = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows), spark_s=round(t1 - t0, 2))
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns differ: spark-only {sorted(set(s_names) - set(d_names))} "
                        f"oracle-only {sorted(set(d_names) - set(s_names))}")
    else:
        st = dict(zip(s_names, s_types))
        dtp = dict(zip(d_names, d_types))
        bad = [(c, st[c], dtp[c]) for c in s_names if family(st[c]) != family(dtp[c])]
        if bad:
            problems.append(f"types differ: {bad}")
        strict = [(c, st[c], exact_type(dtp[c])) for c in s_names
                  if st[c] != exact_type(dtp[c])]
        if strict:
            out["strict_type_diffs"] = strict
        exact = rows_of(s_names, s_rows, False) == rows_of(d_names, d_rows, False)
        if not exact:
            if rows_of(s_names, s_rows, True) == rows_of(d_names, d_rows, True):
                problems.append("float-only differences")
            else:
                a = set(rows_of(s_names, s_rows, True))
                b = set(rows_of(d_names, d_rows, True))
                cols = sorted(s_names)
                problems.append(f"values differ; cols={cols}; spark-only e.g. "
                                f"{sorted(a - b)[:2]} oracle-only e.g. {sorted(b - a)[:2]}")
    out["status"] = "ok" if not problems else "; ".join(problems)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from starwright.session import build_session, checkpoint_dir

    spark = build_session("oracle-compare", cpus=8, shuffle_partitions=8)
    checkpoint_dir(spark)
    con = duck(sf_dir)
    qs = E.queries()
    oracles = E.oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, status=f"ERROR {type(e).__name__}: {str(e)[:400]}")
        if r["status"] not in ("ok", "rows-only"):
            failed += 1
        print(r, flush=True)
    print(f"FAILED {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
