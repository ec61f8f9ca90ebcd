"""Run registered queries next to their DuckDB SQL and compare the results.

    python tests/oracle.py [sf_dir] [name-part ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    out = df[sorted(df.columns)].copy()
    for c in out.columns:
        col = out[c]
        if len(col) and col.map(lambda v: type(v).__name__ == "Decimal").any():
            col = col.astype(float)
        if pd.api.types.is_bool_dtype(col) or pd.api.types.is_numeric_dtype(col):
            out[c] = col.astype(float)
        elif pd.api.types.is_datetime64_any_dtype(col):
            out[c] = col.astype("datetime64[us]").astype(str)
        else:
            out[c] = col.map(lambda v: None if v is None or v is pd.NaT else str(v))
    return out.sort_values(list(out.columns), na_position="last").reset_index(drop=True)


def compare(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    """None when equal, else a short description of the first difference."""
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} != {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} != {len(sql_pdf)}"
    a, b = canonical(spark_pdf), canonical(sql_pdf)
    for c in a.columns:
        if a[c].dtype != b[c].dtype:
            if a[c].isna().all() and b[c].isna().all():
                continue
            return f"column {c}: {a[c].dtype} != {b[c].dtype}"
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"column {c}: {int((~same).sum())} differ, first {a.loc[i].to_dict()} != {b.loc[i].to_dict()}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in sqls:
                print(f"rows {name:32s} {took:6.2f}s n={len(got)}", flush=True)
                continue
            diff = compare(got, con.execute(sqls[name]).df())
        except Exception as exc:  # report and go on with the next query
            took, diff = time.time() - start, f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name:32s} {took:6.2f}s {'n=%d' % len(got) if diff is None else diff}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
