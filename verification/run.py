"""Compare registered queries with their oracle: ``python -m verification.run [sf] [name part ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session(cores: int = 8) -> SparkSession:
    return (SparkSession.builder.master(f"local[{cores}]").appName("aeroloom-check")
            .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(pdf: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows sorted, values as text: order and dtype no longer matter."""
    out = pd.DataFrame(index=range(len(pdf)))
    for c in sorted(pdf.columns):
        s = pdf[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            text = pd.to_datetime(s).dt.strftime("%Y-%m-%d %H:%M:%S.%f")
        elif pd.api.types.is_float_dtype(s):
            text = s.map(lambda v: None if pd.isna(v) else repr(float(v) + 0.0))
        else:
            text = s.map(lambda v: None if v is None or v is pd.NaT or (not hasattr(v, "__len__") and pd.isna(v)) else _text(v))
        out[c] = text.astype(object).where(text.notna(), None).values
    return out.sort_values(list(out.columns), na_position="first").reset_index(drop=True) if len(out.columns) else out


def _number(text):
    """Number behind a short text, so that 5 equals 5.0; None for any other text."""
    try:
        return float(text) if text is not None and len(text) < 40 else None
    except ValueError:
        return None


def _text(v) -> str:
    if isinstance(v, pd.Timestamp) or hasattr(v, "hour"):
        return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S.%f")
    if hasattr(v, "year"):
        return f"{v} 00:00:00.000000"
    if isinstance(v, float):
        return repr(v + 0.0) if v != int(v) else repr(float(v))
    return str(v)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            same |= pd.Series([_number(x) is not None and _number(x) == _number(y) for x, y in zip(a[c], b[c])])
        if not same.all():
            i = same[~same].index[0]
            return f"{(~same).sum()} values differ in {c}, first {a[c][i]!r} != {b[c][i]!r} in {dict(a.loc[i])} / {dict(b.loc[i])}"
    return ""


def main() -> int:
    sf, parts = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    from verification.catalog import ORACLES, QUERIES

    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, bad = session(), duck(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name, build in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        began = time.time()
        try:
            got = build(spark, sf_dir).toPandas()
            took = time.time() - began
            if name not in ORACLES:
                note = f"rows only: {len(got)}" + ("" if len(got) else " EMPTY")
            else:
                diff = compare(got, con.execute(ORACLES[name]).fetchdf())
                bad += bool(diff)
                note = f"FAIL {diff}"[:900] if diff else f"ok {len(got)}" + ("" if len(got) else " EMPTY")
        except Exception as e:
            bad, took = bad + 1, time.time() - began
            note = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        print(f"{took:6.2f}s {name}: {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
