"""Compare a Spark query with its SQL oracle, and inspect physical plans.

The comparison is order-insensitive: both results become pandas frames with
columns sorted by name, values normalised (timestamps to naive UTC,
floats rounded), rows sorted, then compared for row count, column names and
a hash of the values.  Plan helpers read ``explain`` text only.
"""

from __future__ import annotations

import contextlib
import hashlib
import io
import json
import sys
import time
from collections.abc import Iterable

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        s = pdf[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            if getattr(s.dt, "tz", None) is not None:
                s = s.dt.tz_convert("UTC").dt.tz_localize(None)
            pdf[c] = s.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(s):
            pdf[c] = s.round(6)
        elif pd.api.types.is_bool_dtype(s):
            pdf[c] = s.astype(bool)
        else:
            pdf[c] = s.map(lambda v: None if v is None or (isinstance(v, float) and pd.isna(v)) else v)
    pdf = pdf.astype(str)
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def value_hash(pdf: pd.DataFrame) -> str:
    h = hashlib.sha256()
    for row in _norm(pdf).itertuples(index=False):
        h.update("\x1f".join(row).encode())
        h.update(b"\x1e")
    return h.hexdigest()


def compare(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    a = spark_df.toPandas()
    b = con.execute(sql).df()
    res = {
        "rows_spark": len(a), "rows_oracle": len(b),
        "cols_spark": sorted(a.columns), "cols_oracle": sorted(b.columns),
    }
    res["rows_match"] = len(a) == len(b)
    res["cols_match"] = res["cols_spark"] == res["cols_oracle"]
    res["values_match"] = res["cols_match"] and value_hash(a) == value_hash(b)
    if res["cols_match"] and not res["values_match"]:
        na, nb = _norm(a), _norm(b)
        diff = pd.concat([na.assign(_src="spark"), nb.assign(_src="oracle")]).drop_duplicates(
            subset=list(na.columns), keep=False)
        res["diff_sample"] = diff.head(6).to_dict("records")
    return res


def check_all(spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None) -> dict:
    from eventide.plans.catalog import ORACLE_SQL, QUERIES
    con = duck(sf_dir)
    out = {}
    for name in names or QUERIES:
        t = time.time()
        try:
            r = compare(QUERIES[name](spark, sf_dir), con, ORACLE_SQL[name])
        except Exception as e:  # report and go on with the next query
            r = {"error": f"{type(e).__name__}: {str(e)[:400]}"}
        r["sec"] = round(time.time() - t, 2)
        out[name] = r
    return out


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def single_partition_exchanges(df: DataFrame) -> int:
    """Number of ``Exchange SinglePartition`` nodes in the physical plan."""
    return plan_text(df).count("SinglePartition")


if __name__ == "__main__":
    from eventide.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    sp = get_session("local[8]", shuffle_partitions=8)
    results = check_all(sp, sf, names)
    ok = 0
    for k, v in results.items():
        good = v.get("values_match") and v.get("rows_match")
        ok += bool(good)
        print(("OK  " if good else "BAD ") + k, json.dumps(v, default=str)[:600])
    print(f"{ok}/{len(results)} match")
