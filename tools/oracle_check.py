"""Run registered queries on Spark and their oracles on DuckDB, and compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]

Comparison: column names (sorted), row count, and the multiset of rows after
normalising floats to 6 places and NaN to NULL.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)


_SPARK_TYPES = {"ByteType": "int8", "ShortType": "int16", "IntegerType": "int32",
                "LongType": "int64", "FloatType": "float32", "DoubleType": "float64",
                "StringType": "string", "BooleanType": "bool", "TimestampType": "timestamp",
                "TimestampNTZType": "timestamp", "DateType": "date", "BinaryType": "binary"}
_DUCK_TYPES = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64",
               "HUGEINT": "int128", "FLOAT": "float32", "DOUBLE": "float64", "VARCHAR": "string",
               "BOOLEAN": "bool", "TIMESTAMP": "timestamp", "DATE": "date", "BLOB": "binary"}


def spark_types(df) -> dict:
    return {f.name: _SPARK_TYPES.get(type(f.dataType).__name__, str(f.dataType))
            for f in df.schema.fields}


def duck_types(rel) -> dict:
    return {n: _DUCK_TYPES.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None):
    from gridmeter.catalog import oracle_sql, queries
    qs, os_ = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sq = qs[name](spark, sf_dir)
            stypes = spark_types(sq)
            sdf = sq.toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        ts = time.time() - t0
        if name not in os_:
            results[name] = f"rows-only {len(sdf)} ({ts:.1f}s)"
            continue
        try:
            rel = con.sql(os_[name])
            otypes = duck_types(rel)
            odf = rel.df()
        except Exception as e:  # noqa: BLE001
            results[name] = f"ORACLE ERROR {str(e)[:300]}"
            continue
        if stypes != otypes:
            diff = {k: (stypes.get(k), otypes.get(k)) for k in set(stypes) | set(otypes)
                    if stypes.get(k) != otypes.get(k)}
            results[name] = f"TYPES differ {diff}"
            continue
        sc, sr = _rows(sdf)
        oc, orows = _rows(odf)
        if sc != oc:
            results[name] = f"COLUMNS {sc} vs {oc}"
        elif len(sr) != len(orows):
            results[name] = f"ROWCOUNT spark={len(sr)} oracle={len(orows)}"
        elif sr != orows:
            diff = [(a, b) for a, b in zip(sr, orows) if a != b][:3]
            results[name] = f"VALUES differ ({len(sr)} rows) e.g. {diff}"
        else:
            results[name] = f"ok {len(sr)} rows ({ts:.1f}s)"
    return results


def main():
    from gridmeter.session import get_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf_dir, names)
    bad = 0
    for k, v in res.items():
        print(f"{k:28s} {v}")
        bad += not (v.startswith("ok") or v.startswith("rows-only"))
    print(f"{len(res) - bad}/{len(res)} ok")


if __name__ == "__main__":
    main()
