"""Run queries against their SQL counterparts: ``python -m checks.compare [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

from checks import ORACLES, QUERIES
from stationloom.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]

    def cell(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
            return "~"
        if isinstance(x, pd.Timestamp):
            return str(x)[:19].replace(" 00:00:00", "")
        return str(x)

    return sorted(tuple(cell(x) for x in row) for row in pdf.astype(object).values)


def main(names: list[str]) -> int:
    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            ours = [tuple(x) for x in df.collect()]
            columns, types = df.columns, [t for _, t in df.dtypes]
            took = time.time() - start
            if name not in ORACLES:
                print(f"rows  {name} {len(ours)} rows {took:.2f}s")
                continue
            relation = con.sql(ORACLES[name])
            theirs = relation.fetchall()
            a = canonical(pd.DataFrame(ours, columns=columns, dtype=object))
            b = canonical(pd.DataFrame(theirs, columns=relation.columns, dtype=object))
            same_columns = sorted(columns) == sorted(relation.columns)
            if same_columns and a == b and len(a) > 0:
                kinds = dict(zip(relation.columns, map(str, relation.types)))
                pairs = {(t, kinds[c]) for c, t in zip(columns, types)}
                odd = [p for p in pairs if p not in SAME_TYPES]
                print(f"ok    {name} {len(a)} rows {took:.2f}s {odd or ''}")
            else:
                failed += 1
                print(f"DIFF  {name} {len(a)} / {len(b)} rows {took:.2f}s "
                      f"{sorted(columns)} / {sorted(relation.columns)}")
                in_a, in_b = set(a), set(b)
                only_a = [x for x in a if x not in in_b][:3]
                only_b = [x for x in b if x not in in_a][:3]
                print("   spark only:", only_a, "\n   sql only:  ", only_b)
        except Exception as exc:  # report and go on with the next query
            failed += 1
            print(f"ERROR {name}: {str(exc)[:600]}")
        sys.stdout.flush()
    print("failed:", failed)
    return failed


SAME_TYPES = {
    ("string", "VARCHAR"), ("double", "DOUBLE"), ("int", "INTEGER"),
    ("bigint", "BIGINT"), ("date", "DATE"), ("timestamp", "TIMESTAMP"),
    ("boolean", "BOOLEAN"),
}

if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
