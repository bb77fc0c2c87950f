"""Run queries and their SQL on the same tables and compare them.

    python tests/check_queries.py [sf folder] [query …]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs between a Spark frame and the SQL's result; empty when equal."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    kinds = {c[0]: KINDS.get(str(c[1]), str(c[1])) for c in result.description}
    if kinds != dict(spark_df.dtypes):
        return [f"types {sorted(set(dict(spark_df.dtypes).items()) ^ set(kinds.items()))}"]
    order = sorted(names)
    ours = [tuple(r) for r in spark_df.select(*order).collect()]
    place = [names.index(c) for c in order]
    theirs = [tuple(r[i] for i in place) for r in theirs]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]
    out = []
    for a, b in zip(sorted(ours, key=_key), sorted(theirs, key=_key), strict=True):
        if repr(a) != repr(b):  # to the last bit and the sign of zero
            out.append(f"{dict(zip(order, a, strict=True))} != {dict(zip(order, b, strict=True))}")
    return out


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from cadenza.session import local_session

    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, sql = local_session(cpus=8), duck(base), oracle_sql()
    wanted = sys.argv[2:] or list(queries())
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, base)
            if name in sql:
                found = differences(df, con, sql[name])
                state = "equal" if not found else f"DIFFERS {len(found)}: {found[:3]}"
            else:
                state = f"{len(df.collect())} rows, no SQL"
        except Exception as e:  # noqa: BLE001
            state = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {state}", flush=True)


if __name__ == "__main__":
    main()
