"""Compare every query with its SQL oracle: ``python tests/oracle_check.py [sf] [name ...]``.

With ``NO_BROADCAST=1`` every join side counts as too large to broadcast.
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = "/root/testdata"


def oracle_frame(sf_dir: str, sql: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection.execute(sql).to_arrow_table()


def _kind(dtype: str) -> str:
    dtype = dtype.replace(", tz=UTC", "").replace("large_string", "string")
    return {"json": "string", "extension<arrow.json>": "string"}.get(dtype, dtype)


def _normal(table) -> list[tuple]:
    frame = table.to_pandas(date_as_object=True).sort_index(axis=1)
    for column in frame:
        if isinstance(frame[column].dtype, pd.DatetimeTZDtype):
            frame[column] = frame[column].dt.tz_localize(None)
    rows = [
        tuple("NULL" if v is None or v != v else repr(float(v)) if isinstance(v, (int, float)) else str(v) for v in r)
        for r in frame.astype(object).itertuples(index=False)
    ]
    return sorted(rows)


def differences(spark_table, sql_table) -> list[str]:
    found = []
    ours = {f.name: _kind(str(f.type)) for f in spark_table.schema}
    theirs = {f.name: _kind(str(f.type)) for f in sql_table.schema}
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} != {sorted(theirs)}"]
    found += [f"type of {c}: {ours[c]} != {theirs[c]}" for c in ours if ours[c] != theirs[c]]
    left, right = _normal(spark_table), _normal(sql_table)
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        only = [r for r in left if r not in set(right)][:2], [r for r in right if r not in set(left)][:2]
        found.append(f"values differ: {only[0]} / {only[1]}")
    return found


def main() -> int:
    import __spark_entry__ as entry
    from tests.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    if os.environ.get("NO_BROADCAST"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name, run in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            table = run(spark, f"{TESTDATA}/sf{sf}").toArrow()
            spent = time.time() - start
            problems = (
                differences(table, oracle_frame(f"{TESTDATA}/sf{sf}", oracles[name])) if name in oracles else ["no oracle"]
            )
        except Exception as error:  # noqa: BLE001
            spent, problems = time.time() - start, [f"{type(error).__name__}: {str(error)[:600]}"]
            if wanted:
                traceback.print_exc()
        if problems:
            failed.append(name)
        print(f"{'FAIL' if problems else 'ok  '} {name} {spent:.1f}s", *problems, sep="\n       " if problems else "", flush=True)
    missing = sorted(set(oracles) - set(queries))
    print(f"{len(failed)} failed: {failed}; oracles without query: {missing}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
