"""Compare registered queries with their SQL counterparts: rows, columns and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return None if x is None else str(x)


def normalized(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=lambda r: [(c is None, c or "") for c in r])


def difference(spark_df, con, sql: str) -> str | None:
    got_cols, got = normalized(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want_cols, want = normalized([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    unequal = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(unequal)} unequal rows, first {unequal[0]}" if unequal else None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as contract
    from conftest import make_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(contract.queries())
    spark, con, oracles = make_session(), connect(sf_dir), contract.oracle_sql()
    for name in names:
        start = time.time()
        try:
            df = contract.queries()[name](spark, sf_dir)
            if name in oracles:
                note = difference(df, con, oracles[name]) or "ok"
            else:
                note = f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the other queries
            note = f"{type(error).__name__}: {str(error)[-1500:] if "Python" in type(error).__name__ else str(error)[:700]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {note}", flush=True)


if __name__ == "__main__":
    main()
