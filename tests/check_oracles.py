"""Compare registered queries with their SQL: ``python tests/check_oracles.py [scale] [query ...]``."""

import sys
import time
import traceback
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402
from tests.conftest import make_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        values = frame[column]
        if str(values.dtype).startswith("datetime"):
            frame[column] = values.astype("datetime64[us]").astype(str)
        elif values.dtype == bool or str(values.dtype) == "boolean":
            frame[column] = values.astype(str)
        elif str(values.dtype).lower().startswith(("int", "float")):
            frame[column] = values.astype(float).round(6).map(lambda x: "None" if pd.isna(x) else repr(x))
        else:
            frame[column] = values.map(lambda x: "None" if x is None or x is pd.NA or x != x else str(x))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def main() -> None:
    scale = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    folder = f"/root/testdata/{scale}"
    spark = make_session()
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    names = sys.argv[2:] or list(entry.queries())
    bad = []
    for name in names:
        try:
            start = time.time()
            got = entry.queries()[name](spark, folder).toPandas()
            middle = time.time()
            want = connection.execute(entry.oracle_sql()[name]).df()
            end = time.time()
            a, b = normal(got), normal(want)
            same = list(a.columns) == list(b.columns) and a.shape == b.shape and bool((a == b).all().all())
            print(f"{'ok  ' if same else 'DIFF'} {name} rows {len(a)}/{len(b)} {middle - start:.1f}s sql {end - middle:.1f}s", flush=True)
            if not same:
                bad.append(name)
                if list(a.columns) != list(b.columns):
                    print("   columns", list(a.columns), list(b.columns))
                else:
                    only = a.merge(b, how="outer", indicator=True).query("_merge != 'both'")
                    print(only.head(8).to_string(max_colwidth=60))
        except Exception as error:
            bad.append(name)
            print("FAIL", name, type(error).__name__, str(error)[:600].replace("\n", " | "), flush=True)
            if "-v" in sys.argv:
                traceback.print_exc()
    print("bad:", bad)


if __name__ == "__main__":
    main()
