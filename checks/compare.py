"""Run every query next to its oracle: python -m checks.compare FOLDER [name ...]"""

import sys
import time

import duckdb
import pandas as pd

from repopulse.session import build_session

from .oracle import ORACLE
from .queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def comparable(frame: pd.DataFrame) -> list[tuple]:
    """Rows as text, in an order that does not depend on the engine."""

    def text(value) -> str:
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return "null"
        if isinstance(value, bool):
            return str(value)
        if isinstance(value, float):
            return f"{value:.9g}"
        return str(value)

    columns = sorted(frame.columns)
    return sorted(tuple(text(value) for value in row) for row in frame[columns].itertuples(index=False))


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> pd.DataFrame:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    return pd.DataFrame(cursor.fetchall(), columns=names, dtype=object)


def spark_rows(df) -> pd.DataFrame:
    return pd.DataFrame([tuple(row) for row in df.collect()], columns=df.columns, dtype=object)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    left, right = comparable(ours), comparable(theirs)
    if left == right:
        return None
    only_left = sorted(set(left) - set(right))[:3]
    only_right = sorted(set(right) - set(left))[:3]
    return f"{len(left)} and {len(right)} rows; only Spark {only_left}; only SQL {only_right}"


def main(folder: str, names: list[str]) -> int:
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in names or QUERIES:
        started = time.time()
        ours = spark_rows(QUERIES[name](spark, folder))
        seconds = time.time() - started
        problem = None
        if name in ORACLE:
            problem = difference(ours, oracle_rows(con, ORACLE[name]))
        verdict = "DIFFERENT " + problem if problem else "equal" if name in ORACLE else "rows only"
        failed += problem is not None
        print(f"{name:28} {len(ours):8} rows {seconds:6.1f} s  {verdict[:600]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
