"""Run registered queries and their SQL side by side.

    python tests/oracle.py [folder of tables] [query ...]
"""

import datetime
import decimal
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value) if value % 1 else int(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def rows_of(columns, rows):
    """Rows with their columns by name, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, db, folder, name, query, sql):
    """None when both sides agree, else what differs."""
    frame = query(spark, folder)
    got = rows_of(frame.columns, frame.collect())
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = {d[0]: str(d[1]) for d in result.description}
    for column, kind in frame.dtypes:
        if kinds.get(kind, kind) != types[column]:
            return f"{column} is {kind} against {types[column]}"
    if got != expected:
        only = [r for r in got if r not in set(expected)][:3], [r for r in expected if r not in set(got)][:3]
        return f"{len(got)} rows against {len(expected)}; only here {only[0]}; only in SQL {only[1]}"
    if not got:
        return "no rows: the comparison says nothing"
    return None


if __name__ == "__main__":
    from dayloom.plans.queries import QUERIES, SQL
    from dayloom.session import build_session

    tables = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    session = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    database = connect(tables)
    failures = 0
    for wanted_name in wanted:
        start = time.time()
        try:
            fault = compare(session, database, tables, wanted_name, QUERIES[wanted_name], SQL[wanted_name])
        except Exception as error:  # report every query
            fault = f"{type(error).__name__}: {str(error)[:700]}"
        failures += fault is not None
        print(f"{'ok  ' if fault is None else 'FAIL'} {wanted_name:34} {time.time() - start:6.2f}s {fault or ''}", flush=True)
    print(f"{len(wanted) - failures} of {len(wanted)} agree")
