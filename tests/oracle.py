"""Compares registered queries with DuckDB: ``python -m tests.oracle [sf] [names…]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    """A value in a form both engines share and that sorts."""
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return (2, "nan") if math.isnan(number) else (2, f"{number:.9g}" if number != int(number) else str(int(number)))
    if isinstance(value, (list, tuple)):
        return (3, str([plain(v) for v in value]))
    if isinstance(value, (bytes, bytearray)):
        return (4, bytes(value).hex())
    return (5, str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


FAMILIES = {"tinyint": "int", "smallint": "int", "integer": "int", "bigint": "int", "int": "int", "varchar": "string", "float": "float", "double": "float"}


def compare(spark, connection, fn, sql, sf_dir):
    """None when equal, else what differs; also the row count and the types of both sides."""
    frame = fn(spark, sf_dir)
    spark_columns, spark_rows = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    types = {d[0]: str(d[1]).lower() for d in result.description}
    duck_columns, duck_rows = canonical([d[0] for d in result.description], result.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} / {duck_columns}", len(spark_rows)
    for field in frame.schema:
        got = field.dataType.simpleString()
        want = types[field.name]
        if want in ("hugeint",) or (want in FAMILIES and FAMILIES.get(got, got) != FAMILIES[want]):
            return f"type of {field.name}: {got} / {want}", len(spark_rows)
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} / {len(duck_rows)}", len(spark_rows)
    for mine, theirs in zip(spark_rows, duck_rows):
        if mine != theirs:
            return f"{spark_columns}\n   spark {mine}\n   duck  {theirs}", len(spark_rows)
    return None, len(spark_rows)


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from millrace.session import local_session

    sf_dir = f"/root/testdata/sf{argv[0]}" if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = local_session(8)
    connection = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begin = time.time()
        try:
            if name in oracles:
                problem, rows = compare(spark, connection, fn, oracles[name], sf_dir)
                mark = "same"
            else:
                problem, rows, mark = None, len(fn(spark, sf_dir).collect()), "rows"
        except Exception as error:  # the report goes on with the next query
            problem, rows = str(error)[:1500], -1
        failed += problem is not None
        print(f"{'FAIL' if problem else mark} {name} rows={rows} {time.time() - begin:.1f}s {problem or ''}", flush=True)
    print("failed:", failed, "of", len(queries), "oracles:", len(oracles))
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
