"""JDBC scans.

The database URL is a parameter. Where none is configured
(``spark.millrace.jdbc.url``), the queries use an embedded in-memory database that
only the process of a local session sees; on a cluster the setting is required.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

URL_SETTING = "spark.millrace.jdbc.url"


def configured_url(spark: SparkSession) -> str:
    url = spark.conf.get(URL_SETTING, None)
    if url:
        return url
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {URL_SETTING} to a database that all executors reach")
    return "jdbc:derby:memory:millrace;create=true"


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """Whole table with the schema the database reports."""
    return spark.read.jdbc(url, table, properties=properties or {})


def read_query(spark: SparkSession, url: str, query: str, properties: dict | None = None) -> DataFrame:
    """Rows of a query that the database runs."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**(properties or {})).load()


def read_partitioned(
    spark: SparkSession, url: str, table: str, column: str, rows_per_range: int = 1_000_000, properties: dict | None = None
) -> DataFrame:
    """Parallel scan in ranges of ``column``.

    The database tells the smallest and the largest value and the number of rows, from which
    the bounds and the number of ranges come; they split the rows and drop none.
    """
    facts = f'SELECT MIN("{column}") AS "low", MAX("{column}") AS "high", COUNT(*) AS "n" FROM {table}'
    low, high, n = read_query(spark, url, facts, properties).first()
    if not n or low is None:
        return read_table(spark, url, table, properties)
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=low,
        upperBound=high + 1,
        numPartitions=-(-n // rows_per_range),
        properties=properties or {},
    )


CELLS = 64


def even_ranges(
    spark: SparkSession, url: str, table: str, column: str, rows_per_range: int, properties: dict | None = None
) -> list[tuple[int, int, int]]:
    """Ranges [low, high) of a whole-number column with their rows, each of about ``rows_per_range``, however uneven the ids.

    The database counts the rows of equal cells; a cell with too many is cut into cells again, so only dense parts are
    looked at closely. Neighbours are then put together. A single id with more rows than wanted is a range of its own.
    """
    quoted = f'"{column}"'
    facts = f'SELECT MIN({quoted}) AS "low", MAX({quoted}) AS "high", COUNT({quoted}) AS "n" FROM {table}'
    low, high, n = read_query(spark, url, facts, properties).first()
    if not n:
        return []
    cells, heavy = [], [(int(low), int(high) + 1, int(n))]
    while heavy:
        begin, end, rows = heavy.pop()
        if 2 * rows <= rows_per_range or end - begin == 1:
            cells.append((begin, end, rows))
            continue
        width = -(-(end - begin) // CELLS)
        counts = (
            f'SELECT ({quoted} - {begin}) / {width} AS "cell", COUNT(*) AS "n" FROM {table} '
            f"WHERE {quoted} >= {begin} AND {quoted} < {end} GROUP BY ({quoted} - {begin}) / {width}"
        )
        for cell, held in read_query(spark, url, counts, properties).collect():
            first = begin + int(cell) * width
            heavy.append((first, min(first + width, end), int(held)))
    ranges: list[tuple[int, int, int]] = []
    for begin, end, rows in sorted(cells):
        if ranges and ranges[-1][2] + rows <= rows_per_range:
            ranges[-1] = (ranges[-1][0], end, ranges[-1][2] + rows)
        else:
            ranges.append((begin, end, rows))
    return ranges


def read_even(
    spark: SparkSession, url: str, table: str, column: str, rows_per_range: int = 1_000_000, properties: dict | None = None
) -> DataFrame:
    """Parallel scan in ranges of as many rows each, for ids that lie in clusters. Rows without an id come as one range.

    The ranges are taken before the scan: rows that come between them meanwhile are read too, as the first and the last
    range have no outer end and ranges leave no gap.
    """
    cuts = [begin for begin, _, _ in even_ranges(spark, url, table, column, rows_per_range, properties)][1:]
    if not cuts:
        return read_table(spark, url, table, properties)
    quoted = f'"{column}"'
    predicates = [f"{quoted} < {cuts[0]}"]
    predicates += [f"{quoted} >= {a} AND {quoted} < {b}" for a, b in zip(cuts, cuts[1:])]
    predicates += [f"{quoted} >= {cuts[-1]}", f"{quoted} IS NULL"]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
