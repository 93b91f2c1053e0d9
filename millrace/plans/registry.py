"""Registry of queries: the Spark function and its check SQL side by side."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import views
from millrace.session import prepare


@dataclass(frozen=True)
class Tables:
    """Loads the driver's tables by name from one directory."""

    spark: SparkSession
    directory: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        return views.VIEWS[name](self)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Registers ``fn(tables) -> DataFrame`` as ``name``.

    ``sql`` is DuckDB SQL that must give the same rows; ``uses`` names the
    views of :mod:`millrace.plans.views` put in front of it as CTEs.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(prepare(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = with_views(sql, uses)
        return fn

    return register


def with_views(sql: str, uses: tuple[str, ...]) -> str:
    """Prepends the CTEs of the views, in the order given."""
    body = sql.strip()
    if not uses:
        return body
    ctes = ",\n".join(f"{name} AS ({views.SQL[name].strip()})" for name in uses)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from millrace.plans import load_all

    load_all()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    from millrace.plans import load_all

    load_all()
    return dict(_ORACLES)
