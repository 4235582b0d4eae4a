"""Named queries over the TPC-H-like tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from framestore.session import shared_folder
from framestore.store import TableStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """The input tables in a folder of Parquet files."""

    spark: SparkSession
    folder: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def in_sql(self, name: str) -> str:
        """Table expression to use in SQL text."""
        return f"parquet.`{self.path(name)}`"

    def store(self) -> TableStore:
        """A new database for tables that a query writes."""
        name = f"framestore_{uuid.uuid4().hex}"
        return TableStore(self.spark, name, location=f"{shared_folder(self.spark)}/{name}")


def query(oracle: str | None = None, name: str | None = None):
    """Register the function under its name, with the SQL that gives the same rows."""

    def add(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, folder))

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return add
