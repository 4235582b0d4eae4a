"""Tables of a relational database through Spark's JDBC source.

Any JDBC URL works if its driver jar is on the class path. Reads run in parallel
when a numeric, date or timestamp column to split by is given.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from framestore.errors import InvalidInputError, LoadTableError, SaveDataFrameError
from framestore.operators.upsert import upsert
from framestore.session import delete_path, stage
from framestore.sources.load import shape_rows
from framestore.validation import check_chunksize, check_table_name, is_table_name


@dataclass(frozen=True)
class JdbcSource:
    """A database: JDBC URL, driver class and further options (user, password, ...)."""

    url: str
    driver: str | None = None
    options: dict[str, str] = field(default_factory=dict, repr=False)

    def base_options(self) -> dict[str, str]:
        options = {"url": self.url, **self.options}
        if self.driver:
            options["driver"] = self.driver
        return options

    def read_options(
        self,
        sql: str,
        partition_column: str | None = None,
        lower_bound: Any = None,
        upper_bound: Any = None,
        num_partitions: int | None = None,
        fetchsize: int | None = None,
    ) -> dict[str, str]:
        """Options of a read. `sql` is a table name or a query."""
        options = self.base_options()
        splits = (partition_column, lower_bound, upper_bound, num_partitions)
        if any(s is not None for s in splits):
            if any(s is None for s in splits):
                raise InvalidInputError(
                    "A parallel read needs partition_column, lower_bound, upper_bound and num_partitions", data=splits
                )
            options.update(
                partitionColumn=partition_column,
                lowerBound=str(lower_bound),
                upperBound=str(upper_bound),
                numPartitions=str(num_partitions),
            )
        query = sql.strip().rstrip(";").strip()
        if is_table_name(query):
            options["dbtable"] = query
        elif "partitionColumn" in options:
            # Spark splits tables, and takes a query as one in this form.
            options["dbtable"] = f"({query}) source_query"
        else:
            options["query"] = query
        if check_chunksize(fetchsize) is not None:
            options["fetchsize"] = str(fetchsize)
        return options

    def read(self, spark: SparkSession, sql: str, columns: Sequence[str] | None = None, **kwargs: Any) -> DataFrame:
        """The lazy rows of a table or query; columns and filters are pushed down."""
        try:
            df = spark.read.format("jdbc").options(**self.read_options(sql, **kwargs)).load()
            return df.select(*columns) if columns is not None and is_table_name(sql) else df
        except InvalidInputError:
            raise
        except Exception as e:
            raise LoadTableError(f"Cannot load {sql!r}: {e}", data=(e.args, sql)) from None

    def load_table(
        self,
        spark: SparkSession,
        sql: str,
        columns: Sequence[str] | None = None,
        read: dict[str, Any] | None = None,
        **options: Any,
    ) -> DataFrame:
        """Read a table or query and apply the load options of `shape_rows`."""
        return shape_rows(self.read(spark, sql, columns, **(read or {})), **options)

    def write_options(
        self, table: str, if_exists: str, chunksize: int | None = None, column_types: str | None = None
    ) -> tuple[str, dict[str, str]]:
        """Save mode and options of a write; 'replace' keeps the table definition."""
        options = {**self.base_options(), "dbtable": check_table_name(table)}
        modes = {"append": "append", "replace": "overwrite", "drop-replace": "overwrite", "fail": "errorifexists"}
        if if_exists not in modes:
            raise InvalidInputError(f"Invalid if_exists = {if_exists!r}", data=if_exists)
        if if_exists == "replace":
            options["truncate"] = "true"
        if check_chunksize(chunksize) is not None:
            options["batchsize"] = str(chunksize)
        if column_types:
            options["createTableColumnTypes"] = column_types
        return modes[if_exists], options

    def write(self, df: DataFrame, table: str, if_exists: str = "append", **kwargs: Any) -> None:
        """Write `df`, one connection per partition."""
        mode, options = self.write_options(table, if_exists, **kwargs)
        try:
            df.write.format("jdbc").options(**options).mode(mode).save()
        except Exception as e:
            raise SaveDataFrameError(f"Cannot save to {table}: {e}", data=e.args) from None

    def delete_all(self, spark: SparkSession, table: str) -> None:
        """Delete all rows of `table` and keep its definition."""
        schema = self.read(spark, table).schema
        self.write(spark.createDataFrame([], schema), table, "replace")

    def upsert(
        self,
        df: DataFrame,
        table: str,
        where_cols: str | Sequence[str],
        read: dict[str, Any] | None = None,
        chunksize: int | None = None,
        **kwargs: Any,
    ) -> None:
        """Upsert `df` into `table`, for tables that may be rewritten as a whole.

        The new rows are computed by Spark and staged in the shared folder before
        the table is truncated and written. `read` are options of the parallel
        read, `chunksize` is the batch size, `kwargs` go to `operators.upsert`.
        """
        target = self.read(df.sparkSession, check_table_name(table), **(read or {}))
        staged, path = stage(upsert(target, df, where_cols, **kwargs), "jdbc")
        self.write(staged, table, "replace", chunksize=chunksize)
        delete_path(df.sparkSession, path)
