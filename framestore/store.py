"""`TableStore`: load, save, upsert, merge and execute on the tables of a Spark catalog."""

from __future__ import annotations

import copy
import logging
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from framestore.errors import (
    DeleteFromTableError,
    ExecuteStatementError,
    FramestoreError,
    InvalidInputError,
    LoadTableError,
    SaveDataFrameError,
    SourceNotFoundError,
    SQLStatementNotSupportedError,
    TableExistsError,
)
from framestore.functions.datetimes import DEFAULT_FORMAT, convert_datetime_columns
from framestore.functions.nulls import nan_to_null
from framestore.functions.parsing import cast_columns
from framestore.functions.project import pick
from framestore.operators.changes import CHANGE, INSERTED, SAME, UPDATED, Changes
from framestore.operators.checks import Constraints, ForeignKey, enforce, referenced_keys_gone, repeated_keys, unique_violations
from framestore.operators.chunks import POSITION, iter_chunks, with_positions
from framestore.operators.keyed import align_types, hot_keys, quoted, spread_join
from framestore.operators.merge import merge_changes
from framestore.operators.params import check_value
from framestore.operators.statements import KeyedStatement, keyed_statement
from framestore.operators.upsert import upsert_changes
from framestore.session import delete_path, stage
from framestore.sinks.journal import data_files, read_ledger, write_ledger
from framestore.sinks.publish import (
    MAX_RECORDS,
    balanced,
    finish_change,
    has_plain_files,
    insert_overwrite,
    is_applied,
    replace_files,
    replace_partitions,
    replace_rows,
    rows_of_files,
    session_options,
    table_info,
    to_layout,
    touched_files,
    touched_partitions,
    vacuum,
)
from framestore.sources.load import keys_first, shape_rows
from framestore.validation import (
    as_list,
    check_choice,
    check_chunksize,
    check_columns,
    check_table_name,
    is_table_name,
)

logger = logging.getLogger(__name__)

IF_EXISTS = ("append", "replace", "drop-replace", "fail")
REWRITE = ("table", "files")
_INSERT_VALUES = re.compile(
    r"\s*INSERT\s+INTO\s+(?P<table>\S+?)\s*\((?P<columns>[^()]*)\)\s*VALUES\s*\((?P<binds>[^()]*)\)\s*;?\s*",
    re.IGNORECASE,
)


@dataclass(frozen=True)
class ChangeCounts:
    """Rows of a whole upsert or merge run."""

    rows_matched: int = 0
    rows_changed: int = 0
    rows_inserted: int = 0
    rows_deleted: int = 0


class TableStore:
    """Tables of one database (schema) of the Spark catalog.

    `must_exist` fails with `SourceNotFoundError` if the database is absent;
    without it the database is created when it is missing, at `location` if given.
    """

    def __init__(
        self,
        spark: SparkSession,
        database: str | None = None,
        must_exist: bool = False,
        location: str | None = None,
    ) -> None:
        self.spark = spark
        self.database = None if database is None else check_table_name(database)
        self.foreign_keys = False
        self._constraints: dict[str, Constraints] = {}
        if self.database is not None and not spark.catalog.databaseExists(self.database):
            if must_exist:
                raise SourceNotFoundError(f"Database {database} does not exist", data=database)
            where = f" LOCATION '{location}'" if location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{where}")

    def with_session(self, spark: SparkSession) -> TableStore:
        """The same store on another session of the application."""
        other = copy.copy(self)
        other.spark = spark
        return other

    # Names and rules ------------------------------------------------------------

    def qualified(self, table: str, schema: str | None = None) -> str:
        """Name of `table` with its database."""
        check_table_name(table)
        database = schema or self.database
        return f"{database}.{table}" if database and "." not in table else table

    def exists(self, table: str, schema: str | None = None) -> bool:
        return self.spark.catalog.tableExists(self.qualified(table, schema))

    def declare(self, table: str, constraints: Constraints) -> None:
        """Set the rules of `table`; they are checked before rows are published."""
        self._constraints[self.qualified(table)] = constraints

    def manage_foreign_keys(self, action: str = "ON") -> None:
        """Switch the check of foreign keys 'ON' or 'OFF' (the initial state)."""
        self.foreign_keys = check_choice("action", action, ("ON", "OFF")) == "ON"

    def _parents(self, constraints: Constraints) -> dict[str, DataFrame]:
        if not self.foreign_keys:
            return {}
        return {fk.parent: self.spark.table(self.qualified(fk.parent)) for fk in constraints.foreign_keys}

    def _references(self, name: str) -> list[tuple[str, ForeignKey]]:
        """The foreign keys that refer to a table, with the table that has them, if they are to be checked."""
        if not self.foreign_keys:
            return []
        rules = self._constraints.items()
        found = [(child, fk) for child, r in rules for fk in r.foreign_keys if self.qualified(fk.parent) == name]
        return [(child, fk) for child, fk in found if self.spark.catalog.tableExists(child)]

    def _enforce_references(
        self, name: str, removed: DataFrame, after: DataFrame | None, error: type[FramestoreError], columns: Sequence[str] | None = None
    ) -> None:
        """Raise `error` if a row refers to one of the `removed` rows of the table and `after`, its new rows, has no other one for it.

        Of the foreign keys only those that refer to one of `columns`, if given, are looked at. A table that refers to itself is taken as it is after the change.
        """
        found: dict[str, tuple[int, list[dict]]] = {}
        for child, fk in self._references(name):
            if columns is not None and not set(fk.parent_columns) & set(columns):
                continue
            rows = self.spark.table(child) if child != name else after
            if rows is None:
                continue
            orphans = referenced_keys_gone(rows, fk.columns, removed, after, fk.parent_columns)
            sample = [r.asDict(True) for r in orphans.limit(20).collect()]
            if sample:
                found[f"FOREIGN KEY({', '.join(fk.columns)}) of {child} REFERENCES {fk.parent}"] = (orphans.count(), sample)
        if found:
            raise error(f"Constraint violations: { {rule: n for rule, (n, _) in found.items()} }", data=found)

    # Execute --------------------------------------------------------------------

    def execute(
        self, sql: str, params: dict[str, Any] | Sequence[dict[str, Any]] | DataFrame | None = None
    ) -> DataFrame:
        """Run a SQL statement, with `:name` bind parameters in `params`.

        For many parameter sets give a list of dicts or a DataFrame. The statement
        then runs once, as a set: ``INSERT INTO t (...) VALUES (:a, :b)``
        with binds only, ``UPDATE t SET c = :c, ... WHERE k = :k AND ...`` or ``DELETE FROM t WHERE k = :k AND ...``
        (see `operators.statements`), or any statement that reads its parameters from
        ``{params}`` like a table. UPDATE and DELETE keep to the declared rules. The last set of a list counts for
        its key; a DataFrame has no order, so its keys must not repeat. UPDATE returns the
        matched rows in `num_affected_rows`.
        """
        if not isinstance(sql, str):
            raise InvalidInputError(f"sql must be a string, got {type(sql)}", data=sql)
        try:
            if params is None or isinstance(params, dict):
                return self.spark.sql(sql, args=params)
            return self._execute_many(sql, params)
        except FramestoreError:
            raise
        except Exception as e:
            raise ExecuteStatementError(f"{type(e).__name__}: {e}", data=e.args) from None

    def _execute_many(self, sql: str, params: Sequence[dict[str, Any]] | DataFrame) -> DataFrame:
        order = None
        if not isinstance(params, DataFrame):
            names = list(dict.fromkeys(n for p in params for n in p))
            order = "__set"
            rows = [(*[check_value(p.get(n)) for n in names], k) for k, p in enumerate(params)]
            params = self.spark.createDataFrame(rows, [*names, order], samplingRatio=1.0)
        if "{params}" in sql:
            return self.spark.sql(sql, params=params if order is None else params.drop(order))
        insert = _INSERT_VALUES.fullmatch(sql)
        statement = keyed_statement(self.spark, sql) if insert is None else None
        if statement is not None:
            return self._execute_keyed(statement, params, order)
        if insert is None:
            raise InvalidInputError(
                "With many parameter sets the statement must be INSERT INTO t (...) VALUES (:a, ...), UPDATE or DELETE "
                "or read its parameters from {params}",
                data=sql,
            )
        columns = [c.strip() for c in insert["columns"].split(",")]
        binds = [b.strip() for b in insert["binds"].split(",")]
        if len(columns) != len(binds) or not all(re.fullmatch(r":\w+", b) for b in binds):
            raise InvalidInputError("Each column needs one bind parameter", data=sql)
        check_columns([b[1:] for b in binds], params.columns, "parameters")
        rows = params.select(*[quoted(b[1:]).alias(c) for c, b in zip(columns, binds)])
        return self.spark.sql(f"INSERT INTO {insert['table']} BY NAME SELECT * FROM {{rows}}", rows=rows)

    def _execute_keyed(self, statement: KeyedStatement, params: DataFrame, order: str | None) -> DataFrame:
        rows, keys = statement.rows(params, *([order] if order else [])), list(statement.keys)
        if statement.is_delete:
            self.delete_rows(rows, statement.table, keys)
            return self.spark.createDataFrame([], "num_affected_rows bigint")
        counts = self.upsert_table(
            rows, statement.table, keys, list(statement.values), update_only=True, nan_to_none=False, order_by=order
        )
        return self.spark.createDataFrame([(counts.rows_matched,)], "num_affected_rows bigint")

    # Load -----------------------------------------------------------------------

    def load_table(
        self,
        sql: str,
        params: dict[str, Any] | None = None,
        index_col: str | Sequence[str] | None = None,
        columns: Sequence[str] | None = None,
        parse_dates: Any = None,
        datetime_cols_dtype: str | None = None,
        datetime_format: str = DEFAULT_FORMAT,
        localize_tz: str | None = None,
        target_tz: str | None = None,
        dtypes: dict[str, Any] | None = None,
        chunksize: int | None = None,
        coerce_float: bool = True,
        order_by: str | Sequence[str] | None = None,
        dst: str = "raise",
        validate: bool = False,
        warn_if_empty: bool = False,
        local_epoch: bool = False,
    ) -> DataFrame | Iterator[DataFrame]:
        """Load a table, or the result of a query with bind parameters.

        `sql` is a table name (one word; `columns` picks from it) or a query. The
        result is lazy. With `chunksize` an iterator of DataFrames of that many
        rows is returned, in the order of `order_by`; casts and datetime options
        do not apply then, `index_col` does.
        """
        check_chunksize(chunksize)
        df = self._read(sql, params, columns)
        if chunksize is not None:
            df = shape_rows(df, index_col=index_col, parse_dates=parse_dates, coerce_float=coerce_float)
            return iter_chunks(df, chunksize, order_by)
        return shape_rows(
            df,
            index_col=index_col,
            parse_dates=parse_dates,
            datetime_cols_dtype=datetime_cols_dtype,
            datetime_format=datetime_format,
            localize_tz=localize_tz,
            target_tz=target_tz,
            dtypes=dtypes,
            coerce_float=coerce_float,
            dst=dst,
            validate=validate,
            warn_if_empty=warn_if_empty,
            local_epoch=local_epoch,
        )

    def _read(self, sql: str, params: dict[str, Any] | None, columns: Sequence[str] | None) -> DataFrame:
        if not isinstance(sql, str):
            raise LoadTableError(f"sql must be a string, got {type(sql)}", data=sql)
        try:
            if not is_table_name(sql):
                return self.spark.sql(sql, args=params)
            name = sql.strip()
            is_view = self.database is None or not self.exists(name)
            df = self.spark.table(name if is_view else self.qualified(name))
            return df if columns is None else df.select(*[quoted(c) for c in columns])
        except (PySparkException, TypeError) as e:
            raise LoadTableError(
                f"The rows could not be read ({type(e).__name__}): {e} [statement: {sql}]",
                data={"statement": sql, "bound": params, "wanted": columns, "cause": e.args},
            ) from None

    # Save -----------------------------------------------------------------------

    def save_df(
        self,
        df: DataFrame,
        table: str,
        if_exists: str = "append",
        index_cols: str | Sequence[str] | None = None,
        index: bool = True,
        index_label: str | Sequence[str] | None = None,
        chunksize: int | None = None,
        schema: str | None = None,
        dtype: dict[str, Any] | Any | None = None,
        datetime_cols_dtype: str | None = None,
        datetime_format: str = DEFAULT_FORMAT,
        localize_tz: str | None = None,
        target_tz: str | None = None,
        method: str | Callable | None = None,
        partition_by: str | Sequence[str] | None = None,
        bucket_by: tuple[int, str | Sequence[str]] | None = None,
        auto_key: str | None = None,
        dst: str = "raise",
        local_epoch: bool = False,
    ) -> None:
        """Save `df` to a table, which is created if it is absent.

        `if_exists`: 'append' adds rows; 'replace' exchanges all rows and keeps the
        table definition; 'drop-replace' creates the table anew; 'fail' raises
        `TableExistsError`. Columns that `df` lacks get their default or NULL.

        `index_cols` are the key columns of `df`: `index` False leaves them out and
        `index_label` renames them. `chunksize` limits the rows per file of a
        created or replaced table. `method` may be a function that is called with
        the row iterator of each partition instead of writing. `partition_by` and
        `bucket_by` (number of buckets, columns) lay out a table that is created;
        bucketed by the key columns, later upserts need not shuffle it. `auto_key` is
        an integer column that the rows get the next numbers in.
        """
        check_chunksize(chunksize)
        check_choice("if_exists", if_exists, IF_EXISTS)
        name = self.qualified(table, schema)
        if not (method in (None, "multi") or callable(method)):
            raise InvalidInputError(f"Invalid method {method!r}", data=method)
        exists = self.spark.catalog.tableExists(name)
        if exists and if_exists == "fail":
            raise TableExistsError(f"Table {table} already exists and if_exists='fail'", data=table)

        rows = self._rows_to_save(df, index_cols, index, index_label)
        rows = convert_datetime_columns(rows, datetime_cols_dtype, datetime_format, localize_tz, target_tz, dst, local_epoch)
        rows = cast_columns(rows, dtype)
        staged: list[str] = []
        try:
            if exists:
                finish_change(self.spark, name)
            if auto_key is not None:
                last = self._last_number(name, auto_key) if exists and if_exists == "append" else 0
                positioned = with_positions(rows.drop(auto_key))
                staged.append(positioned.path)
                number = F.col(POSITION) + F.lit(last + 1)
                rows = positioned.df.withColumn(auto_key, number).drop(POSITION)
            rules = self._constraints.get(name)
            if rules is not None and if_exists != "drop-replace":
                rows, path = stage(rows, "save")
                staged.append(path)
                self._enforce_save(rows, name, rules, exists and if_exists == "append")
            if callable(method):
                rows.foreachPartition(method)
            elif not exists:
                self._create(rows, name, chunksize, partition_by, bucket_by)
            elif if_exists == "append":
                with session_options(self.spark, {MAX_RECORDS: chunksize}):
                    self.spark.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {{rows}}", rows=rows)
            elif if_exists == "replace":
                old = self.spark.table(name)
                check_columns(rows.columns, old.columns, "table")
                self._enforce_references(name, old, to_layout(rows, old), SaveDataFrameError)
                replace_rows(self.spark, name, rows, chunksize)
            else:
                self._enforce_references(name, self.spark.table(name), rows, SaveDataFrameError)
                self._drop_replace(rows, name, chunksize, partition_by, bucket_by)
        except FramestoreError as e:
            if isinstance(e, (SaveDataFrameError, InvalidInputError)):
                raise
            raise SaveDataFrameError(f"Could not save to table {table}: {e}", data=e.data) from None
        except Exception as e:
            raise SaveDataFrameError(f"Could not save to table {table}: {e}", data=e.args) from None
        finally:
            for path in staged:
                delete_path(self.spark, path)

    @staticmethod
    def _rows_to_save(df, index_cols, index, index_label) -> DataFrame:
        keys = check_columns(as_list(index_cols), df.columns)
        if not index:
            return df.drop(*keys)
        labels = as_list(index_label)
        if labels and len(labels) != len(keys):
            raise InvalidInputError("index_label needs one name per key column", data=index_label)
        return keys_first(df, keys or None).withColumnsRenamed(dict(zip(keys, labels)))

    def _enforce_save(self, rows: DataFrame, name: str, rules: Constraints, append: bool) -> None:
        if append:
            missing = [c for c in self.spark.table(name).columns if c not in rows.columns]
            rows = rows.select("*", *[F.lit(None).alias(c) for c in missing])
        existing = self.spark.table(name) if append else None
        enforce(rows, rules, self._parents(rules), existing, self.foreign_keys, SaveDataFrameError)

    def _create(self, rows: DataFrame, name: str, chunksize: int | None, partition_by, bucket_by) -> None:
        names = check_columns(as_list(partition_by), rows.columns)
        writer = balanced(rows, names).write.format("parquet")
        if chunksize:
            writer = writer.option("maxRecordsPerFile", chunksize)
        if partition_by:
            writer = writer.partitionBy(*names)
        if bucket_by:
            writer = writer.bucketBy(bucket_by[0], *as_list(bucket_by[1]))
        writer.saveAsTable(name)

    def _drop_replace(self, rows: DataFrame, name: str, chunksize: int | None, partition_by, bucket_by) -> None:
        # The rows may come from the table itself: write them completely before the drop.
        # The old table is dropped last; if a rename fails it still has its rows, and gets its name back.
        mark = uuid.uuid4().hex
        new, old = f"{name}_new_{mark}", f"{name}_old_{mark}"
        self._create(rows, new, chunksize, partition_by, bucket_by)
        # An older version may be in the folder that the new table's name asks for.
        vacuum(self.spark, name)
        self.spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        try:
            self.spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
        except Exception:
            self.spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
            raise
        self.spark.sql(f"DROP TABLE {old}")
        self._constraints.pop(name, None)

    # Delete ---------------------------------------------------------------------

    def delete_all_records_from_table(self, table: str) -> None:
        """Delete all rows of a table and keep its definition."""
        name = self.qualified(table)
        try:
            finish_change(self.spark, name)
            old = self.spark.table(name)
            self._enforce_references(name, old, None, DeleteFromTableError)
            location = table_info(self.spark, name).location
            ledger = read_ledger(self.spark, location)
            insert_overwrite(self.spark.createDataFrame([], old.schema), name, "static")
            write_ledger(self.spark, location, ledger)
        except FramestoreError:
            raise
        except Exception as e:
            raise DeleteFromTableError(f"Could not delete the rows of table {table}: {e}", data=e.args) from None

    def delete_rows(self, df: DataFrame, table: str, where_cols: str | Sequence[str], rewrite: str = "table") -> None:
        """Delete the rows whose `where_cols` equal those of a row of `df`.

        With `rewrite` 'files' only the files that hold such a row are written anew (see `upsert_table`).
        """
        name = self.qualified(table)
        check_choice("rewrite", rewrite, REWRITE)
        keys = check_columns(as_list(where_cols), df.columns)
        staged: list[str] = []
        try:
            finish_change(self.spark, name)
            target = self.spark.table(name)
            check_columns(keys, target.columns, "table")
            gone = df.select(*[quoted(k) for k in keys]).distinct()
            files = None
            if rewrite == "files" or self._references(name):
                gone, path = stage(gone, "deleted-keys")
                staged.append(path)
            if self._references(name):
                removed = spread_join(target, gone, keys, "left_semi")
                self._enforce_references(name, removed, spread_join(target, gone, keys, "left_anti"), DeleteFromTableError)
            if rewrite == "files":
                files = self._touched_files(name, align_types(gone, target.schema), keys)
            if files is None:
                replace_rows(self.spark, name, spread_join(target, gone, keys, "left_anti"))
            elif files:
                info = table_info(self.spark, name)
                kept = spread_join(rows_of_files(self.spark, name, info, files), gone, keys, "left_anti")
                replace_files(self.spark, name, info, kept, files)
        except FramestoreError:
            raise
        except Exception as e:
            raise DeleteFromTableError(f"Could not delete rows of table {table}: {e}", data=e.args) from None
        finally:
            for path in staged:
                delete_path(self.spark, path)

    def _touched_files(self, name: str, wanted: DataFrame, keys: Sequence[str]) -> list[str] | None:
        """The names of the files of a table that hold one of the `wanted` keys, or None if it is to be written as a whole.

        That is so if its rows do not lie in plain files of one folder, or if no file would stay.
        """
        if not has_plain_files(table_info(self.spark, name)):
            return None
        target = self.spark.table(name)
        files = touched_files(target, wanted, keys)
        return None if files and len(files) == len(target.inputFiles()) else files

    # Upsert and merge -----------------------------------------------------------

    def upsert_table(
        self,
        df: DataFrame,
        table: str,
        where_cols: str | Sequence[str],
        upsert_cols: str | Sequence[str] | None = "all",
        upsert_index_cols: bool | str | Sequence[str] = False,
        update_only: bool = False,
        chunksize: int | None = None,
        nan_to_none: bool = True,
        datetime_cols_dtype: str | None = None,
        datetime_format: str = DEFAULT_FORMAT,
        localize_tz: str | None = None,
        target_tz: str | None = None,
        dry_run: bool = False,
        index_cols: str | Sequence[str] | None = None,
        order_by: str | Sequence[str] | None = None,
        on_duplicate: str | None = None,
        insert_only: bool = False,
        auto_key: str | None = None,
        dst: str = "raise",
        local_epoch: bool = False,
        rewrite: str = "table",
        batch: tuple[str, int] | None = None,
    ) -> ChangeCounts | DataFrame | None:
        """Update the rows of a table that match `df` on `where_cols`, and insert the others.

        Returns the counts of the run, from the files that it wrote. With `dry_run` nothing is written and the
        change set is returned. `auto_key` is an integer column that inserted rows
        get the next numbers in. See `operators.upsert.upsert_changes` for
        `order_by` and `on_duplicate`.

        `rewrite` 'table' writes all rows anew and keeps the version before until the next change. 'files' writes only the files that
        hold a row with a key of `df`, and a file of new rows; all other files stay as they are. Frames that were loaded before
        it cannot be read any more. Partitioned and bucketed tables are written as without it.

        `batch`, the name of a source and the number of its batch, is noted with the rows; a
        batch of that number or a lower one is not applied again, and None is returned.
        """
        check_chunksize(chunksize)

        def plan(target: DataFrame, source: DataFrame, co_located: bool = False, unique: bool = False) -> Changes:
            return upsert_changes(
                target,
                source,
                where_cols,
                upsert_cols,
                index_cols=index_cols,
                upsert_index_cols=upsert_index_cols,
                update_only=update_only,
                insert_only=insert_only,
                chunksize=chunksize,
                nan_as_null=nan_to_none,
                order_by=order_by,
                on_duplicate="unique" if unique else on_duplicate,
                co_located=co_located,
            )

        source = convert_datetime_columns(df, datetime_cols_dtype, datetime_format, localize_tz, target_tz, dst, local_epoch)
        once = order_by is None and on_duplicate in (None, "error")
        return self._apply(
            table, source, plan, dry_run, deletes=False, auto_key=auto_key, once=once, nan_as_null=nan_to_none, rewrite=rewrite, batch=batch
        )

    def merge_df(
        self,
        df: DataFrame,
        table: str,
        on_cols: str | Sequence[str],
        merge_cols: str | Sequence[str] | None = "all",
        merge_index_cols: bool | str | Sequence[str] = False,
        omit_update_where_clause: bool = True,
        chunksize: int | None = None,
        nan_to_none: bool = True,
        datetime_cols_dtype: str | None = None,
        datetime_format: str = DEFAULT_FORMAT,
        localize_tz: str | None = None,
        target_tz: str | None = None,
        dry_run: bool = False,
        index_cols: str | Sequence[str] | None = None,
        order_by: str | Sequence[str] | None = None,
        on_duplicate: str | None = None,
        null_safe_change: bool = False,
        delete_unmatched: bool = False,
        native: bool = False,
        dst: str = "raise",
        local_epoch: bool = False,
        rewrite: str = "table",
        batch: tuple[str, int] | None = None,
    ) -> ChangeCounts | DataFrame | None:
        """Merge `df` into a table, as one MERGE per row of `df` would.

        `rewrite` and `batch` as in `upsert_table`; with `delete_unmatched` the table is always written as a whole.
        `native` runs Spark's own MERGE INTO, which reports no counts and takes none of the
        options that it cannot carry, and raises
        `SQLStatementNotSupportedError` if the table format has none.
        """
        check_chunksize(chunksize)

        def plan(target: DataFrame, source: DataFrame, co_located: bool = False, unique: bool = False) -> Changes:
            return merge_changes(
                target,
                source,
                on_cols,
                merge_cols,
                index_cols=index_cols,
                merge_index_cols=merge_index_cols,
                omit_update_where_clause=omit_update_where_clause,
                null_safe_change=null_safe_change,
                delete_unmatched=delete_unmatched,
                chunksize=chunksize,
                nan_as_null=nan_to_none,
                order_by=order_by,
                on_duplicate="unique" if unique else on_duplicate,
                co_located=co_located,
            )

        source = convert_datetime_columns(df, datetime_cols_dtype, datetime_format, localize_tz, target_tz, dst, local_epoch)
        if native:
            cannot = {
                "omit_update_where_clause=False": not omit_update_where_clause, "null_safe_change": null_safe_change,
                "delete_unmatched": delete_unmatched, "order_by": order_by, "on_duplicate": on_duplicate,
                "chunksize": chunksize, "dry_run": dry_run, "rewrite='files'": rewrite == "files", "batch": batch, "declared constraints": self._constraints.get(self.qualified(table)),
            }
            given = [option for option, value in cannot.items() if value]
            if given:
                raise InvalidInputError(f"native=True cannot carry {', '.join(given)}", data=given)
            self._native_merge(table, nan_to_null(source) if nan_to_none else source, plan)
            return None
        once = order_by is None and on_duplicate in (None, "error")
        return self._apply(
            table, source, plan, dry_run, deletes=delete_unmatched, once=once, nan_as_null=nan_to_none, rewrite=rewrite, batch=batch
        )

    def _native_merge(self, table: str, source: DataFrame, plan: Callable) -> None:
        name = self.qualified(table)
        changes = plan(self.spark.table(name), source)
        condition = F.expr(" AND ".join(f"source.`{k}` = {name}.`{k}`" for k in changes.keys))
        try:
            source.alias("source").mergeInto(name, condition).whenMatched().update(
                {c: F.col(f"source.`{c}`") for c in changes.update}
            ).whenNotMatched().insert({c: F.col(f"source.`{c}`") for c in changes.insert}).merge()
        except PySparkException as e:
            raise SQLStatementNotSupportedError(
                f"Table {table} does not support MERGE INTO: {e}. Use native=False", data=e.args
            ) from None

    def _apply(
        self,
        table: str,
        source: DataFrame,
        plan: Callable,
        dry_run: bool,
        deletes: bool,
        auto_key: str | None = None,
        once: bool = False,
        nan_as_null: bool = True,
        rewrite: str = "table",
        batch: tuple[str, int] | None = None,
    ) -> ChangeCounts | DataFrame | None:
        name = self.qualified(table)
        check_choice("rewrite", rewrite, REWRITE)
        if not self.spark.catalog.tableExists(name):
            raise ExecuteStatementError(f"Table {table} does not exist", data=table)
        if not dry_run:
            finish_change(self.spark, name)
            if batch is not None and is_applied(self.spark, name, batch):
                return None
        target = self.spark.table(name)
        if dry_run:
            return plan(target, source).change_set()
        # Finds wrong columns before the source is computed.
        outline = plan(target, source.limit(0))
        scratch, changes = list(outline.scratch), None
        try:
            # The source is read by several branches of the plan: compute it once.
            source, path = stage(source, "source")
            scratch.append(path)
            if once:
                self._require_unique(source, target, outline.keys, nan_as_null)
            info = table_info(self.spark, name)
            files = None
            some_partitions = (
                info.partition_columns
                and not deletes
                and set(info.partition_columns) <= set(outline.keys) <= set(outline.insert)
                and not self._other_key_sets(name, outline)
                and not self._references(name)
            )
            if some_partitions:
                target, path = touched_partitions(target, source, info.partition_columns)
                scratch.append(path)
            elif rewrite == "files" and not deletes:
                wanted = align_types(pick(nan_to_null(source) if nan_as_null else source, outline.keys), target.schema)
                files = self._touched_files(name, wanted.distinct(), outline.keys)
            if files is not None:
                # The keys of the source that the table holds are in these files.
                target = rows_of_files(self.spark, name, info, files)
            bucketed = bool(info.bucket_columns) and set(info.bucket_columns) == set(outline.keys)
            changes = plan(target, source, co_located=bucketed, unique=once)
            if bucketed and changes.keyed is not None:
                # Fewer rows than buckets; without any the join is plain.
                changes.hot, path = stage(hot_keys(target, outline.keys, info.n_buckets), "hot-keys")
                scratch.append(path)
                changes.hot = changes.hot if changes.hot.limit(1).count() else None
            if auto_key is not None:
                changes.auto_key = (auto_key, self._last_number(name, auto_key))
            # Rows of the table that the change does not write: they still hold keys.
            rest = None
            if files is not None:
                rest = rows_of_files(self.spark, name, info, sorted(set(data_files(self.spark, info.location)) - set(files)))
            check = self._check_of_change(name, changes, rest)
            n_before = target.count() if deletes else 0
            rows = changes.marked_result()
            if files is not None:
                marks = replace_files(self.spark, name, info, rows, files, batch, check)
            elif some_partitions:
                marks = replace_partitions(self.spark, name, rows, batch, check=check)
            else:
                marks = replace_rows(self.spark, name, rows, batch=batch, check=check)
            matched, changed = marks.get(SAME, 0) + marks.get(UPDATED, 0), marks.get(UPDATED, 0)
            return ChangeCounts(matched, changed, marks.get(INSERTED, 0), n_before - matched if deletes else 0)
        except FramestoreError:
            raise
        except Exception as e:
            raise ExecuteStatementError(f"{type(e).__name__}: {e}", data=e.args) from None
        finally:
            for path in [*scratch, *(changes.scratch if changes is not None else ())]:
                delete_path(self.spark, path)

    @staticmethod
    def _require_unique(source: DataFrame, target: DataFrame, keys: Sequence[str], nan_as_null: bool) -> None:
        """Fail if a key repeats. Only the keys are read, counted before they are shuffled; the change then trusts the source."""
        rows = align_types(pick(nan_to_null(source) if nan_as_null else source, keys), target.schema)
        repeated = unique_violations(rows, list(keys)).limit(1).collect()
        if repeated:
            raise ExecuteStatementError(
                f"The source holds a key more than once, key columns {list(keys)}: {repeated[0].asDict()}", data=list(keys)
            )

    def _last_number(self, name: str, column: str) -> int:
        target = self.spark.table(name)
        check_columns([column], target.columns, "table")
        return target.agg(F.max(quoted(column))).first()[0] or 0

    def definition(self, table: str) -> str:
        """The CREATE TABLE statement of a table."""
        return self.spark.sql(f"SHOW CREATE TABLE {self.qualified(table)}").first()[0]

    def _other_key_sets(self, name: str, changes: Changes) -> dict[str, tuple[str, ...]]:
        """Declared keys that the change can make repeat: not the one it matches on."""
        rules = self._constraints.get(name, Constraints())
        return {
            label: columns
            for label, columns in rules.key_sets.items()
            if set(columns) != set(changes.keys) and set(columns) & set(changes.insert)
        }

    def _check_of_change(self, name: str, changes: Changes, rest: DataFrame | None) -> Callable[[DataFrame], None] | None:
        """The check of the rules of a table, and of those that refer to it, on the rows that a change has written.

        The change is computed once, whatever the number of rules: they look at the written files. Rules of rows and keys are for the rows that
        changed; a key of theirs must occur once in all rows. `rest` are the rows of the table that the change leaves where they are.
        """
        rules = self._constraints.get(name)
        touched = [*changes.update] if changes.keyed is not None else []
        referred = changes.delete_unmatched or any(set(fk.parent_columns) & set(touched) for _, fk in self._references(name))
        if rules is None and not referred:
            return None
        target, other_keys = changes.target, self._other_key_sets(name, changes)

        def check(written: DataFrame) -> None:
            rows = written.drop(CHANGE)
            after = rows if rest is None else rows.unionByName(rest.select(*rows.columns))
            if referred:
                columns = None if changes.delete_unmatched else touched
                self._enforce_references(name, target, after, ExecuteStatementError, columns)
            if rules is None:
                return
            changed = written.where(F.col(CHANGE).isin(UPDATED, INSERTED)).drop(CHANGE)
            of_rows = Constraints(
                not_null=rules.required, checks=rules.checks, foreign_keys=rules.foreign_keys if self.foreign_keys else ()
            )
            repeated = {label: repeated_keys(changed, after, columns) for label, columns in other_keys.items()}
            enforce(changed, of_rows, self._parents(rules), error=ExecuteStatementError, more=repeated)

        return check
