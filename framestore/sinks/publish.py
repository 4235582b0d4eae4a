"""Replacing the rows of a catalog table as the last step of a computation.

A table cannot be overwritten while it is read, and an overwrite that fails half
way loses rows. So the new rows are first written beside the table; only then the
table is pointed at them. One writer per table is assumed: the last publish wins.

What a change did to each row is counted in the files that were written, before the table is pointed at
them: the counts hold whatever tasks were run again, and no error comes after the change.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from framestore.functions.project import ident
from framestore.operators.changes import CHANGE, default_value
from framestore.operators.keyed import align_types, any_null, quoted, spread_join
from framestore.session import delete_path, stage
from framestore.sinks.journal import exchange_files, finish_exchange, partition_folders, read_json, read_ledger, write_json, write_ledger

_VERSION_SUFFIX = re.compile(r"__v[0-9a-f]{32}$")


@dataclass(frozen=True)
class TableInfo:
    """Layout of a catalog table."""

    name: str
    location: str
    managed: bool
    provider: str
    partition_columns: tuple[str, ...]
    bucket_columns: tuple[str, ...]
    n_buckets: int = 0


def table_info(spark: SparkSession, table: str) -> TableInfo:
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = spark.catalog.listColumns(table)
    return TableInfo(
        name=table,
        location=details["Location"].rstrip("/"),
        managed=details.get("Type") == "MANAGED",
        provider=details.get("Provider", "parquet"),
        partition_columns=tuple(c.name for c in columns if c.isPartition),
        bucket_columns=tuple(c.name for c in columns if c.isBucket),
        n_buckets=int(details.get("Num Buckets") or 0),
    )


def to_layout(df: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of `df` in the order and with the types of `target`; absent ones get their default. A mark of the change stays."""
    df = align_types(df, target.schema)
    given = df.columns
    return df.selectExpr(
        *[f"{ident(f.name) if f.name in given else default_value(f)} AS {ident(f.name)}" for f in target.schema],
        *([CHANGE] if CHANGE in given else []),
    )


#: Formats that find columns by name, so that a column more in the files does no harm.
_BY_NAME = ("parquet", "orc")


def count_marks(written: DataFrame) -> dict[int, int]:
    """How many of the written rows have each mark of a change."""
    if CHANGE not in written.columns:
        return {}
    return {r[CHANGE]: r["count"] for r in written.groupBy(CHANGE).count().collect()}


def _read_files(spark: SparkSession, provider: str, location: str, rows: DataFrame) -> DataFrame:
    """What was written of `rows` to a folder, with the mark of the change if they have one."""
    return spark.read.schema(rows.schema).format(provider).load(location)


def _count_files(spark: SparkSession, provider: str, location: str, rows: DataFrame) -> dict[int, int]:
    if CHANGE not in rows.columns:
        return {}
    return count_marks(spark.read.schema(f"{CHANGE} tinyint").format(provider).load(location))


def balanced(rows: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Bring the rows of a table partition together, so that it gets few files.

    Adaptive execution splits a large partition over several tasks.
    """
    return rows.hint("rebalance", *[quoted(c) for c in partition_columns]) if partition_columns else rows


@contextmanager
def session_options(spark: SparkSession, options: dict[str, Any]) -> Iterator[None]:
    """Settings of one write. An insert into a table takes no write options, so they are set on the session."""
    wanted = {k: str(v) for k, v in options.items() if v is not None}
    before = {k: spark.conf.get(k) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


MAX_RECORDS = "spark.sql.files.maxRecordsPerFile"


def insert_overwrite(rows: DataFrame, table: str, mode: str, max_records_per_file: int | None = None) -> None:
    """INSERT OVERWRITE of all ('static') or only the written ('dynamic') partitions."""
    spark = rows.sparkSession
    with session_options(spark, {"spark.sql.sources.partitionOverwriteMode": mode, MAX_RECORDS: max_records_per_file}):
        rows.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


_PREVIOUS = "framestore.previous.location"


def previous_version(spark: SparkSession, table: str) -> str | None:
    """Where the rows of the version before the last publish are, which older frames may still read."""
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(_PREVIOUS)


def vacuum(spark: SparkSession, table: str) -> None:
    """Delete the version before the last publish. Frames that were loaded before it cannot be read any more."""
    before = previous_version(spark, table)
    if before:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES ('{_PREVIOUS}')")
        delete_path(spark, before)


#: Called with the rows that were written, before they are published. What it raises leaves the table as it was.
Check = Callable[[DataFrame], None]


@contextmanager
def _checked(spark: SparkSession, check: Check | None, written: Callable[[], DataFrame], folder: str) -> Iterator[None]:
    """Check what was written to a folder, which is deleted if the check or what follows before the publish fails."""
    try:
        if check is not None:
            check(written())
        yield
    except Exception:
        delete_path(spark, folder)
        raise


def replace_rows(
    spark: SparkSession, table: str, df: DataFrame, max_records_per_file: int | None = None, batch: tuple[str, int] | None = None,
    check: Check | None = None,
) -> dict[int, int]:
    """Make `df` the rows of `table` and keep its definition. `df` may read the table.

    The version before stays until the next publish (or `vacuum`), so that frames and readers of it go on.
    Returns the number of rows per mark in the column `CHANGE` of `df`, if it has one. `batch` is noted as applied.
    """
    info = table_info(spark, table)
    rows = to_layout(df, spark.table(table))
    if has_partition_folders(info):
        return replace_partitions(spark, table, df, batch, whole=True, max_records_per_file=max_records_per_file, check=check)
    ledger = read_ledger(spark, info.location) | dict([batch] if batch else [])
    if not info.managed or info.partition_columns or info.bucket_columns or (CHANGE in rows.columns and info.provider not in _BY_NAME):
        # An external table stays where it is.
        counts = _overwrite(rows, table, info, "static", max_records_per_file, check)
        write_ledger(spark, info.location, ledger)
        return counts
    base = _VERSION_SUFFIX.sub("", info.location)
    location = f"{base}__v{uuid.uuid4().hex}"
    writer = rows.write.format(info.provider)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(location)
    with _checked(spark, check, lambda: _read_files(spark, info.provider, location, rows), location):
        counts = _count_files(spark, info.provider, location, rows)
        # In the new folder, so that the rows and the note of their batch become visible in one step.
        write_ledger(spark, location, ledger)
    oldest = previous_version(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PREVIOUS}' = '{info.location}')")
    spark.catalog.refreshTable(table)
    if oldest and oldest != info.location:
        delete_path(spark, oldest)
    return counts


def _overwrite(
    rows: DataFrame, table: str, info: TableInfo, mode: str, max_records_per_file: int | None = None, check: Check | None = None
) -> dict[int, int]:
    """Overwrite a table from a complete staged copy."""
    spark = rows.sparkSession
    staged, path = stage(rows, "publish")
    with _checked(spark, check, lambda: staged, path):
        counts = count_marks(staged)
    insert_overwrite(balanced(staged.drop(CHANGE), info.partition_columns), table, mode, max_records_per_file)
    delete_path(spark, path)
    return counts


_PARTITIONS = "_framestore_partitions"
_REPLACED = "_framestore_replaced"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def has_partition_folders(info: TableInfo) -> bool:
    """True if the partitions of the table are folders that can be exchanged one by one."""
    return bool(info.partition_columns) and not info.bucket_columns and info.provider in _BY_NAME


def replace_partitions(
    spark: SparkSession, table: str, df: DataFrame, batch: tuple[str, int] | None = None, whole: bool = False,
    max_records_per_file: int | None = None, check: Check | None = None,
) -> dict[int, int]:
    """Replace the partitions that `df` holds rows of; with `whole` all others become empty. `df` may read the table.

    The rows are written once, into new folders, and counted. Then a list of the folders is written, which a later change completes
    if this one fails in between, and the partitions are pointed at them. The folders before stay until the next
    change of partitions, so that readers of them go on; a frame looks the partitions up when it is read. Returns as `replace_rows` does.
    """
    info = table_info(spark, table)
    rows = to_layout(df, spark.table(table))
    ledger = read_ledger(spark, info.location) | dict([batch] if batch else [])
    if not has_partition_folders(info):
        counts = _overwrite(rows, table, info, "dynamic", check=check)
        write_ledger(spark, info.location, ledger)
        return counts
    folder = f"{info.location}/_framestore_{uuid.uuid4().hex}"
    writer = balanced(rows, info.partition_columns).write.format(info.provider).partitionBy(*info.partition_columns)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(folder)
    with _checked(spark, check, lambda: _read_files(spark, info.provider, folder, rows), folder):
        counts = _count_files(spark, info.provider, folder, rows)
    new = partition_folders(spark, folder, len(info.partition_columns))
    if whole:
        known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        new += sorted(known - set(new))
    write_json(spark, f"{info.location}/{_PARTITIONS}", {"folder": folder, "partitions": new, "ledger": ledger})
    _finish_partitions(spark, table, info.location)
    return counts


def _partition_spec(spark: SparkSession, name: str) -> str:
    """The SQL of a partition from the name of its folder."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    values = []
    for part in name.split("/"):
        column, _, value = part.partition("=")
        text = unescape(value).replace("\\", "\\\\").replace("'", "\\'")
        values.append(f"{ident(unescape(column))} = " + ("NULL" if value == _NULL_PARTITION else f"'{text}'"))
    return f"PARTITION ({', '.join(values)})"


def _finish_partitions(spark: SparkSession, table: str, location: str) -> bool:
    """Point the partitions of a table at the folders of a change. Every step may be done again. True if there was a change."""
    change = read_json(spark, f"{location}/{_PARTITIONS}")
    if change is None:
        return False
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    replaced = read_json(spark, f"{location}/{_REPLACED}") or {"for": None, "folders": []}
    if replaced["for"] != change["folder"]:
        # What the change before replaced goes now.
        for old in replaced["folders"]:
            delete_path(spark, old)
        before = [_partition_location(spark, table, p) for p in change["partitions"] if p in known]
        write_json(spark, f"{location}/{_REPLACED}", {"for": change["folder"], "folders": before})
    added = []
    for name in change["partitions"]:
        where = f"{_partition_spec(spark, name)}", f"LOCATION '{_sql_text(change['folder'] + '/' + name)}'"
        if name in known:
            spark.sql(f"ALTER TABLE {table} {where[0]} SET {where[1]}")
        else:
            added.append(" ".join(where))
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
    write_ledger(spark, location, change["ledger"])
    delete_path(spark, f"{location}/{_PARTITIONS}")
    spark.catalog.refreshTable(table)
    return True


def _sql_text(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _partition_location(spark: SparkSession, table: str, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_partition_spec(spark, name)}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def has_plain_files(info: TableInfo) -> bool:
    """True if the rows of the table lie in one folder, in files that can be exchanged one by one."""
    return info.provider in _BY_NAME and not info.partition_columns and not info.bucket_columns


def touched_files(target: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> list[str]:
    """The names of the files of `target` that hold a row with one of the `wanted` keys (each once).

    Only key columns are read. The names of the files of a table are on the driver in any case.
    """
    rows = target.select(*[quoted(k) for k in keys], F.col("_metadata.file_name").alias("__file"))
    found = spread_join(rows, wanted, keys, "left_semi").select("__file").distinct()
    return sorted(r["__file"] for r in found.collect())


def rows_of_files(spark: SparkSession, table: str, info: TableInfo, names: Sequence[str]) -> DataFrame:
    """The rows of some files of a table, in its layout."""
    schema = spark.table(table).schema
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(info.provider).load([f"{info.location}/{n}" for n in names])


def replace_files(
    spark: SparkSession, table: str, info: TableInfo, df: DataFrame, removed: Sequence[str], batch: tuple[str, int] | None = None,
    check: Check | None = None,
) -> dict[int, int]:
    """Put the rows of `df` in the place of those files of the table. All other files stay as they are.

    `df` may read the removed files. The new files are complete and counted before a list of the exchange is written, which a
    later change completes if this one fails in between. The removed files are gone then: frames that were
    loaded before it cannot be read any more. Returns as `replace_rows` does.
    """
    rows = to_layout(df, spark.table(table))
    folder = f"{info.location}/_framestore_{uuid.uuid4().hex}"
    rows.write.format(info.provider).save(folder)
    with _checked(spark, check, lambda: _read_files(spark, info.provider, folder, rows), folder):
        counts = _count_files(spark, info.provider, folder, rows)
    exchange_files(spark, info.location, folder, list(removed), read_ledger(spark, info.location) | dict([batch] if batch else []))
    spark.catalog.refreshTable(table)
    return counts


def finish_change(spark: SparkSession, table: str) -> None:
    """Complete a change of the files of `table` that failed half way."""
    location = table_info(spark, table).location
    if finish_exchange(spark, location):
        spark.catalog.refreshTable(table)
    _finish_partitions(spark, table, location)


def is_applied(spark: SparkSession, table: str, batch: tuple[str, int]) -> bool:
    """True if the rows of the table hold this batch of its source."""
    name, number = batch
    return read_ledger(spark, table_info(spark, table).location).get(name, -1) >= number


def touched_partitions(target: DataFrame, source: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, str]:
    """The rows of `target` in partitions that `source` has rows for, and the path of the staged names of these.

    The names are joined to the partition columns, so Spark prunes the scan by them while it runs; none of them come
    to the driver. Partitions with a NULL are a branch of their own, as a join of plain columns finds no NULL.
    """
    spark = target.sparkSession
    types = StructType([f for f in target.schema if f.name in columns])
    named = align_types(source.select(*[quoted(c) for c in columns]), types).groupBy(*[quoted(c) for c in columns])
    names, path = stage(named.agg(F.count("*").alias("__n")), "partitions")
    # Dynamic pruning is for joins with a filtered side: this filter keeps all names.
    names = names.where("__n > 0")
    plain = target.where(~any_null(columns)).join(names.where(~any_null(columns)).drop("__n"), list(columns), "left_semi")
    rows = plain.select(*[quoted(c) for c in target.columns])
    if names.where(any_null(columns)).limit(1).count():
        nulls = names.where(any_null(columns)).select(*[quoted(c).alias(f"__{c}") for c in columns])
        same = reduce(lambda a, b: a & b, [quoted(c).eqNullSafe(quoted(f"__{c}")) for c in columns])
        rows = rows.unionByName(target.where(any_null(columns)).join(nulls, same, "left_semi"))
    return rows, path
