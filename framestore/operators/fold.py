"""Ordered application of change-only updates with repeated keys.

Row after row, the current values x of a key become s when some column differs in
the sense of SQL ``<>`` (NULL is no difference), else they stay. That is not "the
last row wins", and the order matters, so it does not fit a built-in aggregate.

Without a NULL in the rows of a key it nearly is, though: once a row has changed x, every later row is what x holds after it. So x
stays if all rows agree with it in the columns where it has a value, that is with their smallest and largest value
there, and is the last row otherwise. These keys are one aggregation.

The rows of the other keys that repeat are folded in order. A run of rows can be summed up in a few values, though. For each column, the
first row that can change x is the first one with a value there when x holds
another value, and the first one with a second value when x holds the first
value. So a run is described by at most two rows per column, each with the values
the key ends at when it changes there first. Runs combine in order, which lets
Spark range partition the rows by key and order - a hot key lies in many
partitions - sum up each partition as a stream, and combine the few summaries of
a key.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, AtomicType, IntegerType, LongType, StructField, StructType

from framestore.functions.project import ident
from framestore.operators.keyed import any_null, order_struct, quoted, row_struct

_BATCH_ROWS = 4096

# Send the code of this module to the Python workers, which may lack the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _different(a: Any, b: Any) -> bool:
    """SQL ``<>`` is true. NaN equals NaN."""
    return a is not None and b is not None and a != b and not (a != a and b != b)


def _row_differs(x: tuple, s: tuple) -> bool:
    return any(_different(a, b) for a, b in zip(x, s))


class Run:
    """Summary of consecutive source rows of one key.

    Per column: `value` is the first value, `first` and `second` are (place,
    final values) of the first row with a value and of the first with another
    value. `end` are the final values when the first row of the run is inserted.
    """

    __slots__ = ("rows", "end", "value", "first", "second")

    def __init__(self, row: tuple) -> None:
        self.rows = 1
        self.end = row
        self.value = list(row)
        self.first = [None if v is None else (0, row) for v in row]
        self.second: list[tuple[int, tuple] | None] = [None] * len(row)

    def apply(self, x: tuple) -> tuple:
        """The values after this run for a key that holds `x` before it."""
        hits = [
            self.first[c] if _different(v, self.value[c]) else self.second[c]
            for c, v in enumerate(x)
            if v is not None and self.value[c] is not None
        ]
        hits = [h for h in hits if h is not None]
        return min(hits, key=lambda h: h[0])[1] if hits else x

    def extend(self, later: Run) -> None:
        """Add the run that follows."""
        shifted = lambda p: None if p is None else (p[0] + self.rows, p[1])
        self.end = later.apply(self.end)
        for points in (self.first, self.second):
            points[:] = [None if p is None else (p[0], later.apply(p[1])) for p in points]
        for c, v in enumerate(later.value):
            if v is None:
                continue
            if self.value[c] is None:
                self.value[c], self.first[c] = v, shifted(later.first[c])
                self.second[c] = shifted(later.second[c])
            elif self.second[c] is None:
                other = later.first[c] if _different(v, self.value[c]) else later.second[c]
                self.second[c] = shifted(other)
        self.rows += later.rows


def _schema(keys: Sequence[StructField], values: Sequence[StructField]) -> StructType:
    row = StructType([StructField(f.name, f.dataType) for f in values])
    point = StructType([StructField("place", LongType()), StructField("row", row)])
    return StructType(
        [
            *keys,
            StructField("__part", IntegerType()),
            StructField("__rows", LongType()),
            StructField("__inserted", row),
            StructField("__value", row),
            StructField("__first", ArrayType(point)),
            StructField("__second", ArrayType(point)),
        ]
    )


def _emit(key: tuple, part: int, run: Run, key_names: Sequence[str], names: Sequence[str]) -> dict[str, Any]:
    as_row = lambda r: dict(zip(names, r))
    as_points = lambda ps: [None if p is None else {"place": p[0], "row": as_row(p[1])} for p in ps]
    return {
        **dict(zip(key_names, key)),
        "__part": part,
        "__rows": run.rows,
        "__inserted": as_row(run.end),
        "__value": as_row(run.value),
        "__first": as_points(run.first),
        "__second": as_points(run.second),
    }


def _restore(record: dict[str, Any], names: Sequence[str]) -> Run:
    as_tuple = lambda r: tuple(r[n] for n in names)
    as_points = lambda ps: [None if p is None else (p["place"], as_tuple(p["row"])) for p in ps]
    run = Run(as_tuple(record["__inserted"]))
    run.rows = record["__rows"]
    run.value = list(as_tuple(record["__value"]))
    run.first, run.second = as_points(record["__first"]), as_points(record["__second"])
    return run


def fold_changes(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key with the summary of its source rows, for `folded_row`.

    `__inserted` holds the values a new key ends with. Keys that occur once or without a NULL in `columns` take
    a pure SQL path; only the rows of the others pass through Python.
    """
    keys, columns = list(keys), list(columns)
    rows = rows.where(~any_null(keys))
    key_columns = [quoted(k) for k in keys]
    ends = []
    if sortable_types(rows, columns):
        ends = [f(quoted(c)).alias(f"__{name}_{i}") for i, c in enumerate(columns) for name, f in (("low", F.min), ("high", F.max))]
    counted = rows.groupBy(*key_columns).agg(
        F.count("*").alias("__n"), F.count_if(any_null(columns)).alias("__nulls"),
        F.max_by(row_struct(columns), order_struct(order_by, rows)).alias("__row"), *ends,
    )
    plain = "__n = 1 OR __nulls = 0" if ends else "__n = 1"
    folded = counted.where(f"NOT ({plain})").select(*key_columns)
    return _plain_keys(counted.where(plain), keys, columns, bool(ends)).unionByName(
        _repeated_runs(rows.join(folded, keys, "left_semi"), keys, columns, order_by), allowMissingColumns=True
    )


def sortable_types(rows: DataFrame, columns: Sequence[str]) -> bool:
    """True if the smallest and the largest value of the columns can be found."""
    return all(isinstance(rows.schema[c].dataType, AtomicType) for c in columns)


def _plain_keys(counted: DataFrame, keys: list[str], columns: list[str], ends: bool) -> DataFrame:
    """A key that one aggregation sums up has no points: `folded_row` compares with the smallest and the largest values."""
    row = counted.schema["__row"].dataType
    points = ArrayType(StructType([StructField("place", LongType()), StructField("row", row)]))
    end = lambda name: F.struct(*[F.col(f"__{name}_{i}").alias(c) for i, c in enumerate(columns)]) if ends else F.col("__row")
    return counted.select(
        *[quoted(k) for k in keys],
        F.col("__row").alias("__inserted"),
        end("low").alias("__low"),
        end("high").alias("__high"),
        F.lit(None).cast(row).alias("__value"),
        F.lit(None).cast(points).alias("__first"),
        F.lit(None).cast(points).alias("__second"),
    )


def _repeated_runs(rows: DataFrame, keys: list[str], columns: list[str], order_by: Sequence[str]) -> DataFrame:
    order = order_struct(order_by, rows)
    rows = rows.select(*[quoted(c) for c in dict.fromkeys(keys + columns)], order.alias("__order"))
    out = _schema([rows.schema[k] for k in keys], [rows.schema[c] for c in columns])
    arrow = to_arrow_schema(out)

    def stream(items: Iterator[tuple[tuple, int, Run]]) -> Iterator[pa.RecordBatch]:
        """Join the runs of equal keys that follow each other; hold one key at a time."""
        done: list[dict] = []
        key, part, run = None, 0, None
        for next_key, next_part, next_run in items:
            if run is not None and not _row_differs(key, next_key):
                run.extend(next_run)
                continue
            if run is not None:
                done.append(_emit(key, part, run, keys, columns))
            key, part, run = next_key, next_part, next_run
            if len(done) >= _BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        if run is not None:
            done.append(_emit(key, part, run, keys, columns))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One summary per key of the sorted rows of a partition."""

        def items():
            for batch in batches:
                key_lists = [batch.column(k).to_pylist() for k in keys]
                value_lists = [batch.column(c).to_pylist() for c in columns]
                for key, part, row in zip(zip(*key_lists), batch.column("__part").to_pylist(), zip(*value_lists)):
                    yield key, part, Run(row)

        return stream(items())

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One summary per key of the summaries, sorted by key and partition."""

        def items():
            for batch in batches:
                for record in batch.to_pylist():
                    yield tuple(record[k] for k in keys), record["__part"], _restore(record, columns)

        return stream(items())

    key_columns = [quoted(k) for k in keys]
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The random last key spreads rows that are equal in key, order and values: their order is free.
    runs = (
        rows.repartitionByRange(partitions, *key_columns, F.col("__order"), F.rand(7))
        .sortWithinPartitions(*key_columns, "__order")
        .withColumn("__part", F.spark_partition_id())
        .drop("__order")
        .mapInArrow(summarize, out)
    )
    # At most one summary per key and partition is left, also of a hot key.
    return (
        runs.repartition(*key_columns)
        .sortWithinPartitions(*key_columns, "__part")
        .mapInArrow(combine, out)
        .drop("__part", "__rows")
    )


def folded_row(columns: Sequence[str]) -> str:
    """SQL for the struct of new values of a matched row, from the summary of its key.

    The first place where a column can change the row decides. Without places, the last row of the key
    counts if the smallest or the largest of its values differs.
    """
    points = [
        f"CASE WHEN {ident(c)} IS NULL THEN NULL WHEN {ident(c)} <> __value.{ident(c)} THEN get(__first, {i}) "
        f"ELSE get(__second, {i}) END"
        for i, c in enumerate(columns)
    ]
    current = f"struct({', '.join(ident(c) for c in columns)})"
    changed = " OR ".join(f"{ident(c)} <> __low.{ident(c)} OR {ident(c)} <> __high.{ident(c)}" for c in columns)
    folded = f"coalesce(array_min(array({', '.join(points)})).row, {current})"
    return f"CASE WHEN __first IS NOT NULL THEN {folded} WHEN {changed} THEN __inserted ELSE {current} END"
