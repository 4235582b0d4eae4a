"""The effect of an upsert or merge: new table image, change set and counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField

from framestore.functions.project import ident, pick, project
from framestore.operators.chunks import POSITION, with_positions
from framestore.operators.keyed import HIT, any_null, bucketed_join, quoted, row_struct, spread_join

ACTION = "_action"
_NEW = "__new"
_ROWS = "__rows"

#: A column of a byte in the files of a new version, beside the columns of the table: what the change did to the row.
CHANGE = "_framestore_change"
KEPT, SAME, UPDATED, INSERTED = range(4)


def default_value(field: StructField) -> str:
    """SQL for the DEFAULT of a table column as Spark records it in the schema, else NULL."""
    text = (field.metadata or {}).get("CURRENT_DEFAULT", "NULL")
    return f"CAST({text} AS {field.dataType.simpleString()})"


@dataclass
class Changes:
    """A planned upsert or merge.

    `keyed` has one row per source key with the values to apply; `new_row` is the
    struct of new values of a matched row, in SQL over the columns of the target and
    of `keyed`. `inserts` are
    the new rows with non-NULL keys; `null_key_rows` are the source rows of which
    those with a NULL key are inserted as well. `new_keys` has the keys of the source rows that make `inserts`, where these are too
    many to broadcast: they are then counted without a join. `co_located` says that the target is
    bucketed by the keys, so that a join on just the keys need not shuffle it; `hot` are the few keys that hold so many of its
    rows that a bucket of theirs would be too large for a task.
    `auto_key` is a column that inserted rows get a number in, and the number before
    the first one. `scratch` are staged tables that can
    be deleted when the change is done.
    """

    target: DataFrame
    keyed: DataFrame | None
    keys: Sequence[str]
    update: Sequence[str]
    insert: Sequence[str]
    new_row: str
    inserts: DataFrame | None
    null_key_rows: DataFrame | None
    new_keys: DataFrame | None = None
    delete_unmatched: bool = False
    co_located: bool = False
    auto_key: tuple[str, int] | None = None
    hot: DataFrame | None = None
    scratch: tuple[str, ...] = ()
    _with_numbers: DataFrame | None = None

    def matched(self, how: str) -> DataFrame:
        """Target rows joined with the source row of their key; `HIT` is NULL without one."""
        keyed = self.keyed.withColumn(HIT, F.lit(True))
        if self.co_located:
            return bucketed_join(self.target, keyed, self.keys, how, self.hot)
        return spread_join(self.target, keyed, self.keys, how)

    def updated(self, marked: bool = False) -> DataFrame:
        """The target rows with the new values of matched rows; with `marked` also the column `CHANGE`."""
        if self.keyed is None:
            return self.target.withColumn(CHANGE, F.lit(KEPT).cast("tinyint")) if marked else self.target
        joined = self._with_new_row("inner" if self.delete_unmatched else "left")
        columns = {}
        for name in self.target.columns:
            value = ident(name)
            if name in self.update:
                value = f"CASE WHEN {HIT} IS NOT NULL THEN {_NEW}.{value} ELSE {value} END"
            columns[name] = value
        if marked:
            mark = f"CASE WHEN {HIT} IS NULL THEN {KEPT} WHEN {self._differs()} THEN {UPDATED} ELSE {SAME} END"
            columns[CHANGE] = f"CAST({mark} AS TINYINT)"
        return project(joined, columns, self.target.schema)

    def _with_new_row(self, how: str) -> DataFrame:
        # A column of its own: Spark then computes the struct once per row.
        return self.matched(how).selectExpr("*", f"CASE WHEN {HIT} IS NOT NULL THEN {self.new_row} END AS {_NEW}")

    def _differs(self) -> str:
        """True where a matched row gets another value; NULL equals NULL here."""
        old = ", ".join(ident(c) for c in self.update)
        return f"({HIT} IS NOT NULL AND NOT ({_NEW} <=> struct({old})))"

    def inserted(self) -> DataFrame | None:
        """The new rows in the layout of the target, or None if nothing is ever inserted."""
        if self.inserts is None:
            return None
        null_rows = pick(self.null_key_rows.where(any_null(self.keys)), self.insert)
        rows = self.inserts.unionByName(null_rows)
        given = list(self.insert)
        if self.auto_key is not None and self.auto_key[0] not in given:
            given.append(self.auto_key[0])
            rows = self._numbered(rows)
        return project(
            rows,
            {f.name: ident(f.name) if f.name in given else default_value(f) for f in self.target.schema},
            self.target.schema,
        )

    def _numbered(self, rows: DataFrame) -> DataFrame:
        column, last = self.auto_key
        if self._with_numbers is None:
            positioned = with_positions(rows)
            self.scratch += (positioned.path,)
            key_type = self.target.schema[column].dataType
            number = (F.col(POSITION) + F.lit(last + 1)).cast(key_type)
            self._with_numbers = positioned.df.withColumn(column, number).drop(POSITION)
        return self._with_numbers

    def result(self) -> DataFrame:
        """The whole table after the change."""
        updated, inserted = self.updated(), self.inserted()
        return updated if inserted is None else updated.unionByName(inserted)

    def marked_result(self) -> DataFrame:
        """The whole table after the change, with the column `CHANGE`, by which the written rows are counted."""
        updated, inserted = self.updated(marked=True), self.inserted()
        if inserted is None:
            return updated
        return updated.unionByName(inserted.withColumn(CHANGE, F.lit(INSERTED).cast("tinyint")))

    def change_set(self) -> DataFrame:
        """One row per affected row: `_action`, the keys, the `old` and the `new` values.

        `_action` is 'update' (a value changes), 'unchanged' (matched, all values
        equal), 'insert' or 'delete'.
        """
        inserted = self.inserted()
        parts = self._matched_set()
        if inserted is not None:
            new = row_struct(self.target.columns)
            old = F.lit(None).cast(inserted.select(new.alias("x")).schema["x"].dataType)
            key_values = [quoted(k) for k in self.keys]
            parts.append(inserted.select(F.lit("insert").alias(ACTION), *key_values, old.alias("old"), new.alias("new")))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _matched_set(self) -> list[DataFrame]:
        """The part of the change set that is about target rows, if there is one."""
        columns = self.target.columns
        parts = []
        if self.keyed is not None:
            joined = self._with_new_row("left" if self.delete_unmatched else "inner")
            fields = [f"{_NEW}.{ident(c)} AS {ident(c)}" if c in self.update else ident(c) for c in columns]
            parts.append(
                joined.selectExpr(
                    f"CASE WHEN {HIT} IS NULL THEN 'delete' WHEN {self._differs()} THEN 'update' "
                    f"ELSE 'unchanged' END AS {ACTION}",
                    *[ident(k) for k in self.keys],
                    f"struct({', '.join(ident(c) for c in columns)}) AS old",
                    f"CASE WHEN {HIT} IS NOT NULL THEN struct({', '.join(fields)}) END AS new",
                )
            )
        return parts

    def _inserts_by_key(self) -> DataFrame:
        """(`ACTION`, `_ROWS`): how many rows are inserted, from one aggregation of the keys of both sides, summed up before it moves.

        An anti join would sort both sides, and make the keys of the target distinct first, in one task.
        """
        known = pick(self.target, self.keys).where(~any_null(self.keys)).select("*", F.lit(True).alias("__known"), F.lit(0).alias(_ROWS))
        new = pick(self.new_keys, self.keys).where(~any_null(self.keys)).select("*", F.lit(False).alias("__known"), F.lit(1).alias(_ROWS))
        keys = known.unionByName(new).groupBy(*[quoted(k) for k in self.keys]).agg(F.max("__known").alias("__known"), F.sum(_ROWS).alias(_ROWS))
        return keys.where("NOT __known").select(F.lit("insert").alias(ACTION), _ROWS)

    def counts(self) -> DataFrame:
        """One row: matched, changed, inserted and deleted rows."""
        if self.new_keys is None:
            rows = self.change_set().select(ACTION, F.lit(1).cast("long").alias(_ROWS))
        else:
            nulls = self.null_key_rows.where(any_null(self.keys)).select(F.lit("insert").alias(ACTION))
            alone = reduce(lambda a, b: a.union(b), [*(p.select(ACTION) for p in self._matched_set()), nulls])
            rows = alone.select(ACTION, F.lit(1).cast("long").alias(_ROWS)).unionByName(self._inserts_by_key())
        action = F.col(ACTION)
        total = lambda which: F.coalesce(F.sum(F.when(which, F.col(_ROWS))), F.lit(0).cast("long"))
        return rows.agg(
            total(action.isin("update", "unchanged")).alias("rows_matched"),
            total(action == "update").alias("rows_changed"),
            total(action == "insert").alias("rows_inserted"),
            total(action == "delete").alias("rows_deleted"),
        )
