"""Matching a source to a target on key columns, at scale.

Three things keep one hot key from ending in one task:

* source duplicates collapse with partial aggregation before the shuffle;
* target keys are made distinct (again map side first) before an anti join;
* the wide join of target and source has an extra join key. It spreads target
  rows with a NULL key, which match nothing but would all hash to one
  partition, and it makes both join inputs plain shuffles, the form in which
  adaptive execution splits a skewed partition of the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import AtomicType, StructType

from framestore.errors import InvalidInputError
from framestore.functions.project import ident, pick, project

HIT = "__hit"
_SPREAD = "__spread"
_SPREAD_SIZE = 4096


def quoted(name: str) -> Column:
    return F.col(ident(name))


def any_null(keys: Sequence[str]) -> Column:
    """True where a key column is NULL. Such a row equals no other row."""
    return F.expr(" OR ".join(f"{ident(k)} IS NULL" for k in keys))


def row_struct(columns: Sequence[str]) -> Column:
    return F.expr(f"struct({', '.join(ident(c) for c in columns)})")


def atomic_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, AtomicType)]


def order_struct(order_by: Sequence[str], df: DataFrame) -> Column:
    """The row order as one sortable value; the row hash makes ties deterministic."""
    names = ", ".join(ident(c) for c in order_by)
    atoms = ", ".join(ident(c) for c in atomic_columns(df))
    return F.expr(f"struct({names}, xxhash64({atoms}) AS __tie)")


def align_types(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast columns of `df` to the type of the column of the same name in `schema`."""
    types = {f.name: f.dataType for f in schema}
    if all(f.name not in types or f.dataType == types[f.name] for f in df.schema):
        return df
    return project(
        df,
        {
            f.name: f"CAST({ident(f.name)} AS {types[f.name].simpleString()})"
            if f.name in types and f.dataType != types[f.name]
            else ident(f.name)
            for f in df.schema
        },
    )


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on `keys` that tolerates a hot or NULL key on the left.

    `right` should hold each key once. `how` is 'left', 'inner', 'left_semi' or
    'left_anti'.
    """
    nulls = " OR ".join(f"{ident(k)} IS NULL" for k in keys)
    atoms = ", ".join(ident(c) for c in atomic_columns(left))
    scattered = f"CAST(pmod(xxhash64({atoms}), {_SPREAD_SIZE}) AS INT)"
    left = left.selectExpr("*", f"CASE WHEN {nulls} THEN {scattered} ELSE 0 END AS {_SPREAD}")
    # Always 0, but not a constant that the optimizer would remove from the join keys.
    names = ", ".join(ident(k) for k in keys)
    right = right.where(f"NOT ({nulls})").selectExpr("*", f"CAST(pmod(xxhash64({names}), 1) AS INT) AS {_SPREAD}")
    return left.join(right, [*keys, _SPREAD], how).drop(_SPREAD)


def hot_keys(target: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The keys that hold more rows than an average bucket: fewer than `buckets`, whatever the table.

    Only the key columns are read, and counted before they are shuffled.
    """
    counted = target.where(~any_null(keys)).groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("__n"))
    total = counted.agg(F.sum("__n").alias("__total"))
    return pick(counted.join(F.broadcast(total), F.col("__n") * buckets > F.col("__total")), keys)


def bucketed_join(target: DataFrame, keyed: DataFrame, keys: Sequence[str], how: str, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join of a target that is bucketed by `keys`, which stays where it is; `keyed` has each key once. `how` is 'left' or 'inner'.

    Rows with a NULL key match nothing and go around the join. Those of `hot` keys meet a broadcast of their few source rows. Neither
    branch reads the table by buckets, so one key or NULL is not the work of one task.
    """
    names = list(keys)
    plain = target.where(~any_null(keys))
    if hot is None:
        joined = plain.join(keyed, names, how)
    else:
        few = F.broadcast(hot)
        joined = plain.join(few, names, "left_anti").join(keyed, names, how).unionByName(
            plain.join(few, names, "left_semi").join(F.broadcast(keyed.join(few, names, "left_semi")), names, how)
        )
    if how == "inner":
        return joined
    missing = {f.name: F.lit(None).cast(f.dataType) for f in keyed.schema if f.name not in names}
    return joined.unionByName(target.where(any_null(keys)).withColumns(missing))


def target_keys(target: DataFrame, keyed: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """The distinct keys of `target` that an anti join with `keyed` needs.

    With a small source, only the keys that the source holds survive a semi join
    (broadcast by Spark's own size check), so nothing large is shuffled.
    """
    wanted = pick(target, keys).where(~any_null(keys))
    if small:
        wanted = wanted.join(pick(keyed, keys), list(keys), "left_semi")
    return wanted.distinct()


def unmatched(rows: DataFrame, target: DataFrame, keys: Sequence[str], small: bool, unique_rows: bool) -> DataFrame:
    """Rows (without NULL keys) whose key is not in `target`: NOT EXISTS as an anti join."""
    present = target_keys(target, rows, keys, small)
    if unique_rows:
        return rows.join(present, list(keys), "left_anti")
    return spread_join(rows, present, keys, "left_anti")


def collapse(
    rows: DataFrame,
    keys: Sequence[str],
    picks: dict[str, tuple[str, Sequence[str]]],
    order_by: Sequence[str] | None,
    on_duplicate: str,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per key: key columns and one struct per entry of `picks`.

    `picks` maps an output name to ('first' or 'last', columns). Rows with a NULL
    key are dropped. `on_duplicate`: 'unique' trusts the source and does not
    aggregate, 'error' fails the query at the first key that occurs twice,
    'sequential' picks by `order_by`.
    """
    rows = rows.where(~any_null(keys))
    key_columns = [quoted(k) for k in keys]
    if on_duplicate == "unique":
        return rows.select(*key_columns, *[row_struct(cols).alias(n) for n, (_, cols) in picks.items()])
    if on_duplicate == "error":
        # The keys alone are counted, in a subquery of one value; the rows are not grouped.
        text = F.to_json(F.struct(*key_columns))
        repeated = rows.groupBy(*key_columns).agg(F.count("*").alias("__n")).where("__n > 1").agg(F.first(text)).scalar()
        message = F.concat(F.lit(f"The source holds a key more than once, key columns {list(keys)}: "), repeated)
        rows = rows.where(F.when(repeated.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
        return rows.select(*key_columns, *[row_struct(cols).alias(n) for n, (_, cols) in picks.items()])
    if not order_by:
        raise InvalidInputError("order_by is needed to apply duplicate keys one after the other")
    order = order_struct(order_by, rows)
    choose = {"first": F.min_by, "last": F.max_by}
    return rows.groupBy(*key_columns).agg(
        *[choose[how](row_struct(cols), order).alias(n) for n, (how, cols) in picks.items()], *extra
    )
