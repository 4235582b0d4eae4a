"""Upsert and merge against a row-at-a-time simulation on random data."""

from __future__ import annotations

import random

import pytest

from framestore.operators import merge, update, upsert
from framestore.operators.fold import Run

SCHEMA = "k int, k2 string, a int, b string, c double"
NAMES = ["k", "k2", "a", "b", "c"]
KEYS, VALUES = ["k", "k2"], ["a", "b", "c"]


def random_rows(rng, n, n_keys, null_share=0.15, hot_share=0.3):
    rows = []
    for _ in range(n):
        hot = rng.random() < hot_share
        key = None if rng.random() < 0.05 else 0 if hot else rng.randrange(n_keys)
        maybe = lambda v: None if rng.random() < null_share else v
        rows.append((key, maybe("x") and rng.choice("xy"), maybe(rng.randrange(3)), maybe(rng.choice("pq")),
                     maybe(float(rng.randrange(2)))))
    return rows


def matches(row, source):
    return all(row[k] is not None and row[k] == source[k] for k in KEYS)


def differs(row, source):
    return any(row[c] is not None and source[c] is not None and row[c] != source[c] for c in VALUES)


def simulate_upsert(target, source, chunksize, update_only=False):
    table = [dict(zip(NAMES, r)) for r in target]
    rows = [dict(zip(NAMES, r)) for r in source]
    size = chunksize or max(len(rows), 1)
    for start in range(0, len(rows), size):
        chunk = rows[start:start + size]
        for s in chunk:
            for t in table:
                if matches(t, s):
                    t.update({c: s[c] for c in VALUES})
        for s in [] if update_only else chunk:
            if not any(matches(t, s) for t in table):
                table.append(dict(s))
    return as_sorted(table)


def simulate_merge(target, source, only_changed):
    table = [dict(zip(NAMES, r)) for r in target]
    for s in (dict(zip(NAMES, r)) for r in source):
        hits = [t for t in table if matches(t, s)]
        for t in hits:
            if not only_changed or differs(t, s):
                t.update({c: s[c] for c in VALUES})
        if not hits:
            table.append(dict(s))
    return as_sorted(table)


def as_sorted(table):
    return sorted((tuple(r[n] for n in NAMES) for r in table), key=repr)


def collected(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.select(*NAMES).collect()), key=repr)


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rng = random.Random(request.param)
    target, source = random_rows(rng, 150, 40), random_rows(rng, 250, 60)
    target_df = spark.createDataFrame(target, SCHEMA)
    source_df = spark.createDataFrame([(i, *r) for i, r in enumerate(source)], "ord int, " + SCHEMA).repartition(5)
    return target, source, target_df, source_df


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("chunksize", [None, 1, 7, 1000])
def test_upsert_equals_row_by_row(spark, case, chunksize, broadcast):
    target, source, target_df, source_df = case
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if broadcast else "-1")
    try:
        got = upsert(target_df, source_df, KEYS, NAMES, order_by="ord", chunksize=chunksize)
        assert collected(got) == simulate_upsert(target, source, chunksize)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_update_only_equals_row_by_row(case):
    target, source, target_df, source_df = case
    got = update(target_df, source_df, KEYS, NAMES, order_by="ord")
    assert collected(got) == simulate_upsert(target, source, None, update_only=True)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("only_changed", [True, False])
def test_merge_equals_row_by_row(spark, case, only_changed, broadcast):
    target, source, target_df, source_df = case
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if broadcast else "-1")
    try:
        got = merge(
            target_df, source_df, KEYS, NAMES, order_by="ord", omit_update_where_clause=not only_changed
        )
        assert collected(got) == simulate_merge(target, source, only_changed)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_run_summaries_combine_in_any_grouping():
    rng = random.Random(5)
    value = lambda: rng.choice([None, 0, 1, 2])
    for _ in range(3000):
        rows = [(value(), value(), value()) for _ in range(rng.randrange(1, 9))]
        cut = sorted(rng.sample(range(1, len(rows)), rng.randrange(len(rows)))) if len(rows) > 1 else []
        blocks = [rows[i:j] for i, j in zip([0, *cut], [*cut, len(rows)])]
        runs = []
        for block in blocks:
            run = Run(block[0])
            for row in block[1:]:
                run.extend(Run(row))
            runs.append(run)
        total = runs[0]
        for run in runs[1:]:
            total.extend(run)
        for start in [(value(), value(), value()) for _ in range(5)]:
            x = start
            for s in rows:
                if any(p is not None and q is not None and p != q for p, q in zip(x, s)):
                    x = s
            assert total.apply(start) == x
        end = rows[0]
        for s in rows[1:]:
            if any(p is not None and q is not None and p != q for p, q in zip(end, s)):
                end = s
        assert total.end == end
