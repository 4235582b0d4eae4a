"""What the similarity join keeps on disk beside its input."""

from __future__ import annotations

import random

import numpy as np
import pytest

from framestore.llm.jaccard import filter_bits, jaccard_components, least_difference, marks, possible
from framestore.llm.parts import kept_by_part
from framestore.session import passing_tables, path_exists, shuffles_dropped, stage, staged_paths

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = (files.apply(i).getName() for i in range(files.size()))
    return {x for x in found if x.startswith("shuffle_")}


def texts():
    """80 texts of 400 words; of each half, the second 20 differ from the first by one word."""
    r = random.Random(4)
    first = [[f"w{r.randrange(10**6)}" for _ in range(400)] for _ in range(40)]
    near = [[*w[:200], "other", *w[201:]] for w in first]
    return [(i, " ".join(w)) for i, w in enumerate([*first, *near])]


def test_large_tables_and_shuffles_go_before_the_result_is_read(spark):
    before, files = spark.conf.get(SETTING), shuffle_files(spark)
    with staged_paths() as paths:
        df = jaccard_components(spark.createDataFrame(texts(), "doc_id bigint, text string").repartition(3))
    assert not shuffle_files(spark) - files
    assert spark.conf.get(SETTING) == before
    # The tables that are left hold neither shingles nor the lists and pairs of sets.
    left = [spark.read.parquet(p).columns for p in paths if path_exists(spark, p)]
    assert left and not [c for c in left if {"first", "shingles", "keys", "key", "place"} & {*c}]
    assert {r["doc_id"]: r["component_id"] for r in df.collect()} == {i: i % 40 for i in range(80)}


def test_the_filter_grows_with_the_sets():
    assert filter_bits(0) == 20
    # 57,935 sets of 0.51 GB, twelve times as many of 6 GB.
    for n in (57_935, 12 * 57_935, 60 * 57_935):
        assert n / 2 ** filter_bits(n) <= 1 / 16
    assert filter_bits(10**9) == 27


def test_passing_tables_go_but_those_that_are_kept(spark):
    with staged_paths() as outer, passing_tables(spark) as kept:
        stage(spark.range(3), "gone")
        df, path = stage(spark.range(4), "stays")
        kept.append(path)
    stage(spark.range(2), "later")
    assert [path_exists(spark, p) for p in outer] == [False, True] and df.count() == 4


def test_passing_tables_go_when_a_statement_fails(spark):
    with staged_paths() as paths, pytest.raises(ValueError), passing_tables(spark):
        stage(spark.range(3), "gone")
        raise ValueError
    assert [path_exists(spark, p) for p in paths] == [False]


def test_parts_go_at_the_end_unless_they_last(spark):
    for lasting in (True, False):
        with staged_paths() as paths:
            with kept_by_part(spark.range(10), lasting=lasting) as (kept, plain):
                assert kept.count() == plain.count() == 10
        assert [path_exists(spark, p) for p in paths] == [lasting]


def test_the_setting_comes_back(spark):
    before = spark.conf.get(SETTING)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        assert spark.conf.get(SETTING) == "true"
        raise ValueError
    assert spark.conf.get(SETTING) == before


def sets_of_many_sizes():
    """(x, y): y has some of the shingles of x, or none, and others of its own."""
    r = np.random.default_rng(8)
    for size in [1, 2, 5, 9, 30, 64, 65, 130, 500, 1023, 1025, 5000]:
        x = r.integers(0, 2**63, size).astype(np.uint64)
        for share in (0, 0.3, 0.6, 0.8, 0.88, 0.9, 0.95, 1):
            for other in (0, size // 20, size // 9, size // 4):
                yield np.unique(x), np.unique(np.concatenate([x[: int(share * size)], r.integers(0, 2**63, other + (share == 0)).astype(np.uint64)]))


def test_marks_never_say_more_than_sets_differ():
    told = 0
    for x, y in sets_of_many_sizes():
        d = least_difference(marks(x), marks(y))
        assert d <= len(np.setxor1d(x, y)) and d == least_difference(marks(y), marks(x))
        told += 9 * d > len(x) + len(y)
        linked = 9 * len(np.intersect1d(x, y)) >= 4 * (len(x) + len(y))
        assert not linked or 9 * d <= len(x) + len(y)
    assert told > 100


def test_pairs_of_a_common_passage_do_not_move_whole_sets(spark):
    r = np.random.default_rng(9)
    passage = r.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([passage, r.integers(0, 2**63, 90).astype(np.uint64)])) for _ in range(60)]
    sets.append(sets[7][:-3])
    rows = [(i, len(s), bytearray(marks(s))) for i, s in enumerate(sets)]
    classes = spark.createDataFrame(rows, "class bigint, size int, marks binary")
    pairs = spark.createDataFrame([(a, b) for a in range(61) for b in range(a + 1, 61)], "a bigint, b bigint")
    assert [tuple(p) for p in possible(pairs, classes).collect()] == [(7, 60)]
