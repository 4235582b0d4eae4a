"""Changes by files, batches that are applied once, counts of the written files, and references to removed rows."""

from __future__ import annotations

import itertools
import os

import pytest
from pyspark.sql import functions as F

from framestore import ChangeCounts, Constraints, ForeignKey, TableStore
from framestore.errors import DeleteFromTableError, ExecuteStatementError, SaveDataFrameError
from framestore.sinks import journal, publish
from framestore.streaming import upsert_stream

_numbers = itertools.count()


@pytest.fixture
def store(spark, tmp_path):
    name = f"files_{next(_numbers)}"
    yield TableStore(spark, name, location=f"{tmp_path}/{name}")
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ranged(spark, n=4000, parts=4):
    """Numbers and their squares; a file per range."""
    return spark.range(0, n, 1, parts).select("id", (F.col("id") * 2).alias("v"))


def listing(store, table):
    folder = publish.table_info(store.spark, store.qualified(table)).location.removeprefix("file:")
    return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder) if f.startswith("part-")}, folder


# By files ---------------------------------------------------------------------------


@pytest.mark.parametrize("method", ["upsert_table", "merge_df"])
def test_untouched_files_keep_name_and_time(store, spark, method):
    store.save_df(ranged(spark), "t")
    before, folder = listing(store, "t")
    source = spark.createDataFrame([(5, -1), (6, 12), (9000, 1), (None, 7)], "id long, v long")
    counts = getattr(store, method)(source, "t", "id", rewrite="files")
    assert counts == ChangeCounts(2, 1, 2, 0)
    after, folder_after = listing(store, "t")
    assert folder_after == folder
    kept = set(before) & set(after)
    assert len(before) == 4 and len(kept) == 3 and all(before[f] == after[f] for f in kept)
    expected = {i: 2 * i for i in range(4000)} | {5: -1, 9000: 1}
    assert rows(store.load_table("t")) == sorted([*expected.items(), (None, 7)], key=repr)
    assert not [f for f in os.listdir(folder) if f.startswith("_framestore_")]


def test_only_inserts_add_files_and_no_change_reads_all(store, spark):
    store.save_df(ranged(spark), "t")
    before, _ = listing(store, "t")
    new = spark.createDataFrame([(-1, 0)], "id long, v long")
    assert store.upsert_table(new, "t", "id", rewrite="files") == ChangeCounts(0, 0, 1, 0)
    after, _ = listing(store, "t")
    assert before.items() <= after.items() and len(after) > len(before)
    assert store.upsert_table(new.where("false"), "t", "id", rewrite="files") == ChangeCounts(0, 0, 0, 0)
    assert store.upsert_table(new, "t", "id", rewrite="files", update_only=True) == ChangeCounts(1, 0, 0, 0)
    assert store.load_table("t").count() == 4001


def test_delete_by_files(store, spark):
    store.save_df(ranged(spark), "t")
    before, _ = listing(store, "t")
    store.delete_rows(spark.createDataFrame([(7,), (8,), (None,), (99999,)], "id int"), "t", "id", rewrite="files")
    after, _ = listing(store, "t")
    assert len(set(before) & set(after)) == 3 and store.load_table("t").where("id IN (7, 8)").count() == 0
    assert store.load_table("t").count() == 3998
    store.delete_rows(spark.createDataFrame([(99999,)], "id int"), "t", "id", rewrite="files")
    assert listing(store, "t")[0] == after


def test_all_files_touched_publish_a_version(store, spark):
    store.save_df(ranged(spark, 40), "t")
    old = store.load_table("t")
    assert store.upsert_table(ranged(spark, 40).withColumn("v", F.lit(1)), "t", "id", rewrite="files").rows_changed == 40
    assert old.agg(F.sum("v")).first()[0] == 40 * 39 and store.load_table("t").agg(F.sum("v")).first()[0] == 40


def test_partitioned_and_bucketed_tables_are_written_as_before(store, spark):
    source = spark.createDataFrame([(5, -1)], "id long, v long")
    store.save_df(ranged(spark, 40).withColumn("p", F.col("id") % 2), "parts", partition_by="p")
    store.upsert_table(source.withColumn("p", F.lit(1).cast("long")), "parts", ["id", "p"], rewrite="files")
    store.save_df(ranged(spark, 40), "buckets", bucket_by=(2, "id"))
    store.upsert_table(source, "buckets", "id", rewrite="files")
    for t in ("parts", "buckets"):
        assert store.load_table(t).count() == 40 and store.load_table(t).where("id = 5").first()["v"] == -1


def test_other_keys_are_checked_in_all_files(store, spark):
    store.save_df(ranged(spark), "t")
    store.declare("t", Constraints(primary_key="id", unique=[("v",)]))
    with pytest.raises(ExecuteStatementError, match="UNIQUE"):
        store.upsert_table(spark.createDataFrame([(5, 7998)], "id long, v long"), "t", "id", rewrite="files")
    assert store.load_table("t").where("id = 5").first()["v"] == 10


def test_an_exchange_that_failed_half_way_is_completed(store, spark, monkeypatch):
    store.save_df(ranged(spark), "t")
    source = spark.createDataFrame([(5, -1)], "id long, v long")

    def stop(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(journal, "finish_exchange", stop)
        with pytest.raises(ExecuteStatementError, match="lost"):
            store.upsert_table(source, "t", "id", rewrite="files", batch=("s", 3))
    # Half of the steps were done.
    _, folder = listing(store, "t")
    change = journal.read_json(spark, f"{folder}/_framestore_commit")
    os.remove(f"{folder}/{change['removed'][0]}")
    assert store.upsert_table(source, "t", "id", rewrite="files", batch=("s", 3)) is None
    assert store.load_table("t").count() == 4000 and store.load_table("t").where("id = 5").first()["v"] == -1
    assert not os.path.exists(f"{folder}/_framestore_commit") and not os.path.exists(change["folder"].removeprefix("file:"))


# By partitions -------------------------------------------------------------------------


def parted(spark, n=40):
    p = F.when(F.col("id") % 4 != 3, F.concat(F.lit("it's a/b = "), (F.col("id") % 4).cast("string")))
    return spark.range(n).select("id", (F.col("id") * 2).alias("v"), p.alias("p"), (F.col("id") % 2).cast("int").alias("q"))


def folders(store, table):
    rows = store.spark.sql(f"SHOW PARTITIONS {store.qualified(table)}").collect()
    return {r["partition"]: publish._partition_location(store.spark, store.qualified(table), r["partition"]) for r in rows}


def test_partitions_are_written_once_and_pointed_at(store, spark):
    store.save_df(parted(spark), "t", partition_by=["p", "q"])
    before, old = folders(store, "t"), store.load_table("t")
    some = parted(spark, 44).where("id % 4 IN (1, 3) AND id > 20")
    changed = some.withColumn("v", F.when(F.col("id") < 30, -1).otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([(0, 7, "new", 5)], "id long, v long, p string, q int"))
    assert store.upsert_table(changed, "t", ["id", "p", "q"]) == ChangeCounts(5, 3, 8, 0)  # a NULL in a key matches nothing
    after = folders(store, "t")
    assert {p for p in before if before[p] == after[p]} == {p for p in before if p.endswith(("0/q=0", "2/q=0"))} and len(after) == 5
    expected = [x for x in rows(parted(spark)) if x[0] not in range(21, 40, 4)] + rows(changed)
    assert rows(store.load_table("t")) == sorted(expected, key=repr)
    # The folders before stay until the next change of partitions; a frame looks the partitions up when it is read.
    assert all(os.path.isdir(f.removeprefix("file:")) for f in before.values()) and old.count() == 48
    store.save_df(store.load_table("t").where("q = 1"), "t", "replace")
    assert rows(store.load_table("t")) == sorted([x for x in expected if x[3] == 1], key=repr)
    store.save_df(parted(spark, 4), "t")  # appended to where the partitions are now
    assert store.load_table("t").count() == len([x for x in expected if x[3] == 1]) + 4
    store.delete_all_records_from_table("t")
    assert store.load_table("t").count() == 0


def test_a_change_of_partitions_that_failed_half_way_is_completed(store, spark, monkeypatch):
    store.save_df(parted(spark), "t", partition_by="p")
    changed = parted(spark).where("id % 4 IN (1, 3)").withColumn("v", F.lit(-1)).unionByName(
        spark.createDataFrame([(None, 7, "new", 5)], "id long, v long, p string, q int"))

    calls = []

    def stop(*_):
        calls.append(1)
        if len(calls) > 1:  # the first call looks for what an earlier change left
            raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(publish, "_finish_partitions", stop)
        with pytest.raises(ExecuteStatementError, match="lost"):
            store.upsert_table(changed, "t", ["id", "p"], batch=("s", 0))
    assert store.load_table("t").count() == 40
    assert store.upsert_table(changed, "t", ["id", "p"], batch=("s", 0)) is None
    assert store.load_table("t").where("v = -1").count() == 20 and store.load_table("t").count() == 51


# Counts -----------------------------------------------------------------------------


@pytest.mark.parametrize("rewrite", ["table", "files"])
def test_counts_need_no_listener(store, spark, rewrite):
    """The listeners of queries, which observed metrics travel by, are taken away."""
    store.save_df(ranged(spark), "t")
    spark._jsparkSession.listenerManager().clear()
    source = spark.range(-10, 10).select("id", F.when(F.col("id") < 5, 0).otherwise(F.col("id") * 2).alias("v"))
    assert store.upsert_table(source, "t", "id", rewrite=rewrite) == ChangeCounts(10, 4, 10, 0)
    assert store.load_table("t").columns == ["id", "v"]
    assert store.merge_df(source, "t", "id", delete_unmatched=True) == ChangeCounts(20, 0, 0, 3990)


def test_counts_of_formats_without_column_names(store, spark):
    spark.sql(f"CREATE TABLE {store.qualified('c')} (id BIGINT, v BIGINT) USING csv")
    store.save_df(ranged(spark, 10), "c")
    assert store.upsert_table(ranged(spark, 12).withColumn("v", F.lit(0)), "c", "id") == ChangeCounts(10, 9, 2, 0)
    assert store.load_table("c").agg(F.sum("v"), F.count("v")).first() == (0, 12)


# Batches ----------------------------------------------------------------------------


@pytest.mark.parametrize("layout", [{}, {"partition_by": "v"}, {"bucket_by": (2, "id")}])
@pytest.mark.parametrize("rewrite", ["table", "files"])
def test_a_batch_is_applied_once(store, spark, layout, rewrite):
    store.save_df(spark.createDataFrame([(1, 1), (2, 2)], "id long, v long").repartition(2), "t", **layout)
    batch = spark.createDataFrame([(1, 5), (None, 6)], "id long, v long")
    for number, expected in ((0, 3), (0, 3), (1, 4), (0, 4), (1, 4)):
        store.upsert_table(batch, "t", "id", batch=("a", number), rewrite=rewrite)
        assert store.load_table("t").count() == expected
    store.save_df(store.load_table("t"), "t", "replace")
    assert store.upsert_table(batch, "t", "id", batch=("a", 1)) is None
    assert store.upsert_table(batch, "t", "id", batch=("b", 0)).rows_inserted == 1


def test_a_replayed_stream_changes_nothing(store, spark, tmp_path):
    store.save_df(spark.createDataFrame([], "id long, v long"), "t")
    folder, checkpoint = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    spark.createDataFrame([(1, 1), (None, 2)], "id long, v long").coalesce(1).write.parquet(folder)

    def run():
        stream = spark.readStream.schema("id long, v long").parquet(folder)
        upsert_stream(stream, store, "t", "id", checkpoint).awaitTermination()
        return rows(store.load_table("t"))

    assert run() == [(1, 1), (None, 2)]
    for f in os.listdir(f"{checkpoint}/commits"):
        os.remove(f"{checkpoint}/commits/{f}")  # as if the driver was lost after the table had changed
    assert run() == [(1, 1), (None, 2)]
    spark.createDataFrame([(1, 7), (None, 3)], "id long, v long").coalesce(1).write.mode("append").parquet(folder)
    assert run() == [(1, 7), (None, 2), (None, 3)]


# References -------------------------------------------------------------------------


@pytest.fixture
def family(store, spark):
    store.save_df(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string"), "parent")
    store.save_df(spark.createDataFrame([(10, 1), (11, 1), (12, None)], "id int, parent int"), "child")
    store.declare("child", Constraints(foreign_keys=[ForeignKey("parent", "parent", "id")]))
    store.manage_foreign_keys("ON")
    return store


def gone(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


@pytest.mark.parametrize("rewrite", ["table", "files"])
def test_parents_with_children_stay(family, spark, rewrite):
    with pytest.raises(DeleteFromTableError, match="child REFERENCES parent") as e:
        family.delete_rows(gone(spark, 1, 2), "parent", "id", rewrite=rewrite)
    assert list(e.value.data.values()) == [(1, [{"parent": 1, "n_rows": 2}])]
    assert family.load_table("parent").count() == 3
    family.delete_rows(gone(spark, 2), "parent", "id", rewrite=rewrite)
    with pytest.raises(DeleteFromTableError):
        family.delete_all_records_from_table("parent")
    assert family.load_table("parent").count() == 2
    family.manage_foreign_keys("OFF")
    family.delete_all_records_from_table("parent")
    assert family.load_table("parent").count() == 0


@pytest.mark.parametrize("if_exists", ["replace", "drop-replace"])
def test_replaced_parents_must_hold_what_children_refer_to(family, spark, if_exists):
    with pytest.raises(SaveDataFrameError, match="child REFERENCES"):
        family.save_df(spark.createDataFrame([(2, "b")], "id int, name string"), "parent", if_exists)
    assert family.load_table("parent").count() == 3
    family.save_df(spark.createDataFrame([(1, "x")], "id int, name string"), "parent", if_exists)
    assert rows(family.load_table("parent")) == [(1, "x")]


def test_changes_of_parents(family, spark):
    source = spark.createDataFrame([("a", 7), ("c", 8)], "name string, id int")
    with pytest.raises(ExecuteStatementError, match="child REFERENCES"):
        family.upsert_table(source, "parent", "name")
    assert family.upsert_table(source.where("name = 'c'"), "parent", "name").rows_changed == 1
    # The key goes from one row to another: it is not gone.
    swap = spark.createDataFrame([("a", 2), ("b", 1)], "name string, id int")
    assert family.upsert_table(swap, "parent", "name").rows_changed == 2
    with pytest.raises(ExecuteStatementError, match="child REFERENCES"):
        family.merge_df(spark.createDataFrame([(2, "a")], "id int, name string"), "parent", "id", delete_unmatched=True)
    assert family.merge_df(gone(spark, 1).withColumn("name", F.lit("z")), "parent", "id", delete_unmatched=True).rows_deleted == 2


def test_a_table_that_refers_to_itself(store, spark):
    store.save_df(spark.createDataFrame([(1, None), (2, 1), (3, 2)], "id int, boss int"), "t")
    store.declare("t", Constraints(primary_key="id", foreign_keys=[ForeignKey("boss", "t", "id")]))
    store.manage_foreign_keys("ON")
    with pytest.raises(DeleteFromTableError):
        store.delete_rows(gone(spark, 1), "t", "id")
    store.delete_rows(gone(spark, 2, 3), "t", "id")
    assert rows(store.load_table("t")) == [(1, None)]
    store.delete_all_records_from_table("t")
    assert store.load_table("t").count() == 0


# Statements for many parameter sets ----------------------------------------------------


def test_updates_and_deletes_for_many_sets(store, spark):
    store.save_df(ranged(spark, 10).withColumn("s", F.lit("x")), "t")
    name = store.qualified("t")
    sets = [{"i": 1, "a": 5}, {"i": 2, "a": 6}, {"i": 1, "a": 7}, {"i": None, "a": 8}, {"i": 99, "a": 9}]
    done = store.execute(f"UPDATE {name} AS q SET v = :a + 1, s = ':a' || \"'\" WHERE q.id = :i", sets)
    assert done.first()["num_affected_rows"] == 2
    assert rows(store.load_table("t").where("s <> 'x'")) == [(1, 8, ":a'"), (2, 7, ":a'")]
    store.execute(f"DELETE FROM {name} WHERE :a = v AND id = :i", [{"i": 1, "a": 8}, {"i": 2, "a": 8}, {"i": 3, "a": 6}])
    assert rows(store.load_table("t").select("id").where("id < 5")) == [(0,), (2,), (4,)]
    store.declare("t", Constraints(checks={"small": "v < 100"}))
    with pytest.raises(ExecuteStatementError, match="small"):
        store.execute(f"UPDATE {name} SET v = :a WHERE id = :i", [{"i": 4, "a": 100}])


@pytest.mark.parametrize("sql", [
    "UPDATE t SET v = v + :a WHERE id = :i", "UPDATE t SET v = :a", "UPDATE t SET v = :a WHERE id > :i", "UPDATE t SET id = :a WHERE id = :i",
    "DELETE FROM t", "DELETE FROM t WHERE id = :i OR v = :a", "SELECT :a, :i", "UPDATE t SET v = :a WHERE id = :i AND id = :a",
])
def test_statements_that_are_no_change_on_keys(store, spark, sql):
    store.save_df(ranged(spark, 10), "t")
    from framestore.errors import InvalidInputError

    with pytest.raises(InvalidInputError):
        store.execute(sql.replace(" t", f" {store.qualified('t')}", 1), [{"i": 1, "a": 2}])


# Rules ------------------------------------------------------------------------------


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup("counted", "")
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    run()
    found = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    spark.sparkContext.setJobGroup("other", "")
    return len(found)


def test_rules_look_at_what_was_written(store, spark):
    """The number of jobs does not grow with rules of rows, and broken rules leave no folder behind."""
    store.save_df(ranged(spark, 400).withColumn("w", F.col("id")), "t")
    source = ranged(spark, 500).where("id > 350").withColumn("v", F.lit(1)).withColumn("w", F.col("id"))
    store.declare("t", Constraints(checks={"a": "v < 5"}))
    few = jobs_of(spark, lambda: store.upsert_table(source, "t", "id"))
    store.declare("t", Constraints(primary_key="id", not_null=["v", "w"], checks={"a": "v < 5", "b": "w >= 0", "c": "id < 10000"}))
    assert jobs_of(spark, lambda: store.upsert_table(source, "t", "id")) == few
    store.declare("t", Constraints(primary_key="id", unique=[("w",)], checks={"a": "v < 5"}))
    names = set(os.listdir(os.path.dirname(listing(store, "t")[1])))
    for rewrite in ("table", "files"):
        with pytest.raises(ExecuteStatementError, match="UNIQUE") as e:
            store.upsert_table(spark.createDataFrame([(399, 1, 7), (398, 1, 8)], "id long, v long, w long"), "t", "id", rewrite=rewrite)
        assert e.value.data["UNIQUE(w)"][0] == 2
        with pytest.raises(ExecuteStatementError, match="CHECK"):
            store.upsert_table(source.withColumn("v", F.lit(7)), "t", "id", rewrite=rewrite)
    assert set(os.listdir(os.path.dirname(listing(store, "t")[1]))) == names
    assert store.load_table("t").where("v > 5").count() == 348
