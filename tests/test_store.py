"""Save, load, execute, upsert and merge on catalog tables."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from framestore import ChangeCounts, Constraints, ForeignKey, TableStore
from framestore.errors import (
    DataTypeConversionError,
    DeleteFromTableError,
    ExecuteStatementError,
    InvalidColumnNameError,
    InvalidInputError,
    InvalidTableNameError,
    LoadTableError,
    SaveDataFrameError,
    SetIndexError,
    SourceNotFoundError,
    SQLStatementNotSupportedError,
    TableExistsError,
)
from framestore.session import delete_scratch
from framestore.sinks.publish import vacuum

_numbers = itertools.count()

PEOPLE = [
    (1, "Ada", "1990-07-14", "North", True),
    (2, "Ben", "1970-01-14", "South", False),
    (3, "Cora", "1968-12-13", "South", False),
    (4, "Dan", "1996-03-24", "South", False),
    (5, "Eve", "2006-05-31", "East", True),
    (6, "Finn", "2007-08-20", "West", True),
]
CHANGED = [
    (2, "Ben", "1972-01-14", "South", False),
    (3, "Cora", "1962-05-13", "Hill", False),
    (4, "Dan", "1995-03-24", "Wood", False),
    (5, "Eve", "2006-05-31", "East", False),
    (1, "Ada", "1990-07-14", "North", True),
    (6, "Finn", "2007-08-20", "West", True),
    (7, "Gus", "1969-06-20", "Sand", False),
    (8, "Hal", "1983-04-30", "Lake", False),
]
SCHEMA = "id int, name string, born string, place string, adventurer boolean"


@pytest.fixture
def store(spark, tmp_path):
    name = f"shop_{next(_numbers)}"
    yield TableStore(spark, name, location=f"{tmp_path}/{name}")
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, SCHEMA)


@pytest.fixture
def changed(spark):
    return spark.createDataFrame(CHANGED, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_save_and_load_round_trip(store, people):
    store.save_df(people, "person")
    assert rows(store.load_table("person")) == sorted(PEOPLE, key=repr)
    assert store.load_table("person", columns=("name", "id")).columns == ["name", "id"]
    assert store.load_table("person", index_col=["place", "id"]).columns[:2] == ["place", "id"]


def test_append_fills_missing_columns_with_null(store, people, spark):
    store.save_df(people, "person")
    store.save_df(spark.createDataFrame([(True, 9, "Ida")], "adventurer boolean, id int, name string"), "person")
    assert (9, "Ida", None, None, True) in rows(store.load_table("person"))
    with pytest.raises(SaveDataFrameError):
        store.save_df(people.withColumn("unknown", F.lit(1)), "person")


def test_replace_keeps_and_drop_replace_loses_the_definition(store, people, spark):
    name = store.qualified("person")
    spark.sql(f"CREATE TABLE {name} (id BIGINT, name STRING, born STRING, place STRING DEFAULT 'none', "
              "adventurer BOOLEAN) USING parquet TBLPROPERTIES ('note' = 'kept')")
    store.save_df(people, "person")
    store.save_df(store.load_table("person").where("id > 4").drop("place"), "person", "replace")
    assert rows(store.load_table("person").select("id", "place")) == [(5, "none"), (6, "none")]
    assert dict(store.load_table("person").dtypes)["id"] == "bigint"
    properties = {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert "note" in properties
    store.save_df(people.select("id", "name"), "person", "drop-replace")
    assert store.load_table("person").dtypes == [("id", "int"), ("name", "string")]
    assert "note" not in {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    # A failing replace leaves the old rows.
    with pytest.raises(SaveDataFrameError):
        store.save_df(people.select("id", F.raise_error(F.lit("bad")).alias("name")), "person", "replace")
    assert store.load_table("person").count() == 6


def test_save_options(store, people):
    store.save_df(people, "person", index_cols="id", index=False)
    assert "id" not in store.load_table("person").columns
    store.save_df(people, "labelled", index_cols=["id", "name"], index_label=["key", "who"])
    assert store.load_table("labelled").columns[:2] == ["key", "who"]
    store.save_df(people, "typed", dtype={"id": "string"}, chunksize=2)
    assert dict(store.load_table("typed").dtypes)["id"] == "string"
    files = store.load_table("typed").select(F.input_file_name().alias("f"), "id").groupBy("f").count()
    assert files.agg(F.max("count")).first()[0] <= 2
    with pytest.raises(TableExistsError):
        store.save_df(people, "person", "fail")
    for bad in ({"if_exists": "delete"}, {"if_exists": 1}, {"chunksize": 0}, {"chunksize": "2"}, {"method": 3},
                {"index_cols": "id", "index_label": ["a", "b"]}):
        with pytest.raises(InvalidInputError):
            store.save_df(people, "person", **bad)
    with pytest.raises(InvalidInputError):
        store.save_df(people, ["person"])
    with pytest.raises(InvalidTableNameError):
        store.save_df(people, "SELECT * FROM person")


def test_save_with_a_function_per_partition(store, people, tmp_path):
    def write(partition):
        values = [r["name"] for r in partition]
        (tmp_path / f"part-{hash(tuple(values))}").write_text("\n".join(values))

    store.save_df(people.coalesce(1), "person", method=write)
    assert (len(list(tmp_path.glob("part-*")))) == 1


def test_delete(store, people, spark):
    store.save_df(people, "person")
    store.delete_rows(spark.createDataFrame([(1,), (1,), (None,), (99,)], "id int"), "person", "id")
    assert [r[0] for r in rows(store.load_table("person"))] == [2, 3, 4, 5, 6]
    store.delete_all_records_from_table("person")
    assert store.load_table("person").isEmpty() and store.load_table("person").columns == people.columns
    with pytest.raises(DeleteFromTableError):
        store.delete_all_records_from_table("absent")
    with pytest.raises(InvalidTableNameError):
        store.delete_all_records_from_table("DELETE FROM person")


def test_load_query_params_and_errors(store, people):
    store.save_df(people, "person")
    table = store.qualified("person")
    query = f"SELECT id, name FROM {table} WHERE place = :place AND id > :low ORDER BY id;"
    got = store.load_table(query, params={"place": "South", "low": 2, "unused": 1})
    assert [tuple(r) for r in got.collect()] == [(3, "Cora"), (4, "Dan")]
    empty = store.load_table(query, params={"place": "none", "low": 0}, warn_if_empty=True)
    assert empty.isEmpty() and empty.columns == ["id", "name"]
    for bad in ({"sql": "absent"}, {"sql": query, "params": {"p": 1}}, {"sql": 1}, {"sql": "SELECT FROM"},
                {"sql": "person", "columns": ["none"]}):
        with pytest.raises(LoadTableError):
            store.load_table(**bad)
    for bad in ("none", ["id", "none"], 3, [1]):
        with pytest.raises(SetIndexError):
            store.load_table("person", index_col=bad)
    with pytest.raises(DataTypeConversionError):
        store.load_table("person", dtypes={"id": "int64", "none": "string"})
    with pytest.raises(DataTypeConversionError):
        store.load_table("person", dtypes={"name": "int64"}, validate=True)
    with pytest.raises(DataTypeConversionError):
        store.load_table("person", dtypes={"name": "no such type"})


def test_load_in_chunks(store, people):
    store.save_df(people, "person")
    chunks = store.load_table("person", chunksize=4, order_by="id", index_col="name", dtypes={"id": "string"})
    got = [c.collect() for c in chunks]
    assert [[r["id"] for r in c] for c in got] == [[1, 2, 3, 4], [5, 6]]
    assert got[0][0].__fields__[0] == "name"
    store.delete_all_records_from_table("person")
    assert [c.count() for c in store.load_table("person", chunksize=4)] == [0]
    with pytest.raises(InvalidInputError):
        store.load_table("person", chunksize=-1)


def test_execute(store, people, spark):
    table = store.qualified("item")
    store.execute(f"CREATE TABLE IF NOT EXISTS {table} (id INT, label STRING, price DOUBLE DEFAULT 1.5) USING parquet")
    store.execute(f"INSERT INTO {table} (id, label) VALUES (:id, :label)", params={"id": 1, "label": "a"})
    store.execute(f"INSERT INTO {table} (id, label) VALUES (:id, :label);",
                  params=[{"id": 2, "label": "b"}, {"id": 3, "label": None}])
    store.execute(f"INSERT INTO {table} BY NAME SELECT n AS id FROM {{params}}", params=[{"n": 4}])
    got = rows(store.execute(f"SELECT * FROM {table} WHERE id <> :x", params={"x": 9}))
    assert got == [(1, "a", 1.5), (2, "b", 1.5), (3, None, 1.5), (4, None, 1.5)]
    for bad in ("SELECT FROM", f"SELECT * FROM {table} WHERE id = :x"):
        with pytest.raises(ExecuteStatementError):
            store.execute(bad, params={"y": 1})
    with pytest.raises(InvalidInputError):
        store.execute(1)
    with pytest.raises(InvalidInputError):
        store.execute(f"DELETE FROM {table} WHERE id > :x", params=[{"x": 1}])


def test_upsert_updates_and_inserts(store, people, changed):
    store.save_df(people, "person")
    preview = store.upsert_table(changed, "person", "id", dry_run=True)
    counts = {r["_action"]: r["count"] for r in preview.groupBy("_action").count().collect()}
    assert counts == {"update": 4, "unchanged": 2, "insert": 2}
    assert rows(store.load_table("person")) == sorted(PEOPLE, key=repr)
    assert store.upsert_table(changed, "person", ["id"]) == ChangeCounts(6, 4, 2)
    assert rows(store.load_table("person")) == sorted(CHANGED, key=repr)


def test_update_only_and_two_keys(store, people, changed):
    store.save_df(people, "person")
    got = store.upsert_table(changed, "person", ("name", "place"), update_only=True)
    assert got == ChangeCounts(4, 2, 0)
    expected = [CHANGED[0] if p[0] == 2 else CHANGED[3] if p[0] == 5 else p for p in PEOPLE]
    assert rows(store.load_table("person")) == sorted(expected, key=repr)


def test_upsert_missing_values(store, people, spark):
    store.save_df(people, "person")
    source = spark.createDataFrame([(None, "Ben", "x", "y", True), (3, "Cora", None, None, False)], SCHEMA)
    store.upsert_table(source, "person", "id", update_only=True)
    got = {r["id"]: r for r in store.load_table("person").collect()}
    assert tuple(got[2]) == PEOPLE[1]
    assert got[3]["born"] is None and got[3]["place"] is None
    numbers = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id int, x double")
    store.save_df(numbers, "number")
    nan = spark.createDataFrame([(1, float("nan"))], "id int, x double")
    store.upsert_table(nan, "number", "id")
    assert rows(store.load_table("number").where("x IS NULL")) == [(1, None)]
    store.upsert_table(nan, "number", "id", nan_to_none=False)
    assert store.load_table("number").where("isnan(x)").count() == 1


@pytest.mark.parametrize("method", ["upsert_table", "merge_df"])
def test_empty_source_changes_nothing(store, people, method):
    store.save_df(people, "person")
    assert getattr(store, method)(people.limit(0), "person", "id") == ChangeCounts(0, 0, 0)
    assert rows(store.load_table("person")) == sorted(PEOPLE, key=repr)
    assert getattr(store, method)(people.limit(0), "person", "id", dry_run=True).isEmpty()


def test_column_choice(store, people, changed):
    store.save_df(people, "person")
    store.upsert_table(changed, "person", "id", ["place"], index_cols="id", upsert_index_cols=True)
    got = {r["id"]: tuple(r) for r in store.load_table("person").collect()}
    assert got[3] == (3, "Cora", "1968-12-13", "Hill", False)
    assert got[8] == (8, None, None, "Lake", None)
    for bad in ({"where_cols": "none"}, {"where_cols": "id", "upsert_cols": ["none"]},
                {"where_cols": "id", "index_cols": "id", "upsert_index_cols": ["none"]}):
        with pytest.raises(InvalidColumnNameError):
            store.upsert_table(changed, "person", **bad)
    with pytest.raises(InvalidColumnNameError):
        store.upsert_table(changed.withColumn("extra", F.lit(1)), "person", "id")
    with pytest.raises(InvalidColumnNameError):
        store.merge_df(changed, "person", "id", ["name"])
    with pytest.raises(InvalidInputError):
        store.upsert_table(changed, "person", "id", "id")
    with pytest.raises(InvalidInputError):
        store.upsert_table(changed, "person", [])
    with pytest.raises(ExecuteStatementError):
        store.upsert_table(changed, "absent", "id")
    with pytest.raises(InvalidInputError):
        store.upsert_table(changed, "person", "id", chunksize=True)


def test_repeated_key_without_order_fails(store, people, changed):
    store.save_df(people, "person")
    with pytest.raises(ExecuteStatementError, match="more than once"):
        store.upsert_table(changed.union(changed), "person", "id")
    assert rows(store.load_table("person")) == sorted(PEOPLE, key=repr)


def test_insert_only_and_table_itself_as_source(store, people, changed):
    store.save_df(people, "person")
    assert store.upsert_table(changed, "person", "id", insert_only=True).rows_inserted == 2
    own = store.load_table("person").withColumn("place", F.lit("here"))
    assert store.upsert_table(own, "person", "id") == ChangeCounts(8, 8, 0)
    assert {r["place"] for r in store.load_table("person").collect()} == {"here"}


def test_merge_changed_only_and_delete(store, people, changed):
    store.save_df(people, "person")
    got = store.merge_df(changed, "person", "id", omit_update_where_clause=False)
    assert got == ChangeCounts(6, 4, 2)
    store.merge_df(changed.where("id < 3"), "person", "id", delete_unmatched=True)
    assert [r[0] for r in rows(store.load_table("person"))] == [1, 2]
    with pytest.raises(SQLStatementNotSupportedError):
        store.merge_df(changed, "person", "id", native=True)


def test_partitioned_upsert_touches_only_its_partitions(store, people, spark):
    store.save_df(people, "person", partition_by="place")
    path = store.load_table("person").where("place = 'East'").select(F.input_file_name()).first()[0]
    source = spark.createDataFrame([(2, "B", "South"), (9, "New", None), (9, "New", "Moon")], "id int, name string, place string")
    assert store.upsert_table(source, "person", ["id", "place"]) == ChangeCounts(1, 1, 2)
    got = store.load_table("person")
    assert got.count() == 8 and rows(got.where("id = 2").select("name", "place")) == [("B", "South")]
    assert got.where("place = 'East'").select(F.input_file_name()).first()[0] == path
    # A second change keeps the rows of the NULL partition.
    store.upsert_table(spark.createDataFrame([(10, "X", None)], "id int, name string, place string"), "person", ["id", "place"])
    assert store.load_table("person").where("place IS NULL").count() == 2
    store.merge_df(source, "person", ["id", "place"], delete_unmatched=True)
    assert store.load_table("person").where("place = 'East'").isEmpty()


def test_bucketed_target_is_not_shuffled_for_the_update(store, people, changed, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.save_df(people, "person", bucket_by=(4, "id"))
        from framestore.operators import upsert_changes

        target = store.load_table("person")
        plan = upsert_changes(target, changed, "id", co_located=True).updated()._jdf.queryExecution().executedPlan()
        left = plan.toString().split("Exchange")[0]
        assert "SelectedBucketsCount: 4 out of 4" in left
        assert store.upsert_table(changed, "person", "id") == ChangeCounts(6, 4, 2)
        assert rows(store.load_table("person")) == sorted(CHANGED, key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


RULES = Constraints(
    primary_key="id",
    not_null=["name", "adventurer"],
    checks={"born": "length(born) = 10"},
    foreign_keys=[ForeignKey("place", "place", "place")],
)


def test_constraints_on_save(store, people, spark):
    store.declare("person", RULES)
    store.save_df(people.select("place").distinct(), "place")
    store.save_df(people, "person")
    with pytest.raises(SaveDataFrameError) as e:
        store.save_df(people, "person")
    assert e.value.data["PRIMARY KEY(id) with existing rows"][0] == 6
    bad = spark.createDataFrame([(9, None, "1", "Moon", None), (None, "n", "2000-01-01", None, True)], SCHEMA)
    with pytest.raises(SaveDataFrameError) as e:
        store.save_df(bad, "person")
    assert set(e.value.data) == {"NOT NULL(name)", "NOT NULL(adventurer)", "NOT NULL(id)", "CHECK(born)"}
    assert store.load_table("person").count() == 6
    moon = spark.createDataFrame([(9, "Gus", "2000-01-01", "Moon", True)], SCHEMA)
    store.manage_foreign_keys("ON")
    with pytest.raises(SaveDataFrameError, match="FOREIGN KEY"):
        store.save_df(moon, "person")
    store.manage_foreign_keys("OFF")
    store.save_df(moon, "person")
    assert store.load_table("person").count() == 7
    for bad_action in ("on", 1, None):
        with pytest.raises(InvalidInputError):
            store.manage_foreign_keys(bad_action)


def test_constraints_on_upsert(store, people, changed, spark):
    store.declare("person", Constraints(primary_key="id", not_null=["adventurer"], unique=[["name"]]))
    store.save_df(people, "person")
    with pytest.raises(ExecuteStatementError, match="NOT NULL"):
        store.upsert_table(changed.drop("adventurer"), "person", "id")
    with pytest.raises(ExecuteStatementError, match="UNIQUE"):
        store.upsert_table(changed.withColumn("name", F.lit("Ada")), "person", "id")
    assert rows(store.load_table("person")) == sorted(PEOPLE, key=repr)
    store.upsert_table(changed, "person", "id")
    assert store.load_table("person").count() == 8


def test_external_table_stays_in_place(store, people, changed, spark, tmp_path):
    name, path = store.qualified("person"), f"{tmp_path}/external"
    people.write.parquet(path)
    spark.sql(f"CREATE TABLE {name} ({SCHEMA}) USING parquet LOCATION '{path}'")
    assert store.upsert_table(changed, "person", "id") == ChangeCounts(6, 4, 2)
    assert rows(spark.read.parquet(path)) == rows(store.load_table("person")) == sorted(CHANGED, key=repr)


def test_auto_key_numbers_inserted_rows(store, people, changed, spark):
    store.save_df(people.drop("id"), "person", auto_key="id")
    assert sorted(r["id"] for r in store.load_table("person").collect()) == [1, 2, 3, 4, 5, 6]
    assert store.upsert_table(changed.drop("id"), "person", "name", auto_key="id") == ChangeCounts(6, 4, 2)
    got = {r["name"]: r["id"] for r in store.load_table("person").collect()}
    assert sorted(got.values()) == list(range(1, 9)) and {got["Gus"], got["Hal"]} == {7, 8}
    store.save_df(spark.createDataFrame([("Ida",)], "name string"), "person", auto_key="id")
    assert store.load_table("person").where("name = 'Ida'").first()["id"] == 9
    assert store.definition("person").startswith("CREATE TABLE")


def test_database_must_exist(spark):
    with pytest.raises(SourceNotFoundError):
        TableStore(spark, "no_such_database", must_exist=True)


def test_scratch_tables_are_deleted(store, people, changed, spark):
    import glob

    shared = spark.conf.get("spark.checkpoint.dir")
    store.save_df(people, "person", partition_by="place")
    delete_scratch(spark)
    before = set(glob.glob(f"{shared}/framestore/*"))
    store.upsert_table(changed, "person", ["id", "place"], order_by="id", chunksize=3)
    chunks = list(store.load_table("person", chunksize=3))
    assert sum(c.count() for c in chunks) == store.load_table("person").count()
    delete_scratch(spark)
    assert set(glob.glob(f"{shared}/framestore/*")) == before


def test_frames_outlive_a_publish(store, people, changed, spark):
    store.save_df(people, "person")
    before = store.load_table("person")
    n = before.count()
    store.upsert_table(changed, "person", "id", order_by="id")
    assert before.count() == n
    vacuum(spark, store.qualified("person"))
    assert store.load_table("person").count() >= n


def test_native_merge_takes_no_option_that_it_cannot_carry(store, people, changed):
    store.save_df(people, "person")
    for option in ({"order_by": "id"}, {"delete_unmatched": True}, {"null_safe_change": True}, {"on_duplicate": "unique"},
                   {"omit_update_where_clause": False}, {"chunksize": 2}, {"dry_run": True}):
        with pytest.raises(InvalidInputError):
            store.merge_df(changed, "person", "id", native=True, **option)


def test_deleted_rows_are_counted(store, people):
    store.save_df(people, "person")
    n = people.count()
    counts = store.merge_df(people.limit(1), "person", "id", delete_unmatched=True, on_duplicate="unique")
    assert (counts.rows_matched, counts.rows_deleted) == (1, n - 1)


def test_schema_names_another_database(store, people, spark, tmp_path):
    """`schema` qualifies the table in every policy; the table of that name in the store's own database stays."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS elsewhere LOCATION '{tmp_path}/elsewhere'")
    try:
        store.save_df(people, "person")
        store.save_df(people.where("id < 3"), "person", schema="elsewhere")
        store.save_df(people.where("id = 4"), "person", schema="elsewhere")
        assert [r["id"] for r in spark.table("elsewhere.person").orderBy("id").collect()] == [1, 2, 4]
        store.save_df(people.where("id = 5"), "person", "replace", schema="elsewhere")
        assert [r["id"] for r in spark.table("elsewhere.person").collect()] == [5]
        store.save_df(people.select("id"), "person", "drop-replace", schema="elsewhere")
        assert spark.table("elsewhere.person").columns == ["id"]
        with pytest.raises(TableExistsError):
            store.save_df(people, "person", "fail", schema="elsewhere")
        assert rows(store.load_table("person")) == sorted(PEOPLE, key=repr)
    finally:
        spark.sql("DROP DATABASE elsewhere CASCADE")


@pytest.mark.parametrize("chunksize", [1, 3, 100])
def test_merge_chunks_do_not_change_the_result(store, people, changed, chunksize):
    store.save_df(people, "person")
    again = changed.unionByName(changed.where("id IN (3, 7)").withColumn("place", F.lit("Last"))).withColumn("at", F.monotonically_increasing_id())
    counts = store.merge_df(again, "person", "id", ["id", "name", "born", "place", "adventurer"], order_by="at", chunksize=chunksize)
    assert counts == ChangeCounts(6, 4, 2, 0)
    expected = {r[0]: r for r in CHANGED} | {i: (*r[:3], "Last", r[4]) for r in CHANGED for i in [r[0]] if i in (3, 7)}
    assert rows(store.load_table("person")) == sorted(expected.values(), key=repr)
    with pytest.raises(InvalidInputError):
        store.merge_df(changed, "person", "id", chunksize=0)
