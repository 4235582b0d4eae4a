"""Physical plans: what is pushed down, what is shuffled, how hot keys spread."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from framestore import TableStore, filter_in
from framestore.operators import merge, update, upsert, with_positions
from framestore.operators.keyed import HIT, bucketed_join, hot_keys
from framestore.operators.upsert import upsert_changes
from framestore.sinks import publish

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def conf(spark):
    changed = []

    def set_all(options):
        for key, value in options.items():
            changed.append(key)
            spark.conf.set(key, value)

    yield set_all
    for key in changed:
        spark.conf.unset(key)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df):
    """The final plan after the query ran."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("Initial Plan")[0]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    df = TableStore(spark).load_table(
        f"SELECT o_orderkey, o_totalprice FROM parquet.`{sf_dir}/orders.parquet` WHERE o_orderstatus = :s AND o_totalprice > :p",
        params={"s": "F", "p": 1000.0},
        dtypes={"o_orderkey": "string"},
    )
    text = plan(df)
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThan(o_total" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>", text)


def test_upsert_reads_only_keys_for_the_insert_branch(spark, sf_dir, conf):
    conf(NO_BROADCAST)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    source = orders.select("o_orderkey", F.lit(1.0).alias("o_totalprice"))
    inserted = upsert_changes(orders, source, "o_orderkey").inserted()
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan(inserted))
    assert schemas and all(s == "o_orderkey:bigint" for s in schemas)


def test_small_source_is_broadcast_and_the_target_not_shuffled(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    source = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_acctbal").alias("l_tax")
    )
    text = run_plan(update(lines, source, "l_suppkey", on_duplicate="unique"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


@pytest.mark.parametrize("operator", [upsert, merge])
def test_hot_target_key_is_split(spark, conf, operator):
    conf({
        **NO_BROADCAST,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    })
    target = spark.range(0, 400000, 1, 8).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END").alias("k"), F.rand(1).alias("v")
    )
    source = spark.range(0, 1000, 1, 4).select((F.col("id") % 500).alias("k"), F.lit(1.0).alias("v"), F.col("id").alias("o"))
    text = run_plan(operator(target, source, "k", ["k", "v"], order_by="o"))
    assert "SortMergeJoin(skew=true)" in text
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text


def test_null_keys_spread_over_partitions(spark, conf):
    conf({**NO_BROADCAST, "spark.sql.adaptive.enabled": "false"})
    target = spark.range(10000).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("v"))
    source = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
    joined = upsert_changes(target, source, "k", on_duplicate="unique").matched("left")
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4000 and HIT in joined.columns


def test_duplicates_collapse_before_the_shuffle(spark):
    source = spark.range(0, 1000, 1, 4).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    text = plan(upsert(source.limit(1), source, "k", order_by="v"))
    assert re.search(r"partial_max_by", text) and re.search(r"partial_min_by", text)


def test_chunks_read_a_range_of_the_staged_table(spark):
    positioned = with_positions(spark.range(1000), "id")
    text = plan(positioned.rows(100, 200))
    assert "GreaterThanOrEqual(__local" in text and "LessThanOrEqual(__local" in text
    assert [r[0] for r in positioned.rows(100, 103).collect()] == [100, 101, 102]
    positioned.delete()


@pytest.mark.parametrize("n", [2, 700])
def test_touched_partitions_prune_the_scan(spark, tmp_path, n):
    path = f"{tmp_path}/t"
    p = F.when(F.col("id") % 4 != 3, (F.col("id") % 4).cast("string"))
    spark.range(40).select("id", p.alias("p")).write.partitionBy("p").parquet(path)
    target = spark.read.schema("id bigint, p string").parquet(path)
    source = spark.createDataFrame([(1, "1"), (2, None), *[(i, f"x{i}") for i in range(n)]], "id int, p string")
    got, _ = publish.touched_partitions(target, source, ("p",))
    assert sorted({r["p"] for r in got.collect()}, key=repr) == ["1", None] and got.count() == 20
    text = plan(got)
    assert "dynamicpruningexpression(p" in text and "PartitionFilters: [isnull(p" in text


def test_touched_partitions_of_two_columns(spark):
    target = spark.createDataFrame([(a, b) for a in (1, 2, None) for b in ("x", "y", None)], "a int, b string")
    source = spark.createDataFrame([(1, "x"), (1, None), (None, "y"), (2, "z")], "a int, b string")
    got = publish.touched_partitions(target, source, ("a", "b"))[0].collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "x"), (1, None), (None, "y")], key=repr)


def test_in_list_reads_only_what_is_selected(spark, sf_dir, conf):
    conf(NO_BROADCAST)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    wanted = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey")
    text = plan(filter_in(lines, "l_partkey", wanted).select("l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_positions_need_no_join(spark, conf):
    conf(NO_BROADCAST)
    text = plan(with_positions(spark.range(100), "id").df)
    assert "Join" not in text and "Exchange" not in text


def test_bucketed_join_spreads_hot_and_null_keys(spark, conf, tmp_path):
    """A third of the rows has one key, a third has none."""
    conf({**NO_BROADCAST, "spark.sql.adaptive.enabled": "false", "spark.sql.files.maxPartitionBytes": "100KB", "spark.sql.files.openCostInBytes": "1"})
    spark.sql(f"CREATE DATABASE IF NOT EXISTS hot LOCATION '{tmp_path}/hot'")
    k = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END")
    rows = spark.range(0, 90000, 1, 4).select(k.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    rows.write.bucketBy(8, "k").option("maxRecordsPerFile", 3000).saveAsTable("hot.t")
    target, source = spark.table("hot.t"), spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    hot = hot_keys(target, ["k"], 8)
    assert [r["k"] for r in hot.collect()] == [7]
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    joined = bucketed_join(target.drop("s"), source, ["k"], "left", hot)
    # As it is written: an aggregation on top would read by buckets again.
    sizes = Counter(r[0] for r in joined.select(F.spark_partition_id()).collect())
    assert sum(sizes.values()) == 90000 and max(sizes.values()) < 9000
    assert joined.where("s = 'x'").count() == target.where("k < 100").count()
    text = plan(joined)
    assert "Bucketed: true" in text and text.count("Bucketed: false (disabled by query planner)") == 2
    spark.sql("DROP DATABASE hot CASCADE")


def test_upsert_of_a_bucketed_table_with_hot_and_null_keys(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS hot2 LOCATION '{tmp_path}/hot2'")
    store = TableStore(spark, "hot2")
    k = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END")
    store.save_df(spark.range(900).select(k.alias("k"), F.col("id").alias("v")), "t", bucket_by=(4, "k"))
    source = spark.createDataFrame([(7, -1), (8, -2), (1000, -3), (None, -4)], "k long, v long")
    counts = store.upsert_table(source, "t", "k")
    assert (counts.rows_matched, counts.rows_changed, counts.rows_inserted) == (301, 301, 2)
    got = store.load_table("t")
    assert got.count() == 902 and got.where("v = -1").count() == 300 and got.where("k IS NULL").count() == 301
    spark.sql("DROP DATABASE hot2 CASCADE")


@pytest.mark.parametrize("operator", [upsert, merge])
def test_default_changes_shuffle_each_side_little(spark, sf_dir, conf, operator):
    """Repeated keys are looked for in a subquery on the keys; the rows themselves are not grouped."""
    conf(NO_BROADCAST)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    text = run_plan(operator(orders, orders.withColumn("o_totalprice", F.lit(1.0)), "o_orderkey"))
    main = text.split("Subquery")[0]
    assert text.count("Exchange hashpartitioning") <= 4 and "SortAggregate(key=[o_orderkey" not in text
    assert main.count("SortMergeJoin") >= 1 and "NestedLoop" not in text


def test_change_only_merge_stages_its_summaries_once(spark, conf):
    conf(NO_BROADCAST)
    source = spark.range(0, 1000, 1, 4).select((F.col("id") % 100).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"), F.col("id").alias("o"))
    merged = merge(source.where("o < 50"), source, "k", ["k", "v", "o"], order_by="o", omit_update_where_clause=False)
    text = run_plan(merged)
    assert "MapInArrow" not in text and text.count("Exchange hashpartitioning") <= 6


def test_counts_of_a_large_source_need_no_anti_join(spark, conf):
    """Three sorts and hash tables of all keys met in the task of an anti join; one aggregation counts the same."""
    conf(NO_BROADCAST)
    target = spark.createDataFrame([(1, 0.0, "a"), (1, 0.0, "b"), (2, -0.0, "c"), (3, float("nan"), None), (None, 1.0, "d")], "k int, x double, v string")
    source = spark.createDataFrame([(1, 0.0, "b"), (2, 0.0, "c"), (3, float("nan"), "e"), (4, 0.0, "f"), (None, 1.0, "g"), (5, None, "h")], "k int, x double, v string")
    for keys in ("k", ["k", "x"]):
        changes = upsert_changes(target, source, keys, nan_as_null=False)
        counts = changes.counts()
        actions = Counter(r["_action"] for r in changes.change_set().collect())
        assert "LeftAnti" not in plan(counts) and "LeftAnti" in plan(changes.change_set())
        assert counts.first().asDict() == {
            "rows_matched": actions["update"] + actions["unchanged"], "rows_changed": actions["update"], "rows_inserted": actions["insert"], "rows_deleted": 0,
        }
        assert [actions[a] for a in ("update", "unchanged", "insert")] == [2, 2, 3]
    empty = upsert_changes(target.limit(0), source.limit(0), "k").counts().first()
    assert list(empty) == [0, 0, 0, 0]
