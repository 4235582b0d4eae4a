"""Queries: save, replace, delete, and upserts that are written to tables."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from framestore.plans.changing import (
    _ORDERS,
    _UPSERTED,
    arriving_balances,
    arriving_orders,
    known_balances,
    known_orders,
)
from framestore.plans.registry import Tables, query
from framestore.errors import DeleteFromTableError, ExecuteStatementError, SaveDataFrameError
from framestore.operators.checks import Constraints, ForeignKey
from framestore.session import delete_path, shared_folder
from framestore.streaming import upsert_stream


@query(
    """
    SELECT c_custkey, c_name, c_nationkey FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
    """
)
def save_append(t: Tables):
    store = t.store()
    store.save_df(t("customer").select("c_custkey", "c_name", "c_nationkey"), "party")
    store.save_df(
        t("supplier").select(
            F.col("s_nationkey").alias("c_nationkey"), F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey")
        ),
        "party",
    )
    return store.load_table("party")


@query("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_orderdate FROM orders WHERE o_orderstatus <> 'P'")
def save_replace(t: Tables):
    """The new rows are computed from the table that they replace."""
    store = t.store()
    store.save_df(t("orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus"), "orders")
    store.execute(f"ALTER TABLE {store.qualified('orders')} SET TBLPROPERTIES ('note' = 'kept')")
    changed = store.load_table("orders").where("o_orderstatus <> 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    store.save_df(changed, "orders", "replace")
    return store.load_table("orders", columns=["o_orderkey", "o_totalprice", "o_orderdate"])


@query("SELECT p_partkey, p_brand || '/' || p_type AS kind FROM part")
def save_drop_replace(t: Tables):
    store = t.store()
    store.save_df(t("part"), "part")
    kind = F.concat_ws("/", "p_brand", "p_type").alias("kind")
    store.save_df(store.load_table("part").select("p_partkey", kind), "part", "drop-replace")
    return store.load_table("part")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'")
def read_after_upsert(t: Tables):
    """A frame that was loaded before an upsert is read after it, with the rows of its own time."""
    store = t.store()
    store.save_df(known_orders(t), "orders")
    before = store.load_table("orders", columns=["o_orderkey", "o_totalprice"])
    store.upsert_table(arriving_orders(t), "orders", "o_orderkey")
    return before


@query(
    """
    SELECT count(*) FILTER (WHERE o_totalprice > 200000) AS rows_matched,
           CAST(0 AS BIGINT) AS rows_changed, CAST(0 AS BIGINT) AS rows_inserted,
           count(*) FILTER (WHERE o_totalprice <= 200000) AS rows_deleted FROM orders
    """
)
def table_merge_delete_counts(t: Tables):
    store = t.store()
    store.save_df(t("orders"), "orders")
    c = store.merge_df(t("orders").where("o_totalprice > 200000"), "orders", "o_orderkey", delete_unmatched=True)
    return t.spark.createDataFrame(
        [(c.rows_matched, c.rows_changed, c.rows_inserted, c.rows_deleted)],
        "rows_matched bigint, rows_changed bigint, rows_inserted bigint, rows_deleted bigint",
    )


@query(
    """
    SELECT s_suppkey, s_name, s_acctbal FROM supplier
    UNION ALL SELECT c_custkey, c_name, NULL FROM customer
    """
)
def save_missing_columns(t: Tables):
    store = t.store()
    store.save_df(t("supplier").select("s_suppkey", "s_name", "s_acctbal"), "party")
    store.save_df(t("customer").select(F.col("c_name").alias("s_name"), F.col("c_custkey").alias("s_suppkey")), "party")
    return store.load_table("party")


@query("SELECT n_nationkey AS id, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def save_key_labels(t: Tables):
    store = t.store()
    store.save_df(
        t("nation"), "nation", index_cols="n_nationkey", index_label="id", dtype={"n_regionkey": "bigint"}, chunksize=10
    )
    return store.load_table("nation")


@query(
    """
    SELECT event_id, strftime((ts AT TIME ZONE 'America/Denver') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS ts, event_type
    FROM events
    """
)
def save_datetime_text(t: Tables):
    store = t.store()
    store.save_df(
        t("events").select("event_id", "ts", "event_type"),
        "events",
        datetime_cols_dtype="str",
        localize_tz="America/Denver",
        target_tz="UTC",
        partition_by="event_type",
    )
    return store.load_table("events")


@query("SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS note FROM customer")
def execute_insert_many(t: Tables):
    store = t.store()
    table = store.qualified("person")
    store.execute(f"CREATE TABLE IF NOT EXISTS {table} (id BIGINT, name STRING, note STRING) USING parquet")
    params = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"))
    store.execute(f"INSERT INTO {table} (id, name) VALUES (:k, :n)", params=params)
    return store.load_table("person")


@query("SELECT s_suppkey, s_name FROM supplier")
def delete_all_rows(t: Tables):
    store = t.store()
    store.save_df(t("customer").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name")), "party")
    store.delete_all_records_from_table("party")
    store.save_df(t("supplier").select("s_suppkey", "s_name"), "party")
    return store.load_table("party")


@query(
    """
    SELECT c_custkey, c_name FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)
    """
)
def delete_by_keys(t: Tables):
    store = t.store()
    store.save_df(t("customer").select("c_custkey", "c_name"), "customer")
    gone = t("orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    store.delete_rows(gone, "customer", "c_custkey")
    return store.load_table("customer")


@query(_UPSERTED)
def table_upsert(t: Tables):
    store = t.store()
    store.save_df(known_orders(t), "orders")
    store.upsert_table(arriving_orders(t), "orders", "o_orderkey")
    return store.load_table("orders")


@query(_UPSERTED)
def table_upsert_partitioned(t: Tables):
    """Only the partitions that the source touches are read and rewritten."""
    store = t.store()
    store.save_df(known_orders(t), "orders", partition_by="o_orderpriority")
    store.upsert_table(arriving_orders(t), "orders", ["o_orderkey", "o_orderpriority"])
    return store.load_table("orders")


@query(
    f"""
    WITH {_ORDERS}
    SELECT CAST(count(k.o_orderkey) AS BIGINT) AS rows_matched,
           CAST(count(*) FILTER (WHERE k.o_totalprice <> a.o_totalprice) AS BIGINT) AS rows_changed,
           CAST(count(*) FILTER (WHERE k.o_orderkey IS NULL) AS BIGINT) AS rows_inserted
    FROM arriving a LEFT JOIN known k ON k.o_orderkey = a.o_orderkey
    """
)
def table_upsert_counts(t: Tables):
    """Counted while the table is written, without another pass."""
    store = t.store()
    store.save_df(known_orders(t), "orders")
    c = store.upsert_table(arriving_orders(t), "orders", "o_orderkey")
    return t.spark.createDataFrame(
        [(c.rows_matched, c.rows_changed, c.rows_inserted)],
        "rows_matched bigint, rows_changed bigint, rows_inserted bigint",
    )


@query(
    """
    WITH known AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS c_acctbal,
                          c_nationkey FROM customer WHERE c_acctbal > 0),
         arriving AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal + 1 END AS c_acctbal,
                             CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_nationkey END AS c_nationkey
                      FROM customer)
    SELECT a.* FROM arriving a
    """
)
def table_merge(t: Tables):
    store = t.store()
    store.save_df(known_balances(t), "balance")
    store.merge_df(arriving_balances(t), "balance", "c_custkey")
    return store.load_table("balance")


@query(
    """
    SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id
    """
)
def stream_merge(t: Tables):
    """A stream of the whole events file, merged into a table of the latest event per user."""
    store = t.store()
    columns = ["user_id", "event_type", "event_id"]
    store.save_df(t("events").select(*columns).where(F.lit(False)), "latest")
    stream = (
        t.spark.readStream.schema(t("events").schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    )
    running = upsert_stream(
        stream.select(*columns),
        store,
        "latest",
        "user_id",
        checkpoint_location=f"{shared_folder(t.spark)}/{store.database}/_stream",
        use_merge=True,
        order_by="event_id",
    )
    running.awaitTermination()
    return store.load_table("latest")


_TOUCHED = """
    known AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority <> '1-URGENT'),
    arriving AS (SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderpriority FROM orders
                 WHERE o_orderkey < (SELECT max(o_orderkey) / 8 FROM orders))
"""


@query(
    f"""
    WITH {_TOUCHED}
    SELECT * FROM known WHERE o_orderkey NOT IN (SELECT o_orderkey FROM arriving)
    UNION ALL SELECT * FROM arriving
    """
)
def table_upsert_touched_files(t: Tables):
    """New prices of the first eighth of the orders: the files of all other orders stay as they are."""
    store = t.store()
    store.save_df(known_orders(t).repartitionByRange(8, "o_orderkey"), "orders")
    last = t("orders").agg((F.max("o_orderkey") / 8).alias("last"))
    arriving = t("orders").select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderpriority")
    store.upsert_table(arriving.join(last, F.col("o_orderkey") < F.col("last")).drop("last"), "orders", "o_orderkey", rewrite="files")
    return store.load_table("orders")


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50 AND l_orderkey < 2000)
    """
)
def table_delete_touched_files(t: Tables):
    store = t.store()
    store.save_df(t("orders").select("o_orderkey", "o_totalprice").repartitionByRange(8, "o_orderkey"), "orders")
    gone = t("lineitem").where("l_quantity = 50 AND l_orderkey < 2000").select(F.col("l_orderkey").alias("o_orderkey"))
    store.delete_rows(gone, "orders", "o_orderkey", rewrite="files")
    return store.load_table("orders")


def _large_orders(t: Tables):
    return t("orders").where("o_totalprice > 450000").select("o_orderkey", "o_custkey")


def _customers_and_orders(t: Tables):
    store = t.store()
    store.save_df(t("customer").select("c_custkey", "c_name", "c_acctbal"), "customer")
    store.save_df(_large_orders(t), "orders")
    store.declare("orders", Constraints(foreign_keys=[ForeignKey("o_custkey", "customer", "c_custkey")]))
    store.manage_foreign_keys("ON")
    return store


@query(
    """
    SELECT c_custkey, c_name, c_acctbal FROM customer
    WHERE c_acctbal >= 0 OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
    """
)
def fk_parent_delete(t: Tables):
    """Customers in debt cannot go as long as large orders refer to them; those without can."""
    store = _customers_and_orders(t)
    debtors = t("customer").where("c_acctbal < 0").select("c_custkey")
    try:
        store.delete_rows(debtors, "customer", "c_custkey")
        raise AssertionError("orders refer to customers in debt")
    except DeleteFromTableError:
        pass
    with_orders = _large_orders(t).select(F.col("o_custkey").alias("c_custkey"))
    store.delete_rows(debtors.join(with_orders, "c_custkey", "left_anti"), "customer", "c_custkey")
    return store.load_table("customer")


@query(
    """
    SELECT c_custkey, 'former' AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
    """
)
def fk_parent_replace(t: Tables):
    """The customers are replaced: not by those without debt, but by all that large orders refer to."""
    store = _customers_and_orders(t)
    try:
        store.save_df(t("customer").where("c_acctbal >= 0").select("c_custkey", "c_name"), "customer", "replace")
        raise AssertionError("orders refer to customers in debt")
    except SaveDataFrameError:
        pass
    with_orders = _large_orders(t).select(F.col("o_custkey").alias("c_custkey"))
    former = t("customer").join(with_orders, "c_custkey", "left_semi").select("c_custkey", F.lit("former").alias("c_name"))
    store.save_df(former, "customer", "replace")
    return store.load_table("customer")


@query(
    """
    WITH e AS (SELECT CASE WHEN event_type = 'click' THEN NULL ELSE user_id END AS user_id, event_type, event_id FROM events)
    SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM e WHERE user_id IS NOT NULL GROUP BY user_id
    UNION ALL SELECT * FROM e WHERE user_id IS NULL
    """
)
def stream_replay(t: Tables):
    """A batch whose end the checkpoint has lost comes again: its rows without a key are not inserted twice."""
    store = t.store()
    user = F.when(F.col("event_type") != "click", F.col("user_id")).alias("user_id")
    store.save_df(t("events").select(user, "event_type", "event_id").where(F.lit(False)), "latest")
    checkpoint = f"{shared_folder(t.spark)}/{store.database}/_stream"

    def run():
        stream = t.spark.readStream.schema(t("events").schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
        rows = stream.select(user, "event_type", "event_id")
        upsert_stream(rows, store, "latest", "user_id", checkpoint, use_merge=True, order_by="event_id").awaitTermination()

    run()
    for name in ("commits/0", "commits/.0.crc"):
        delete_path(t.spark, f"{checkpoint}/{name}")
    run()
    return store.load_table("latest")


@query(
    """
    SELECT c_custkey, CASE WHEN n_name IS NULL THEN c_name ELSE upper(n_name) || ': moved' END AS c_name, c_nationkey
    FROM customer LEFT JOIN nation ON n_nationkey = c_custkey
    """
)
def execute_update_many(t: Tables):
    """One UPDATE for many sets of parameters."""
    store = t.store()
    store.save_df(t("customer").select("c_custkey", "c_name", "c_nationkey"), "customer")
    table = store.qualified("customer")
    params = t("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("n"))
    store.execute(f"UPDATE {table} SET c_name = upper(:n) || ': moved' WHERE c_custkey = :k", params=params)
    return store.load_table("customer")


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_returnflag = 'R')
    """
)
def execute_delete_many(t: Tables):
    store = t.store()
    store.save_df(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), "orders")
    params = t("lineitem").where("l_returnflag = 'R'").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    store.execute(
        f"DELETE FROM {store.qualified('orders')} WHERE o_orderkey = :key AND o_custkey = :cust",
        params=params.select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("cust")),
    )
    return store.load_table("orders")


@query("SELECT event_id, CAST(floor(epoch(ts AT TIME ZONE 'CET')) AS BIGINT) + 3600 AS ts FROM events")
def load_local_epoch(t: Tables):
    """Saved as seconds from local 1970-01-01."""
    store = t.store()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        store.save_df(t("events").select("event_id", "ts"), "naive")
        events = store.load_table("naive", datetime_cols_dtype="int", localize_tz="CET", local_epoch=True)
        store.save_df(t("events").select("event_id", "ts"), "events", datetime_cols_dtype="int", localize_tz="CET", local_epoch=True)
    store.merge_df(events, "events", "event_id", omit_update_where_clause=False)
    return store.load_table("events")


@query(
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderkey AS number
    FROM orders
    """
)
def upsert_constraints(t: Tables):
    """Rows that break a rule are not published: a price below zero, a customer that is none, a number twice."""
    store = t.store()
    orders = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderkey").alias("number"))
    store.save_df(t("customer").select("c_custkey"), "customer")
    store.save_df(orders.where("o_orderkey % 3 > 0"), "orders")
    store.declare("orders", Constraints(
        primary_key="o_orderkey", unique=[("number",)], checks={"price": "o_totalprice >= 0"},
        foreign_keys=[ForeignKey("o_custkey", "customer", "c_custkey")],
    ))
    store.manage_foreign_keys("ON")
    for bad in ({"o_totalprice": F.lit(-1.0)}, {"o_custkey": F.lit(-1).cast("bigint")}, {"number": F.lit(1).cast("bigint")}):
        try:
            store.upsert_table(orders.withColumns(bad), "orders", "o_orderkey")
            raise AssertionError(f"{list(bad)} breaks a rule")
        except ExecuteStatementError:
            pass
    price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    good = t("orders").select("o_orderkey", "o_custkey", price.alias("o_totalprice"), F.col("o_orderkey").alias("number"))
    store.upsert_table(good, "orders", "o_orderkey")
    return store.load_table("orders")
