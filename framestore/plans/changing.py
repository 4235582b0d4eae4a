"""Queries: update, upsert, merge, change sets and counts.

Targets and sources are whole tables or natural parts of them: the orders that
are not urgent are known already, and all orders arrive with a new price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from framestore.operators.changes import ACTION
from framestore.operators.merge import merge, merge_changes
from framestore.operators.upsert import update, upsert, upsert_changes
from framestore.plans.registry import Tables, query

ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def known_orders(t: Tables) -> DataFrame:
    return t("orders").select(*ORDER_COLUMNS).where("o_orderpriority <> '1-URGENT'")


def arriving_orders(t: Tables) -> DataFrame:
    price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice"))
    return t("orders").select("o_orderkey", "o_orderstatus", price.alias("o_totalprice"), "o_orderpriority")


_ORDERS = """
    known AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
              WHERE o_orderpriority <> '1-URGENT'),
    arriving AS (SELECT o_orderkey, o_orderstatus,
                        CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
                        o_orderpriority FROM orders)
"""


@query(
    f"""
    WITH {_ORDERS}
    SELECT k.o_orderkey, k.o_orderstatus, coalesce(a.o_totalprice, k.o_totalprice) AS o_totalprice, k.o_orderpriority
    FROM known k LEFT JOIN arriving a ON k.o_orderkey = a.o_orderkey
    """
)
def update_only(t: Tables):
    return update(known_orders(t), arriving_orders(t), "o_orderkey")


_UPSERTED = f"""
    WITH {_ORDERS}
    SELECT a.o_orderkey, a.o_orderstatus, a.o_totalprice, a.o_orderpriority FROM known k
    JOIN arriving a ON k.o_orderkey = a.o_orderkey
    UNION ALL
    SELECT k.* FROM known k WHERE NOT EXISTS (SELECT 1 FROM arriving a WHERE a.o_orderkey = k.o_orderkey)
    UNION ALL
    SELECT a.* FROM arriving a WHERE NOT EXISTS (SELECT 1 FROM known k WHERE a.o_orderkey = k.o_orderkey)
"""


@query(_UPSERTED, name="upsert")
def upsert_orders(t: Tables):
    return upsert(known_orders(t), arriving_orders(t), "o_orderkey")


@query(_UPSERTED)
def upsert_trusted_keys(t: Tables):
    return upsert(known_orders(t), arriving_orders(t), "o_orderkey", on_duplicate="unique")


@query(
    f"""
    WITH {_ORDERS}
    SELECT * FROM known
    UNION ALL
    SELECT a.* FROM arriving a WHERE NOT EXISTS (SELECT 1 FROM known k WHERE a.o_orderkey = k.o_orderkey)
    """
)
def upsert_insert_only(t: Tables):
    return upsert(known_orders(t), arriving_orders(t), "o_orderkey", insert_only=True)


@query(
    f"""
    WITH {_ORDERS}
    SELECT k.o_orderkey, k.o_orderstatus, coalesce(a.o_totalprice, k.o_totalprice) AS o_totalprice, k.o_orderpriority
    FROM known k LEFT JOIN arriving a ON k.o_orderkey = a.o_orderkey
    UNION ALL
    SELECT a.o_orderkey, NULL, a.o_totalprice, NULL FROM arriving a
    WHERE NOT EXISTS (SELECT 1 FROM known k WHERE a.o_orderkey = k.o_orderkey)
    """
)
def upsert_column_subset(t: Tables):
    return upsert(
        known_orders(t),
        arriving_orders(t),
        "o_orderkey",
        ["o_totalprice"],
        index_cols="o_orderkey",
        upsert_index_cols=True,
    )


# Lines are keyed by order, line, part and shipping day; all lines arrive with a changed quantity.
_LINES = """
    lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, max(l_quantity) AS l_quantity
              FROM lineitem GROUP BY ALL),
    known AS (SELECT * FROM lines WHERE l_quantity < 30),
    arriving AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity * 2 AS l_quantity FROM lines)
"""


@query(
    f"""
    WITH {_LINES}
    SELECT k.l_orderkey, k.l_linenumber, k.l_partkey, k.l_shipdate, coalesce(a.l_quantity, k.l_quantity) AS l_quantity
    FROM known k LEFT JOIN arriving a USING (l_orderkey, l_linenumber, l_partkey, l_shipdate)
    UNION ALL
    SELECT a.* FROM arriving a
    WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.l_orderkey = a.l_orderkey AND k.l_linenumber = a.l_linenumber
                      AND k.l_partkey = a.l_partkey AND k.l_shipdate = a.l_shipdate)
    """
)
def upsert_multi_key(t: Tables):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    lines = t("lineitem").groupBy(*keys).agg(F.max("l_quantity").alias("l_quantity"))
    arriving = lines.withColumn("l_quantity", F.col("l_quantity") * 2)
    return upsert(lines.where("l_quantity < 30"), arriving, keys, on_duplicate="unique")


# A NULL key on both sides: it matches nothing and every such source row is inserted.
_NULL_KEYS = """
    known AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS k, c_name, c_acctbal
              FROM customer WHERE c_acctbal > 0),
    arriving AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS k, c_name,
                        CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal + 1 END AS c_acctbal
                 FROM customer)
"""


@query(
    f"""
    WITH {_NULL_KEYS}
    SELECT k.k, k.c_name, CASE WHEN a.k IS NULL THEN k.c_acctbal ELSE a.c_acctbal END AS c_acctbal
    FROM known k LEFT JOIN arriving a ON k.k = a.k
    UNION ALL
    SELECT a.* FROM arriving a WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.k = a.k)
    """
)
def upsert_null_keys(t: Tables):
    key = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("k")
    nan = F.lit(float("nan"))
    known = t("customer").where("c_acctbal > 0").select(key, "c_name", "c_acctbal")
    arriving = t("customer").select(
        key,
        "c_name",
        F.when(F.col("c_mktsegment") == "MACHINERY", nan).otherwise(F.col("c_acctbal") + 1).alias("c_acctbal"),
    )
    return upsert(known, arriving, "k")


@query(
    """
    WITH known AS (SELECT DISTINCT user_id, 'old' AS event_type, 0.0::DOUBLE AS value FROM events WHERE event_type = 'error' AND value > 60)
    SELECT k.user_id, e.event_type, e.value
    FROM known k JOIN (SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
                       FROM events GROUP BY user_id) e ON k.user_id = e.user_id
    UNION ALL
    SELECT NULL, e.event_type, e.value FROM events e WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.user_id = e.user_id)
    """
)
def upsert_keys_not_inserted(t: Tables):
    """The key is no inserted column: inserted rows are never found by later duplicates."""
    known = (
        t("events")
        .where("event_type = 'error' AND value > 60")
        .select("user_id", F.lit("old").alias("event_type"), F.lit(0.0).alias("value"))
        .distinct()
    )
    return upsert(known, t("events"), "user_id", ["event_type", "value"], order_by="event_id")


_USERS = """
    known AS (SELECT DISTINCT user_id, 'old' AS event_type, 0.0::DOUBLE AS value FROM events WHERE event_type = 'error' AND value > 60),
    arriving AS (SELECT event_id, user_id, event_type, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value,
                        floor((row_number() OVER (ORDER BY event_id) - 1) / 500) AS chunk FROM events),
    keyed AS (SELECT user_id, min(chunk) = max(chunk) AS one_chunk,
                     arg_min({'event_type': event_type, 'value': value}, event_id) AS first,
                     arg_max({'event_type': event_type, 'value': value}, event_id) AS last
              FROM arriving GROUP BY user_id)
"""


def known_users(t: Tables) -> DataFrame:
    return (
        t("events")
        .where("event_type = 'error' AND value > 60")
        .select("user_id", F.lit("old").alias("event_type"), F.lit(0.0).alias("value"))
        .distinct()
    )


def arriving_events(t: Tables) -> DataFrame:
    value = F.when(F.col("event_type") != "view", F.col("value")).alias("value")
    return t("events").select("event_id", "user_id", "event_type", value)


EVENT_COLUMNS = ["user_id", "event_type", "value"]


@query(
    f"""
    WITH {_USERS}
    SELECT user_id, last.event_type AS event_type, last.value AS value FROM keyed
    WHERE user_id IN (SELECT user_id FROM known)
    UNION ALL
    SELECT user_id, first.event_type, first.value FROM keyed WHERE user_id NOT IN (SELECT user_id FROM known)
    """
)
def upsert_duplicates(t: Tables):
    return upsert(known_users(t), arriving_events(t), "user_id", EVENT_COLUMNS, order_by="event_id")


@query(
    f"""
    WITH {_USERS}
    SELECT user_id, last.event_type AS event_type, last.value AS value FROM keyed
    WHERE user_id IN (SELECT user_id FROM known) OR NOT one_chunk
    UNION ALL
    SELECT user_id, first.event_type, first.value FROM keyed
    WHERE user_id NOT IN (SELECT user_id FROM known) AND one_chunk
    """
)
def upsert_duplicates_chunked(t: Tables):
    return upsert(known_users(t), arriving_events(t), "user_id", EVENT_COLUMNS, order_by="event_id", chunksize=500)


@query(
    """
    WITH last AS (SELECT l_returnflag, l_linestatus,
                         arg_max({'p': l_partkey, 'q': l_quantity}, {'d': l_shipdate, 'o': l_orderkey, 'n': l_linenumber,
                                  'p': l_partkey, 's': l_suppkey, 'q': l_quantity, 'e': l_extendedprice}) AS v
                  FROM lineitem GROUP BY ALL)
    SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_returnflag, l.l_linestatus, v.p AS l_partkey, v.q AS l_quantity
    FROM lineitem l JOIN last USING (l_returnflag, l_linestatus)
    """
)
def update_hot_keys(t: Tables):
    """A handful of keys on both sides: every target row of a key gets the values of its last source row."""
    lines = t("lineitem")
    target = lines.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_partkey", "l_quantity"
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return update(target, lines, ["l_returnflag", "l_linestatus"], ["l_partkey", "l_quantity"], order_by=order)


@query(
    f"""
    WITH {_ORDERS}
    SELECT CASE WHEN k.o_orderkey IS NULL THEN 'insert' WHEN k.o_totalprice <> a.o_totalprice THEN 'update'
                ELSE 'unchanged' END AS _action,
           a.o_orderkey, k.o_totalprice AS old_price, a.o_totalprice AS new_price
    FROM arriving a LEFT JOIN known k ON k.o_orderkey = a.o_orderkey
    """
)
def upsert_preview(t: Tables):
    changes = upsert_changes(known_orders(t), arriving_orders(t), "o_orderkey").change_set()
    return changes.select(
        ACTION, "o_orderkey", F.col("old.o_totalprice").alias("old_price"), F.col("new.o_totalprice").alias("new_price")
    )


@query(
    f"""
    WITH {_ORDERS}
    SELECT CAST(count(k.o_orderkey) AS BIGINT) AS rows_matched,
           CAST(count(*) FILTER (WHERE k.o_totalprice <> a.o_totalprice) AS BIGINT) AS rows_changed,
           CAST(count(*) FILTER (WHERE k.o_orderkey IS NULL) AS BIGINT) AS rows_inserted,
           CAST(0 AS BIGINT) AS rows_deleted
    FROM arriving a LEFT JOIN known k ON k.o_orderkey = a.o_orderkey
    """
)
def upsert_counts(t: Tables):
    return upsert_changes(known_orders(t), arriving_orders(t), "o_orderkey").counts()


# Merge --------------------------------------------------------------------------


@query(_UPSERTED, name="merge")
def merge_orders(t: Tables):
    return merge(known_orders(t), arriving_orders(t), "o_orderkey")


@query(
    f"""
    WITH {_USERS}
    SELECT user_id, last.event_type AS event_type, last.value AS value FROM keyed
    """
)
def merge_duplicates(t: Tables):
    return merge(known_users(t), arriving_events(t), "user_id", EVENT_COLUMNS, order_by="event_id")


# Customers with unknown balances on either side: SQL <> with a NULL is no change.
_BALANCES = """
    known AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS c_acctbal,
                     c_nationkey FROM customer WHERE c_acctbal > 0),
    arriving AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal + 1 END AS c_acctbal,
                        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer)
"""


def known_balances(t: Tables) -> DataFrame:
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("c_acctbal")
    return t("customer").where("c_acctbal > 0").select("c_custkey", balance, "c_nationkey")


def arriving_balances(t: Tables) -> DataFrame:
    return t("customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_nationkey")).alias("c_nationkey"),
    )


@query(
    f"""
    WITH {_BALANCES}
    SELECT k.c_custkey,
           CASE WHEN k.c_acctbal <> a.c_acctbal OR k.c_nationkey <> a.c_nationkey THEN a.c_acctbal ELSE k.c_acctbal END
             AS c_acctbal,
           CASE WHEN k.c_acctbal <> a.c_acctbal OR k.c_nationkey <> a.c_nationkey THEN a.c_nationkey ELSE k.c_nationkey END
             AS c_nationkey
    FROM known k JOIN arriving a ON k.c_custkey = a.c_custkey
    UNION ALL
    SELECT a.* FROM arriving a WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.c_custkey = a.c_custkey)
    """
)
def merge_changed_only(t: Tables):
    return merge(known_balances(t), arriving_balances(t), "c_custkey", omit_update_where_clause=False)


@query(
    f"""
    WITH {_BALANCES}
    SELECT k.c_custkey, a.c_acctbal, a.c_nationkey FROM known k JOIN arriving a ON k.c_custkey = a.c_custkey
    UNION ALL
    SELECT a.* FROM arriving a WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.c_custkey = a.c_custkey)
    """
)
def merge_null_change(t: Tables):
    return merge(
        known_balances(t), arriving_balances(t), "c_custkey", omit_update_where_clause=False, null_safe_change=True
    )


@query(
    f"""
    WITH {_USERS},
    before AS (SELECT user_id, event_type, CASE WHEN user_id > 50 THEN NULL ELSE value END AS value FROM known),
    listed AS (SELECT user_id, list({{'event_type': event_type, 'value': value}} ORDER BY event_id) AS rows
               FROM arriving GROUP BY user_id),
    joined AS (SELECT l.user_id,
                      CASE WHEN b.user_id IS NULL THEN l.rows
                           ELSE list_concat([{{'event_type': b.event_type, 'value': b.value}}], l.rows) END AS rows
               FROM listed l LEFT JOIN before b ON b.user_id = l.user_id),
    folded AS (SELECT user_id, list_reduce(rows, lambda x, y:
                      CASE WHEN x.value <> y.value THEN y ELSE x END) AS v FROM joined)
    SELECT user_id, v.value AS value FROM folded
    """
)
def merge_changed_only_duplicates(t: Tables):
    """Change-only merge of repeated keys: an ordered fold over the source rows of a key."""
    value = F.when(F.col("user_id") <= 50, F.col("value")).alias("value")
    known = known_users(t).select("user_id", value)
    return merge(
        known,
        arriving_events(t),
        "user_id",
        ["user_id", "value"],
        order_by="event_id",
        omit_update_where_clause=False,
    )


@query(
    """
    SELECT c.c_custkey, c.c_acctbal + 1 AS c_acctbal FROM customer c
    WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)
    """
)
def merge_delete_unmatched(t: Tables):
    target = t("customer").select("c_custkey", "c_acctbal")
    large = t("orders").where("o_totalprice > 450000")
    active = t("customer").join(large, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    source = active.select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return merge(target, source, "c_custkey", delete_unmatched=True)


@query(
    f"""
    WITH {_BALANCES}
    SELECT CASE WHEN k.c_custkey IS NULL THEN 'insert'
                WHEN k.c_acctbal <> a.c_acctbal OR k.c_nationkey <> a.c_nationkey THEN 'update'
                ELSE 'unchanged' END AS _action, CAST(count(*) AS BIGINT) AS n
    FROM arriving a LEFT JOIN known k ON k.c_custkey = a.c_custkey
    GROUP BY ALL
    """
)
def merge_preview(t: Tables):
    changes = merge_changes(
        known_balances(t), arriving_balances(t), "c_custkey", omit_update_where_clause=False
    ).change_set()
    return changes.groupBy(ACTION).agg(F.count("*").alias("n"))
