"""Queries: load, execute, parameters, datetimes, missing values, chunks."""

from __future__ import annotations

import warnings
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import functions as F

from framestore.functions import convert_datetime_columns, nan_to_null, parse_dates
from framestore.functions.datetimes import dst_ambiguous, dst_gap
from framestore.operators.chunks import POSITION, chunk_ids, with_positions
from framestore.operators.params import Placeholder, filter_in, replace_placeholders, sort_columns
from framestore.plans.registry import Tables, query
from framestore.store import TableStore


@query("SELECT * FROM customer")
def load_table(t: Tables):
    t("customer").createOrReplaceTempView("framestore_customer")
    return TableStore(t.spark).load_table("framestore_customer")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def load_columns(t: Tables):
    t("orders").createOrReplaceTempView("framestore_orders")
    return TableStore(t.spark).load_table("framestore_orders", columns=["o_orderkey", "o_custkey", "o_totalprice"])


@query("SELECT o_orderpriority, o_orderkey, o_orderstatus FROM orders")
def load_key_columns_first(t: Tables):
    return TableStore(t.spark).load_table(
        f"SELECT o_orderkey, o_orderstatus, o_orderpriority FROM {t.in_sql('orders')};",
        index_col=["o_orderpriority", "o_orderkey"],
    )


@query(
    "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders "
    "WHERE o_totalprice > 250000.5 AND o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey"
)
def load_query_params(t: Tables):
    return TableStore(t.spark).load_table(
        f"SELECT o_orderkey, o_totalprice, o_orderdate FROM {t.in_sql('orders')} "
        "WHERE o_totalprice > :price AND o_orderstatus = :status ORDER BY o_totalprice DESC, o_orderkey",
        params={"price": 250000.5, "status": "F"},
    )


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 4)) AS DOUBLE) AS price FROM orders")
def load_coerce_float(t: Tables):
    return TableStore(t.spark).load_table(
        f"SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 4)) AS price FROM {t.in_sql('orders')}"
    )


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS BIGINT) AS p_size,
           CAST(trunc(p_retailprice) AS BIGINT) AS p_retailprice, p_name
    FROM part
    """
)
def load_cast_dtypes(t: Tables):
    return TableStore(t.spark).load_table(
        f"SELECT p_partkey, p_size, p_retailprice, p_name FROM {t.in_sql('part')}",
        dtypes={"p_partkey": "string", "p_size": int, "p_retailprice": "int64"},
    )


@query("SELECT s_suppkey, CAST(s_nationkey AS BIGINT) AS s_nationkey, CAST(s_suppkey > 0 AS BOOLEAN) AS positive FROM supplier")
def load_cast_unsigned(t: Tables):
    return TableStore(t.spark).load_table(
        f"SELECT s_suppkey, s_nationkey, CAST(s_suppkey > 0 AS INT) AS positive FROM {t.in_sql('supplier')}",
        dtypes={"s_nationkey": "uint32", "positive": "boolean"},
    )


@query(
    """
    SELECT o_orderkey, date_trunc('minute', o_orderdate) AS as_list,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderdate END AS bad_text
    FROM orders
    """
)
def parse_dates_list(t: Tables):
    return TableStore(t.spark).load_table(
        f"""
        SELECT o_orderkey, date_format(o_orderdate, 'yyyy-MM-dd HH:mm') AS as_list,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
                    ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS bad_text
        FROM {t.in_sql('orders')}
        """,
        parse_dates=["as_list", "bad_text"],
    )


@query("SELECT l_orderkey, l_linenumber, l_shipdate AS slashed, date_trunc('second', l_shipdate) AS compact FROM lineitem")
def parse_dates_format(t: Tables):
    return TableStore(t.spark).load_table(
        f"""
        SELECT l_orderkey, l_linenumber, date_format(l_shipdate, 'dd/MM/yyyy') AS slashed,
               date_format(l_shipdate, "yyyyMMdd'T'HHmmss") AS compact
        FROM {t.in_sql('lineitem')}
        """,
        parse_dates={"slashed": "%d/%m/%Y", "compact": {"format": "%Y%m%dT%H%M%S", "errors": "raise"}},
    )


@query(
    """
    SELECT event_id, date_trunc('day', ts) AS d, date_trunc('second', ts) AS s,
           date_trunc('millisecond', ts) AS ms, ts AS us, ts AS ns
    FROM events
    """
)
def parse_dates_epoch(t: Tables):
    return TableStore(t.spark).load_table(
        f"""
        SELECT event_id, unix_date(CAST(ts AS DATE)) AS d, unix_seconds(CAST(ts AS TIMESTAMP)) AS s,
               unix_millis(CAST(ts AS TIMESTAMP)) AS ms, unix_micros(CAST(ts AS TIMESTAMP)) AS us,
               unix_micros(CAST(ts AS TIMESTAMP)) * 1000 AS ns
        FROM {t.in_sql('events')}
        """,
        parse_dates={"d": "D", "s": "s", "ms": "ms", "us": "us", "ns": "ns"},
    )


@query(
    """
    SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT user_id) AS BIGINT) AS users
    FROM events WHERE value > 10.5 GROUP BY event_type
    """
)
def execute_params(t: Tables):
    return TableStore(t.spark).execute(
        f"""
        SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users
        FROM {t.in_sql('events')} WHERE value > :low GROUP BY event_type
        """,
        params={"low": 10.5},
    )


@query(
    """
    SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
    WHERE o_orderstatus = 'F' OR CAST(o_orderdate AS DATE) > DATE '1999-06-30'
    ORDER BY o_orderdate, o_orderkey
    """
)
def filter_or_date(t: Tables):
    return TableStore(t.spark).execute(
        f"""
        SELECT o_orderkey, o_orderdate, o_orderstatus FROM {t.in_sql('orders')}
        WHERE o_orderstatus = :status OR to_date(o_orderdate) > to_date(:day)
        ORDER BY o_orderdate, o_orderkey
        """,
        params={"status": "F", "day": "1999-06-30"},
    )


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand IN ('Brand#3', 'Brand#7', 'Brand#19') AND p_size > 10")
def in_list_binds(t: Tables):
    stmt, params = replace_placeholders(
        f"SELECT p_partkey, p_brand, p_size FROM {t.in_sql('part')} WHERE p_brand IN (:brands) AND p_size > :size",
        [Placeholder(":brands", ["Brand#3", "Brand#7", "Brand#19"]), Placeholder(":size", 10)],
    )
    return TableStore(t.spark).execute(stmt, params)


@query(
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem "
    "WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')"
)
def in_list_semijoin(t: Tables):
    wanted = t("part").where("p_type = 'PROMO'").select("p_partkey")
    return filter_in(t("lineitem").select("l_orderkey", "l_partkey", "l_quantity"), "l_partkey", wanted)


@query(
    "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"
)
def not_in_list_antijoin(t: Tables):
    return filter_in(t("documents").select("doc_id", "lang", "n_chars"), "doc_id", t("labels").select("doc_id"), negate=True)


@query("SELECT p_name, p_retailprice, p_partkey FROM part WHERE p_name LIKE 'red%' ORDER BY p_name, p_retailprice DESC, p_partkey LIMIT 50")
def like_order_limit(t: Tables):
    stmt, params = replace_placeholders(
        f"SELECT p_name, p_retailprice, p_partkey FROM {t.in_sql('part')} WHERE p_name LIKE :start "
        "ORDER BY :order LIMIT :n",
        [
            Placeholder(":start", "red%"),
            Placeholder(":order", "p_name ASC, p_retailprice DESC, p_partkey", return_new_placeholders=False),
            Placeholder(":n", 50),
        ],
    )
    return TableStore(t.spark).execute(stmt, params)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_mktsegment DESC, c_acctbal ASC, c_custkey ASC LIMIT 100")
def order_spec_top(t: Tables):
    customer = t("customer")
    order = sort_columns("c_mktsegment DESC, c_acctbal ASC, c_custkey", customer.columns)
    return customer.orderBy(*order).limit(100).select("c_custkey", "c_name", "c_acctbal")


# Datetimes ----------------------------------------------------------------------


@query(
    """
    SELECT event_id, (ts AT TIME ZONE 'CET') AT TIME ZONE 'UTC' AS utc,
           (ts AT TIME ZONE 'CET') AT TIME ZONE 'America/Denver' AS denver
    FROM events
    """
)
def tz_localize_convert(t: Tables):
    events = t("events").select("event_id", "ts")
    aware = convert_datetime_columns(events, localize_tz="CET", target_tz="UTC")
    return aware.select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("utc"),
        F.convert_timezone(F.lit("UTC"), F.lit("America/Denver"), F.col("ts").cast("timestamp_ntz")).alias("denver"),
    )


@query(
    """
    WITH local AS (SELECT o_orderkey, o_orderdate + INTERVAL 150 MINUTE AS l FROM orders),
         u AS (SELECT o_orderkey, l, l AT TIME ZONE 'Europe/Paris' AS i FROM local)
    SELECT o_orderkey, l AS local_time, CAST((i AT TIME ZONE 'Europe/Paris') <> l AS INTEGER) AS gap,
           CAST(((i + INTERVAL 1 HOUR) AT TIME ZONE 'Europe/Paris') = l
                OR ((i - INTERVAL 1 HOUR) AT TIME ZONE 'Europe/Paris') = l AS INTEGER) AS ambiguous
    FROM u
    """
)
def tz_dst_flags(t: Tables):
    local = F.col("local_time")
    return (
        t("orders")
        .select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL '150' MINUTE")).alias("local_time"))
        .select(
            "o_orderkey",
            "local_time",
            dst_gap(local, "Europe/Paris").cast("int").alias("gap"),
            dst_ambiguous(local, "Europe/Paris").cast("int").alias("ambiguous"),
        )
    )


@query(
    """
    WITH local AS (SELECT o_orderkey, o_orderdate + INTERVAL 150 MINUTE AS l FROM orders),
         u AS (SELECT o_orderkey, l, l AT TIME ZONE 'Europe/Paris' AS i FROM local)
    SELECT o_orderkey,
           CASE WHEN (i AT TIME ZONE 'Europe/Paris') <> l
                  OR ((i + INTERVAL 1 HOUR) AT TIME ZONE 'Europe/Paris') = l
                  OR ((i - INTERVAL 1 HOUR) AT TIME ZONE 'Europe/Paris') = l
                THEN NULL ELSE CAST(floor(epoch(i)) AS BIGINT) END AS epoch
    FROM u
    """
)
def tz_dst_null(t: Tables):
    local = t("orders").select(
        "o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL '150' MINUTE")).alias("epoch")
    )
    return convert_datetime_columns(local, "int", localize_tz="Europe/Paris", target_tz="UTC", dst="null")


@query(
    """
    SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%d %b %Y (%a, day %j) %H:%M:%S') AS l_shipdate FROM lineitem
    """
)
def datetime_to_str(t: Tables):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return convert_datetime_columns(rows, "str", "%d %b %Y (%a, day %j) %H:%M:%S")


@query(
    """
    WITH w AS (SELECT o_orderkey, o_orderdate, (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS p
               FROM orders)
    SELECT o_orderkey,
           strftime(p, '%Y-%m-%d %H:%M:%S') || CASE WHEN date_diff('hour', o_orderdate, p) = 2 THEN '+0200' ELSE '+0100' END
             AS o_orderdate
    FROM w
    """
)
def datetime_to_str_offset(t: Tables):
    rows = t("orders").select("o_orderkey", "o_orderdate")
    return convert_datetime_columns(rows, "str", "%Y-%m-%d %H:%M:%S%z", localize_tz="UTC", target_tz="Europe/Paris")


@query("SELECT o_orderkey, strftime(o_orderdate, '%U/%W %w-%u %Y') || strftime(o_orderdate, ' %V %G') AS o_orderdate FROM orders")
def datetime_to_str_weeks(t: Tables):
    """Weeks that begin on Sunday and on Monday, days of the week, ISO weeks."""
    return convert_datetime_columns(t("orders").select("o_orderkey", "o_orderdate"), "str", "%U/%W %w-%u %Y %V %G")


@query(
    """
    WITH w AS (SELECT o_orderkey, o_orderdate, (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS p FROM orders)
    SELECT o_orderkey, strftime(p, '%H:%M ') || CASE WHEN date_diff('hour', o_orderdate, p) = 2 THEN 'CEST' ELSE 'CET' END
             || strftime(p, ' %d') AS o_orderdate FROM w
    """
)
def datetime_to_str_zone(t: Tables):
    rows = t("orders").select("o_orderkey", "o_orderdate")
    return convert_datetime_columns(rows, "str", "%H:%M %Z %d", localize_tz="UTC", target_tz="Europe/Paris")


@query("SELECT event_id, CAST(floor(epoch(ts - INTERVAL 60 YEAR)) AS BIGINT) AS old, CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM events")
def datetime_to_epoch(t: Tables):
    rows = t("events").select("event_id", "ts", (F.col("ts") - F.expr("INTERVAL '60' YEAR")).alias("old"))
    return convert_datetime_columns(rows, "int")


@query("SELECT event_id, CAST(floor(epoch(ts AT TIME ZONE 'CET')) AS BIGINT) + 3600 AS ts FROM events")
def datetime_to_local_epoch(t: Tables):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        return convert_datetime_columns(
            t("events").select("event_id", "ts"), "int", localize_tz="CET", local_epoch=True
        )


@query(
    """
    SELECT event_id, strftime((ts AT TIME ZONE 'CET') AT TIME ZONE 'America/Denver', '%Y-%m-%d %H:%M') AS ts, user_id
    FROM events
    """
)
def load_datetime_pipeline(t: Tables):
    return TableStore(t.spark).load_table(
        f"SELECT event_id, date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS ts, user_id FROM {t.in_sql('events')}",
        parse_dates="ts",
        localize_tz="CET",
        target_tz="America/Denver",
        datetime_cols_dtype="str",
        datetime_format="%Y-%m-%d %H:%M",
        index_col="event_id",
    )


# Text dates as people write them, long lists ------------------------------------


@query(
    """
    SELECT o_orderkey, o_custkey, date_trunc('day', o_orderdate) AS day, date_trunc('minute', o_orderdate) AS minute
    FROM orders
    """
)
def parse_dates_short_fields(t: Tables):
    """Days, months and hours of one digit, and text without the seconds that the format has."""
    return TableStore(t.spark).load_table(
        f"""
        SELECT o_orderkey, o_custkey, date_format(o_orderdate, 'd/M/yyyy') AS day,
               date_format(o_orderdate, 'yyyy-MM-dd H:mm') AS minute FROM {t.in_sql('orders')}
        """,
        parse_dates={"day": "%d/%m/%Y", "minute": "%Y-%m-%d %H:%M:%S"},
    )


@query(
    """
    SELECT event_id, make_timestamp(CASE WHEN user_id % 100 >= 69 THEN 1900 ELSE 2000 END + user_id % 100, 3, 7, 0, 0, 0) AS day
    FROM events
    """
)
def parse_dates_two_digit_year(t: Tables):
    return TableStore(t.spark).load_table(
        f"SELECT event_id, concat('07.3.', lpad(user_id % 100, 2, '0')) AS day FROM {t.in_sql('events')}",
        parse_dates={"day": "%d.%m.%y"},
    )


@query("SELECT event_id, date_trunc('second', ts) - INTERVAL 2 HOUR AS local, date_trunc('second', ts) AS zulu FROM events")
def parse_dates_offset_utc(t: Tables):
    """The offset in a text counts, with and without a format."""
    return TableStore(t.spark).load_table(
        f"""
        SELECT event_id, date_format(ts, "yyyy-MM-dd HH:mm:ss'+02:00'") AS local,
               date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") AS zulu FROM {t.in_sql('events')}
        """,
        parse_dates=["local", "zulu"],
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN date_trunc('day', o_orderdate) END AS day FROM orders
    """
)
def parse_dates_iso_strict(t: Tables):
    """A format is a format, also an ISO one: a bare year or month does not match it."""
    return TableStore(t.spark).load_table(
        f"""
        SELECT o_orderkey, date_format(o_orderdate, CASE o_orderkey % 3 WHEN 0 THEN 'yyyy-MM-dd 00:00:00' WHEN 1 THEN 'yyyy'
               ELSE 'yyyy-MM' END) AS day FROM {t.in_sql('orders')}
        """,
        parse_dates={"day": "%Y-%m-%d %H:%M:%S"},
    )


@query(
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate = date_trunc('day', o_orderdate) AND date_diff('day', TIMESTAMP '1990-01-01', o_orderdate) % 3 = 0
      AND date_diff('day', TIMESTAMP '1990-01-01', o_orderdate) BETWEEN 0 AND 14999
    """
)
def in_list_long(t: Tables):
    """Five thousand texts against a datetime column."""
    days = [str(date(1990, 1, 1) + timedelta(days=3 * k)) for k in range(5000)]
    return filter_in(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", days)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey % 2 = 0 AND l_partkey < 10000")
def in_list_coerced(t: Tables):
    """Five thousand fractions and whole floats against an integer column."""
    wanted = [float(k) if k % 2 == 0 else k + 0.5 for k in range(10000)]
    return filter_in(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", wanted)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def load_in_chunks(t: Tables):
    """All chunks of an iterator, kept in a list and read later."""
    n = -(-t("orders").count() // 7)
    sql = f"SELECT o_orderkey, o_custkey, o_totalprice FROM {t.in_sql('orders')}"
    chunks = list(TableStore(t.spark).load_table(sql, chunksize=n, order_by="o_orderkey"))
    return reduce(lambda a, b: a.unionByName(b), chunks)


# Missing values and chunks ------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL ELSE p_retailprice END AS price, p_name FROM part")
def nan_to_null_values(t: Tables):
    price = F.when(F.col("p_size") > 40, F.lit(float("nan"))).otherwise(F.col("p_retailprice"))
    return nan_to_null(t("part").select("p_partkey", price.alias("price"), "p_name"))


@query(
    "SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 700) AS BIGINT) AS chunk_id FROM orders"
)
def chunk_numbers(t: Tables):
    return chunk_ids(t("orders").select("o_orderkey"), 700, "o_orderkey")


@query(
    """
    WITH c AS (SELECT floor((row_number() OVER (ORDER BY l_shipdate) - 1) / 1000) AS chunk_id FROM lineitem)
    SELECT CAST(chunk_id AS BIGINT) AS chunk_id, CAST(count(*) AS BIGINT) AS n_rows FROM c GROUP BY chunk_id
    """
)
def chunk_sizes(t: Tables):
    chunks = chunk_ids(t("lineitem").select("l_shipdate", "l_orderkey"), 1000, "l_shipdate")
    return chunks.groupBy("chunk_id").agg(F.count("*").alias("n_rows"))


@query(
    "SELECT event_id, user_id, CAST(row_number() OVER (ORDER BY user_id DESC, event_id) - 1 AS BIGINT) AS position FROM events"
)
def row_positions(t: Tables):
    events = t("events").select("event_id", "user_id", (-F.col("user_id")).alias("down"))
    return with_positions(events, ["down", "event_id"]).df.select(
        "event_id", "user_id", F.col(POSITION).alias("position")
    )
