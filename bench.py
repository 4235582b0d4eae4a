"""Headline queries on the tables in $BENCH_SF_DIR. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from framestore.functions import convert_datetime_columns  # noqa: E402
from framestore.operators.chunks import chunk_ids  # noqa: E402
from framestore.operators.merge import merge  # noqa: E402
from framestore.operators.upsert import upsert  # noqa: E402
from framestore.plans import QUERIES
from framestore.plans.registry import Tables  # noqa: E402
from framestore.store import TableStore  # noqa: E402

WARM_UPS = int(os.environ.get("BENCH_WARM_UPS", "1"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
ADAPTIVE_BROADCAST = "spark.sql.adaptive.autoBroadcastJoinThreshold"


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def new_prices(t: Tables) -> DataFrame:
    return t("orders").withColumn("o_totalprice", F.col("o_totalprice") + 100)


def load_filter_cast(t: Tables) -> None:
    compute(
        TableStore(t.spark).load_table(
            f"SELECT o_orderkey, o_totalprice, o_orderpriority FROM {t.in_sql('orders')} WHERE o_totalprice > :p",
            params={"p": 100000.0},
            dtypes={"o_orderkey": "string", "o_totalprice": "int64"},
        )
    )


def upsert_small_source(t: Tables) -> None:
    recent = new_prices(t).where("o_orderdate >= '2001-01-01'")
    known = t("orders").where("o_orderpriority <> '1-URGENT'")
    compute(upsert(known, recent, "o_orderkey", on_duplicate="unique"))


def upsert_whole_source(t: Tables) -> None:
    t.spark.conf.set(BROADCAST, "-1")
    t.spark.conf.set(ADAPTIVE_BROADCAST, "-1")
    try:
        known = t("orders").where("o_orderpriority <> '1-URGENT'")
        compute(upsert(known, new_prices(t), "o_orderkey", on_duplicate="unique"))
    finally:
        t.spark.conf.unset(BROADCAST)
        t.spark.conf.unset(ADAPTIVE_BROADCAST)


def upsert_duplicate_keys(t: Tables) -> None:
    users = t("events").where("event_type = 'error'").select("user_id", "event_type", "value").dropDuplicates(["user_id"])
    compute(upsert(users, t("events"), "user_id", ["user_id", "event_type", "value"], order_by="event_id"))


def merge_changed_only(t: Tables) -> None:
    price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    source = t("orders").withColumn("o_totalprice", price)
    compute(merge(t("orders"), source, "o_orderkey", omit_update_where_clause=False, on_duplicate="unique"))


def datetime_events(t: Tables) -> None:
    rows = t("events").select("event_id", "ts")
    compute(convert_datetime_columns(rows, "str", "%Y-%m-%d %H:%M:%S%z", "CET", "America/Denver"))


def datetime_lineitem(t: Tables) -> None:
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    compute(convert_datetime_columns(rows, "str", "%Y-%m-%d %H:%M:%S", "CET", "UTC"))


def replace_staged(t: Tables) -> None:
    store = t.store()
    store.save_df(t("lineitem"), "lineitem")
    store.save_df(store.load_table("lineitem").where("l_returnflag <> 'R'"), "lineitem", "replace")
    store.execute(f"DROP DATABASE {store.database} CASCADE")


def table_upsert(t: Tables) -> None:
    store = t.store()
    store.save_df(t("orders").where("o_orderpriority <> '1-URGENT'"), "orders")
    store.upsert_table(new_prices(t), "orders", "o_orderkey", on_duplicate="unique")
    store.execute(f"DROP DATABASE {store.database} CASCADE")


def chunk_lineitem(t: Tables) -> None:
    rows = t("lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    compute(chunk_ids(rows, 10000, ["l_shipdate", "l_orderkey", "l_linenumber"]))


def named(query: str):
    """A query of the correctness check as a bench."""

    def run(t: Tables) -> None:
        compute(QUERIES[query](t.spark, t.folder))

    run.__name__ = query
    return run


# Query and the table whose rows give the rate.
BENCHES = [
    (named("in_list_long"), "orders"),
    (named("merge_changed_only_duplicates"), "events"),
    (named("table_upsert_partitioned"), "orders"),
    (named("unique_violations_on_append"), "orders"),
    (load_filter_cast, "orders"),
    (upsert_small_source, "orders"),
    (upsert_whole_source, "orders"),
    (upsert_duplicate_keys, "events"),
    (merge_changed_only, "orders"),
    (datetime_events, "events"),
    (datetime_lineitem, "lineitem"),
    (replace_staged, "lineitem"),
    (table_upsert, "orders"),
    (named("table_upsert_touched_files"), "orders"),
    (chunk_lineitem, "lineitem"),
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("framestore-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, folder)
    rows = {name: t(name).count() for name in {table for _, table in BENCHES}}
    times, rates = {}, {}
    for bench, table in BENCHES:
        for _ in range(WARM_UPS):
            bench(t)
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            bench(t)
            taken.append(time.perf_counter() - start)
        times[bench.__name__] = round(statistics.median(taken), 4)
        rates[bench.__name__] = round(rows[table] / statistics.median(taken))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": rates,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
