"""Datetimes, parsing, casts, missing values, parameters, checks, chunks, JDBC options."""

from __future__ import annotations

import datetime as dt
import zoneinfo
import math

import pytest
from pyspark.sql import functions as F

from framestore import Constraints, JdbcSource, Placeholder, filter_in, replace_placeholders, sort_columns
from framestore.errors import FramestoreError, InvalidColumnNameError, InvalidInputError, InvalidTableNameError
from framestore.functions import cast_columns, convert_datetime_columns, nan_to_null, parse_dates
from framestore.functions.strftime import split_format
from framestore.operators.checks import enforce
from framestore.operators.chunks import POSITION, chunk_ids, iter_chunks, with_positions
from framestore.validation import check_table_name, plan_columns


def naive(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string").select(
        "i", F.col("d").cast("timestamp_ntz").alias("d")
    )


def values(df, name="d"):
    return [r[name] for r in df.orderBy("i").collect()]


# Golden values.


def test_epoch_golden_values(spark):
    df = naive(spark, "2009-06-06 09:06:08", "1970-01-01", "1969-12-31 23:59:59.5", "1865-01-02 03:04:05", None)
    expected = [1244279168, 0, -1, -3313342555, None]
    assert values(convert_datetime_columns(df, "int")) == expected
    cet = naive(spark, "2021-06-18 21:48:00", "2008-01-01 00:01:00")
    assert values(convert_datetime_columns(cet, "int", localize_tz="CET", target_tz="UTC")) == [1624045680, 1199142060]


def test_text_golden_values(spark):
    df = naive(spark, "1990-07-14", "1970-01-14")
    got = convert_datetime_columns(df, "str", "%Y-%m-%d %H:%M:%S%z", "UTC", "CET")
    assert values(got) == ["1990-07-14 02:00:00+0200", "1970-01-14 01:00:00+0100"]
    assert dict(got.dtypes)["d"] == "string"


def test_formats_equal_strftime(spark):
    moments = [dt.datetime(2012, 2, 29, 13, 4, 5, 678), dt.datetime(1999, 12, 31, 0, 0, 1), dt.datetime(2024, 8, 9, 12)]
    df = naive(spark, *[str(m) for m in moments])
    for fmt in ("%Y-%m-%d %H:%M:%S", "%d/%m/%y", "%j|%b|%B", "%a %A %I:%M %p", "%H:%M:%S.%f", "it's %Y%%", "%d%d", "%F %T",
                "%D %R", "%Y%m%dT%H%M", "no directive", "%Y-%m-%d%z %Z", "%U%W", "it's %w, %u %V/%G"):
        assert values(convert_datetime_columns(df, "str", fmt)) == [m.strftime(fmt) for m in moments], fmt


def test_weeks_equal_strftime(spark):
    days = [dt.datetime(y, 1, 1) + dt.timedelta(d) for y in (1999, 2000, 2012, 2017, 2018, 2023) for d in (*range(10), 200, *range(355, 366))]
    df = naive(spark, *[str(d) for d in days])
    assert values(convert_datetime_columns(df, "str", "%U %W %w %u %V %G")) == [d.strftime("%U %W %w %u %V %G") for d in days]


@pytest.mark.parametrize("tz", ["Europe/Paris", "America/Denver", "Asia/Kathmandu", "Africa/Casablanca", "EET", "Australia/Lord_Howe", "UTC"])
def test_zone_names_equal_strftime(spark, tz):
    zone = zoneinfo.ZoneInfo(tz)
    moments = [dt.datetime(1700, 5, 6), dt.datetime(1885, 1, 1), *[dt.datetime(y, 1, 1, 7) + dt.timedelta(37 * k) for y in (1919, 1945, 1974, 1996, 2024, 2090) for k in range(10)],
               *[dt.datetime(2021, 3, 28, h, m) for h in (0, 1) for m in (0, 59)], dt.datetime(2399, 12, 31, 23), dt.datetime(2400, 1, 1), dt.datetime(2599, 12, 31, 23), dt.datetime(2600, 1, 1), dt.datetime(3021, 7, 1)]
    df = naive(spark, *[str(m) for m in moments], None)
    got = values(convert_datetime_columns(df, "str", "%Z", "UTC", tz))
    assert got == [m.replace(tzinfo=dt.timezone.utc).astimezone(zone).tzname() for m in moments] + [None]


def test_computed_directives_cannot_be_parsed(spark):
    from framestore.functions.strftime import parse_patterns

    for letter in "ZUWwuVG":
        with pytest.raises(InvalidInputError):
            parse_patterns(f"%Y %{letter}")


def test_zone_label_follows_the_column(spark):
    df = naive(spark, "2021-01-01 12:00:00")
    local = convert_datetime_columns(df, localize_tz="America/Denver")
    assert local.schema["d"].metadata == {"tz": "America/Denver"}
    assert values(local.withColumn("d", F.col("d").cast("timestamp_ntz"))) == [dt.datetime(2021, 1, 1, 19)]
    # An aware column is not localized again, only converted.
    again = convert_datetime_columns(local, "str", "%H:%M %z", localize_tz="CET", target_tz="EET")
    assert values(again) == ["21:00 +0200"]
    assert values(convert_datetime_columns(local, "str", "%H:%M %z")) == ["12:00 -0700"]


def test_only_datetime_columns_are_converted(spark):
    df = spark.sql("SELECT 1 AS i, TIMESTAMP_NTZ'2020-01-02 03:04:05' AS d, '2020-01-01' AS s, DATE'2020-01-01' AS day, 1.5D AS x")
    got = convert_datetime_columns(df, "int")
    assert got.dtypes == [("i", "int"), ("d", "bigint"), ("s", "string"), ("day", "date"), ("x", "double")]
    assert df.columns == got.columns and convert_datetime_columns(df) is df


@pytest.mark.parametrize("zone, gap, twice", [
    ("Europe/Paris", "2021-03-28 02:30:00", "2021-10-31 02:30:00"),
    ("America/Denver", "2021-03-14 02:30:00", "2021-11-07 01:30:00"),
    ("Australia/Lord_Howe", "2021-10-03 02:15:00", "2021-04-04 01:45:00"),
])
def test_clock_changes(spark, zone, gap, twice):
    for bad in (gap, twice):
        df = naive(spark, bad)
        with pytest.raises(Exception, match="Non-existent or ambiguous"):
            convert_datetime_columns(df, localize_tz=zone).collect()
        assert values(convert_datetime_columns(df, localize_tz=zone, dst="null")) == [None]
        assert values(convert_datetime_columns(df, localize_tz=zone, dst="shift")) != [None]
    edges = naive(spark, gap[:11] + "00:30:00", gap[:11] + "04:00:00", twice[:11] + "00:30:00", twice[:11] + "04:00:00", None)
    assert [v is None for v in values(convert_datetime_columns(edges, localize_tz=zone))] == [False] * 4 + [True]


def test_localize_equals_zoneinfo(spark):
    from zoneinfo import ZoneInfo

    zone = ZoneInfo("Europe/Paris")
    moments = [dt.datetime(2021, 3, 27) + dt.timedelta(minutes=20 * i) for i in range(200)]
    moments += [dt.datetime(2021, 10, 30) + dt.timedelta(minutes=20 * i) for i in range(200)]
    expected = []
    for m in moments:
        first, second = (m.replace(tzinfo=zone, fold=f) for f in (0, 1))
        exact = first.utcoffset() == second.utcoffset()
        expected.append(int(first.timestamp()) if exact else None)
    df = naive(spark, *[str(m) for m in moments])
    got = values(convert_datetime_columns(df, "int", localize_tz="Europe/Paris", target_tz="UTC", dst="null"))
    assert got == expected


def test_datetime_errors(spark):
    df = naive(spark, "2021-01-01")
    for bad in ({"dtype": "float"}, {"target_tz": "CET"}, {"localize_tz": "Nowhere"}, {"dtype": "str", "datetime_format": "%q"},
                {"localize_tz": "UTC", "target_tz": "Mars"}, {"dtype": "str", "datetime_format": 3}, {"dst": "guess"}):
        with pytest.raises(InvalidInputError):
            convert_datetime_columns(df, **bad)
    with pytest.warns(UserWarning):
        local = convert_datetime_columns(df, "int", localize_tz="CET", local_epoch=True)
    assert values(local) == [int(dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc).timestamp())]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(InvalidInputError):
            convert_datetime_columns(df, "int")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_dates(spark):
    df = spark.sql("SELECT 1 AS i, '2021-06-18 21:48' AS a, '18.06.2021' AS b, 18796 AS day, 1.5D AS sec, -1L AS ns, 'bad' AS bad,"
                   " '2021-06-18 21:48:00+0200' AS z")
    got = parse_dates(df, {"a": "%Y-%m-%d %H:%M:%S", "b": "%d.%m.%Y", "day": "D", "sec": "s", "ns": "ns", "bad": "%Y",
                           "z": "%Y-%m-%d %H:%M:%S%z", "unknown": "%Y"}).first()
    assert got["a"] == dt.datetime(2021, 6, 18, 21, 48) and got["b"] == dt.datetime(2021, 6, 18)
    assert got["day"] == dt.datetime(2021, 6, 18) and got["sec"] == dt.datetime(1970, 1, 1, 0, 0, 1, 500000)
    assert got["ns"] == dt.datetime(1969, 12, 31, 23, 59, 59, 999999) and got["bad"] is None
    assert parse_dates(df, "z").dtypes[-1] == ("z", "timestamp_ntz")
    assert parse_dates(df, {"a": {"utc": True}}).schema["a"].metadata == {"tz": "UTC"}
    with pytest.raises(Exception):
        parse_dates(df, {"bad": {"errors": "raise"}}).collect()
    with pytest.raises(InvalidInputError):
        parse_dates(df, {"a": {"dayfirst": True}})


def test_casts(spark):
    df = spark.sql("SELECT 200 AS u, '1' AS s, 1 AS b, 2.5D AS x")
    got = cast_columns(df, {"u": "uint8", "s": "Int16", "b": bool, "x": "string"})
    assert got.dtypes == [("u", "smallint"), ("s", "smallint"), ("b", "boolean"), ("x", "string")]
    assert tuple(got.first()) == (200, 1, True, "2.5")
    with pytest.raises(Exception, match="outside"):
        cast_columns(spark.sql("SELECT 300 AS u"), {"u": "uint8"}).collect()


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1, float("nan"), "a"), (2, 1.0, None), (3, None, "NaN")], "i int, x double, s string")
    assert [tuple(r) for r in nan_to_null(df).orderBy("i").collect()] == [(1, None, "a"), (2, 1.0, None), (3, None, "NaN")]
    assert math.isnan(df.orderBy("i").first()["x"])


# Parameters.


def test_placeholders():
    stmt, params = replace_placeholders(
        "SELECT * FROM t WHERE a IN (:xs) AND b LIKE :like AND c = ':xs' AND d = :xsmall ORDER BY :order LIMIT :n;",
        [Placeholder(":xs", [1, 2.5, None]), Placeholder("like", "A%"), Placeholder(":order", ["a ASC", "b DESC"], False),
         Placeholder(":n", 3)],
    )
    assert stmt == ("SELECT * FROM t WHERE a IN (:v0, :v1, :v2) AND b LIKE :v3 AND c = ':xs' AND d = :xsmall "
                    "ORDER BY a ASC, b DESC LIMIT :v4;")
    assert params == {"v0": 1, "v1": 2.5, "v2": None, "v3": "A%", "v4": 3}
    assert replace_placeholders("a IN (:x)", Placeholder(":x", [])) == ("a IN (NULL)", {})
    assert replace_placeholders("a = :x", Placeholder(":x", True), prefix="p") == ("a = :p0", {"p0": True})
    for bad in ([1, [2]], {"a": 1}, object(), [dt.date(2020, 1, 1)]):
        with pytest.raises(InvalidInputError):
            replace_placeholders("a = :x", Placeholder(":x", bad))


@pytest.mark.parametrize("n", [0, 3, 500])
def test_filter_in(spark, n):
    df = spark.range(1000).select(F.when(F.col("id") != 7, F.col("id")).alias("id"))
    wanted = list(range(5, 5 + n)) + ([None] if n else [])
    inside = {r[0] for r in filter_in(df, "id", wanted).collect()}
    outside = {r[0] for r in filter_in(df, "id", wanted, negate=True).collect()}
    assert inside == set(range(5, 5 + n)) - {7} and outside == set(range(1000)) - inside - {7}


def test_sort_columns(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "i int, s string")
    order = lambda spec: [r["i"] for r in df.orderBy(*sort_columns(spec, df.columns)).collect()]
    assert order("s DESC, i") == [1, 3, 2] and order(["s asc nulls last"]) == [3, 1, 2] and order("s") == [2, 3, 1]
    for bad, error in (("s; DROP TABLE t", InvalidInputError), ("nope", InvalidColumnNameError)):
        with pytest.raises(error):
            sort_columns(bad, df.columns)


def test_names_and_columns():
    assert check_table_name("db.t") == "db.t"
    for bad in ("a b", "DELETE FROM t", "", " t"):
        with pytest.raises(InvalidTableNameError):
            check_table_name(bad)
    with pytest.raises(InvalidInputError):
        check_table_name(None)
    plan = plan_columns(["a", "b", "c", "d"], "a", ("b", "c"), index_cols=["a", "d"], chosen_index=True)
    assert (plan.keys, plan.update, plan.insert) == (("a",), ("b", "c", "d"), ("b", "c", "a", "d"))
    plan = plan_columns(["a", "b", "c"], ["a", "b"], None, index_cols="c", chosen_index=["c"])
    assert (plan.update, plan.insert, plan.needed) == (("c",), ("c",), ["a", "b", "c"])
    with pytest.raises(InvalidInputError):
        split_format("%Q")


# Chunks.


@pytest.mark.parametrize("n, sizes", [(2, [2, 2, 2, 1]), (3, [3, 3, 1]), (4, [4, 3]), (10, [7])])
def test_chunk_sizes(spark, n, sizes):
    df = spark.range(7).repartition(3)
    assert [c.count() for c in iter_chunks(df, n, "id")] == sizes
    counted = chunk_ids(df, n, "id").groupBy("chunk_id").count().orderBy("chunk_id").collect()
    assert [r["count"] for r in counted] == sizes


def test_positions_with_equal_order_values(spark):
    df = spark.range(3000).select("id", F.lit(1).alias("same"))
    got = with_positions(df, "same", num_partitions=6)
    assert sorted(r[0] for r in got.df.select(POSITION).collect()) == list(range(3000))
    # Many equal values do not end in one partition.
    assert len(got.partitions) > 1
    assert chunk_ids(df, None).select("chunk_id").distinct().collect()[0][0] == 0


# Checks and JDBC options.


def test_enforce_counts_all_rules(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, None, -1.0), (None, "c", None)], "id int, s string, x double")
    with pytest.raises(FramestoreError) as e:
        enforce(df, Constraints(primary_key="id", not_null=["s"], checks={"x": "x >= 0"}))
    assert {k: v[0] for k, v in e.value.data.items()} == {
        "NOT NULL(s)": 1, "NOT NULL(id)": 1, "CHECK(x)": 1, "PRIMARY KEY(id)": 1}
    enforce(df.where("s = 'a'"), Constraints(primary_key="id", not_null=["s"], checks={"x": "x >= 0"}))


def test_jdbc_options():
    db = JdbcSource("jdbc:vendor://host/db", driver="vendor.Driver", options={"user": "u", "password": "secret"})
    assert "secret" not in repr(db)
    assert db.read_options("item")["dbtable"] == "item"
    assert db.read_options("SELECT * FROM item;")["query"] == "SELECT * FROM item"
    split = db.read_options("SELECT 1", partition_column="id", lower_bound=0, upper_bound=10, num_partitions=4, fetchsize=5)
    assert split["dbtable"] == "(SELECT 1) source_query" and split["numPartitions"] == "4" and split["fetchsize"] == "5"
    with pytest.raises(InvalidInputError):
        db.read_options("item", partition_column="id")
    assert db.write_options("item", "replace", chunksize=7)[1]["truncate"] == "true"
    assert [db.write_options("item", m)[0] for m in ("append", "drop-replace", "fail")] == ["append", "overwrite", "errorifexists"]
    assert "truncate" not in db.write_options("item", "drop-replace")[1]
    with pytest.raises(InvalidInputError):
        db.write_options("item", "upsert")


def test_jdbc_upsert_stages_before_it_truncates(spark, monkeypatch):
    db, written = JdbcSource("jdbc:vendor://host/db"), {}
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    monkeypatch.setattr(JdbcSource, "read", lambda self, spark, sql, columns=None, **kw: target)

    def write(self, df, table, if_exists, chunksize=None):
        written[table, if_exists] = sorted(tuple(r) for r in df.collect())
        assert "FileScan" in df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(JdbcSource, "write", write)
    assert db.load_table(spark, "item", dtypes={"id": "string"}, index_col="s").dtypes == [("s", "string"), ("id", "string")]
    db.upsert(spark.createDataFrame([(2, "B"), (3, "c")], "id int, s string"), "item", "id")
    assert written == {("item", "replace"): [(1, "a"), (2, "B"), (3, "c")]}
