"""Queries: integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from framestore.operators.checks import (
    check_violations,
    existing_key_violations,
    foreign_key_violations,
    not_null_violations,
    orphan_keys,
    referenced_keys_gone,
    unique_violations,
)
from framestore.plans.registry import Tables, query


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0)
    """
)
def fk_violations(t: Tables):
    """Orders must refer to a customer without debt."""
    parents = t("customer").where("c_acctbal > 0")
    return foreign_key_violations(t("orders").select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey")


@query(
    """
    SELECT k AS o_custkey, CAST(count(*) AS BIGINT) AS n_rows
    FROM (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS k FROM orders) o
    WHERE k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = k AND c.c_acctbal > 0)
    GROUP BY k
    """
)
def fk_orphan_keys(t: Tables):
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("o_custkey")
    return orphan_keys(t("orders").select(key), "o_custkey", t("customer").where("c_acctbal > 0"), "c_custkey")


@query(
    """
    SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_rows FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal <= 0) GROUP BY o_custkey
    """
)
def fk_removed_references(t: Tables):
    """Orders of customers that go."""
    gone, kept = t("customer").where("c_acctbal <= 0"), t("customer").where("c_acctbal > 0")
    return referenced_keys_gone(t("orders"), "o_custkey", gone, kept, "c_custkey")


@query(
    "SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    name="unique_violations",
)
def repeated_lines(t: Tables):
    return unique_violations(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def unique_violations_on_append(t: Tables):
    return existing_key_violations(t("documents").select("doc_id"), t("labels"), "doc_id")


@query(
    """
    SELECT 'NOT NULL(b)' AS "constraint", c_custkey, b, s FROM
        (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS b,
                CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS s FROM customer) WHERE b IS NULL
    UNION ALL
    SELECT 'NOT NULL(s)', c_custkey, b, s FROM
        (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS b,
                CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS s FROM customer) WHERE s IS NULL
    """,
    name="not_null_violations",
)
def missing_values(t: Tables):
    rows = t("customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("b"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("s"),
    )
    return not_null_violations(rows, ["b", "s"])


@query(
    """
    SELECT 'CHECK(cheap)' AS "constraint", l_orderkey, l_extendedprice, l_discount FROM lineitem
    WHERE NOT (l_extendedprice < 50000)
    UNION ALL
    SELECT 'CHECK(discount)', l_orderkey, l_extendedprice, l_discount FROM lineitem
    WHERE NOT (CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_discount END <= 0.05)
    """,
    name="check_violations",
)
def failed_checks(t: Tables):
    rows = t("lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_returnflag")
    checks = {
        "cheap": "l_extendedprice < 50000",
        "discount": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_discount END <= 0.05D",
    }
    return check_violations(rows, checks).drop("l_returnflag")
