"""Exact deduplication: digest runs merged as a tree, in DataFrame operations only.

Every leaf is the run of sorted digests of some input partitions. In each round
`fan_in` neighbouring runs exchange their rows by digest and are merged; a merge
keeps, per digest, the row that stays and the number of rows. So a group of
copies, however large, is one row per run before it moves, and no task ever
holds its members. The digest is SHA-256 of the normalised text, verified by its
length and a second, independent hash at every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from framestore.llm.registry import query, table
from framestore.session import stage

WHITE = r"[\x20\x09-\x0D]+"
_KEY = ("sha", "length", "check")


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def digest_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One small row per document: row number, id, digest with its two checks, original length."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("long").alias("size"),
        normalised(F.col(f"`{text_col}`")).alias("norm"),
    )
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "size",
        F.sha2(F.col("norm"), 256).alias("sha"),
        F.octet_length("norm").alias("length"),
        F.xxhash64("norm").alias("check"),
    )


def merge_runs(rows: DataFrame, runs: int = 64, fan_in: int = 8) -> DataFrame:
    """Per digest the first row in (longest text, smallest id) and the number of rows.

    `rows` come from `digest_rows`. `runs` leaf runs are merged `fan_in` at a time
    until one is left, which is itself spread over all partitions by digest.
    """
    # Longest text first, a null id last; the row number decides between repeated rows.
    rank = F.struct((-F.col("size")).alias("shorter"), F.col("id").isNull().alias("no_id"), "id", "row")
    level = rows.select(
        *_KEY, (F.shiftright("row", 33) % runs).cast("int").alias("run"), rank.alias("best"), F.lit(1).cast("long").alias("n")
    )
    while True:
        level = level.groupBy("run", *_KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        if runs == 1:
            return level.drop("run")
        runs = -(-runs // fan_in)
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 64, fan_in: int = 8
) -> DataFrame:
    """One row per row of `docs`: its id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Rows are equal when their texts are, white space apart. Of equal rows the one with
    the most code points stays, then the one with the smallest id; a null id comes
    last, and of wholly repeated rows exactly one stays. Null and empty texts
    are one group. An empty table gives no rows. Other columns are ignored.
    """
    rows, _ = stage(digest_rows(docs, id_col, text_col), "digests")
    groups = merge_runs(rows, runs, fan_in)
    return rows.join(groups, list(_KEY)).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


@query(
    oracle=r"""
    WITH d AS (
        SELECT doc_id, coalesce(length(text), 0) AS size,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           row_number() OVER w = 1 AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id)
    """
)
def op9_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
