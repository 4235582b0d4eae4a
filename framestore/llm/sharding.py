"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

A ring of `2 ** CELL_BITS` cells carries `vnodes` virtual nodes per shard. A row
hashes to a cell and belongs to the next virtual node clockwise. A shard that is
full passes the rest of its rows on to the next virtual nodes whose shard has room.
The room of a shard is its exact share of the rows, so counts differ by one at most (law `rows`).

Only counts per virtual node come to the driver, at most `shards * vnodes` of
them. Rows are ranked inside (virtual node, input partition), so a key that
holds a third of the rows is never ranked in one task.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from framestore.llm.registry import query, table
from framestore.session import stage

CELL_BITS = 14


def ring(spark: SparkSession, shards: int, vnodes: int) -> list[tuple[int, int, int]]:
    """(cell, arc, shard) of every cell. Adding a shard only takes cells away from the others."""
    nodes = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("vnode")
    )
    cell = F.shiftrightunsigned(F.xxhash64(F.lit("node"), "shard", "vnode"), 64 - CELL_BITS)
    owner: dict[int, int] = {}
    for row in nodes.select(cell.alias("cell"), "shard").collect():
        owner[row["cell"]] = min(row["shard"], owner.get(row["cell"], shards))
    places = sorted(owner)
    cells, at = [], 0
    for c in range(1 << CELL_BITS):
        while at < len(places) and places[at] < c:
            at += 1
        arc = at % len(places)
        cells.append((c, arc, owner[places[arc]]))
    return cells


def bounded_loads(counts: list[int], shard_of: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Intervals (arc, from, to, shard, first slot) that place the `counts[arc]` rows of every arc.

    Every shard keeps its own rows up to its share; what is over walks clockwise,
    first come first served, to arcs whose shard has room left.
    """
    total, own = sum(counts), [0] * shards
    for arc, n in enumerate(counts):
        own[shard_of[arc]] += n
    share = [total // shards + (s < total % shards) for s in range(shards)]
    stays = [min(own[s], share[s]) for s in range(shards)]
    room = [share[s] - stays[s] for s in range(shards)]
    slot, placed, waiting = [0] * shards, [], deque()

    def put(arc: int, start: int, stop: int, shard: int) -> None:
        placed.append((arc, start, stop, shard, slot[shard]))
        slot[shard] += stop - start

    for step in range(2 * len(counts)):
        arc, shard = step % len(counts), shard_of[step % len(counts)]
        while waiting and room[shard]:
            from_arc, start, stop = waiting.popleft()
            n = min(room[shard], stop - start)
            put(from_arc, start, start + n, shard)
            room[shard] -= n
            if start + n < stop:
                waiting.appendleft((from_arc, start + n, stop))
        if step < len(counts):
            n = min(counts[arc], stays[shard])
            stays[shard] -= n
            if n:
                put(arc, 0, n, shard)
            if counts[arc] > n:
                waiting.append((arc, n, counts[arc]))
    return placed


def shard(docs: DataFrame, shards: int = 8, vnodes: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `size` (UTF-8 bytes and 1), `text_crc32`, `home` (the
    shard before loads were bounded), `shard`, `slot` (from 0 without gaps in each shard).

    A row without an id is placed by a hash of its row number, a null text counts as
    empty; repeated rows are placed one by one. An empty table gives no rows. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.monotonically_increasing_id().alias("row"),
    )
    key = F.when(F.col("id").isNull(), F.xxhash64(F.lit("row"), "row")).otherwise(F.xxhash64("id"))
    rows, _ = stage(rows.withColumn("hash", key), "shards")
    cells = ring(spark, shards, vnodes)
    arcs = {arc: owner for _, arc, owner in cells}
    # Fixed size: one row per cell of the ring.
    owners = F.broadcast(spark.createDataFrame(cells, "cell int, arc int, home int"))
    cell = F.shiftrightunsigned("hash", 64 - CELL_BITS).cast("int")
    rows = rows.withColumn("cell", cell).join(owners, "cell").withColumn("part", F.shiftright("row", 33).cast("int"))
    parts = rows.groupBy("arc", "part").agg(F.count("*").alias("n"))
    counted = {r["arc"]: r["n"] for r in parts.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    counts = [counted.get(arc, 0) for arc in range(len(arcs))]
    placed = bounded_loads(counts, [arcs[arc] for arc in range(len(arcs))], shards)
    # At most two intervals per virtual node and one per shard that fills up.
    plan = F.broadcast(spark.createDataFrame(placed, "arc int, start bigint, stop bigint, shard int, slot bigint"))
    earlier = Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("arc", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("arc", "part").orderBy("hash", "row")) - 1
    ranked = rows.withColumn("place", place).join(before, ["arc", "part"])
    ranked = ranked.withColumn("place", F.col("place") + F.col("before"))
    found = ranked.join(plan.withColumnRenamed("arc", "arc_"), (F.col("arc") == F.col("arc_")) & (F.col("place") >= F.col("start")) & (F.col("place") < F.col("stop")))
    return found.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "home", "shard",
        (F.col("slot") + F.col("place") - F.col("start")).alias("slot"),
    )


@query()
def op8_sharding(spark, sf_dir):
    rows = shard(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home"
    )
