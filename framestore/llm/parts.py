"""Rows kept in parts as they were written, and what recurs among the keys of all parts.

A part is a run of `PART_ROWS` rows of an input partition. A table bucketed by part is read and grouped
by it without being moved. Small answers to a part's questions go to it by cogroup; the rows stay where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from framestore.session import delete_path, note_staged, shared_folder

#: Rows of a part, all of which are in the memory of one task at a time.
PART_ROWS = 2048
#: Texts of more bytes than this are a part by themselves, where the size of the rows is given.
PART_TEXT = 32 << 10


def dealing(spark: SparkSession) -> tuple[int, int]:
    """(partitions, bits): keys are dealt by their first `bits` bits, several buckets to a partition."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return n, max(6, (2 * n - 1).bit_length())


@contextmanager
def kept_by_part(df: DataFrame, size: Column | None = None, lasting: bool = True) -> Iterator[tuple[DataFrame, DataFrame]]:
    """`df` with a column `part`, written as a table of the shared folder that is bucketed by it.

    With the `size` of the rows in bytes, a part has at most PART_ROWS rows of at most PART_TEXT bytes, or one longer row. A task writes a file for each of its buckets, about one per part. The table leaves the
    catalog at the end; what is made of it has to be staged before. The second frame reads its
    files without the buckets, also afterwards if they are `lasting`; else they go at the end as well.
    """
    spark = df.sparkSession
    name = f"framestore_parts_{uuid.uuid4().hex}"
    row = F.monotonically_increasing_id()
    part = F.floor(row / PART_ROWS)
    part = part if size is None else F.when(size > PART_TEXT, -1 - row).otherwise(part)
    writer = df.withColumn("part", part).write.bucketBy(dealing(spark)[0], "part").format("parquet")
    path = f"{shared_folder(spark)}/framestore/{name}"
    note_staged(path)
    writer.option("path", path).saveAsTable(name)
    try:
        kept = spark.table(name)
        yield kept, spark.read.schema(kept.schema).parquet(path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        if not lasting:
            delete_path(spark, path)


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(part, rows): a task may read the files of several parts, one after the other."""
    for batch in batches:
        parts = batch.column("part").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])).tolist() if len(parts) else []
        for a, b in zip(cuts, [*cuts[1:], len(parts)]):
            yield int(parts[a]), batch.slice(a, b - a)


def spans_of(dealt: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted numbers of 32 + `bits` bits by their first bits."""
    ends = np.searchsorted(dealt >> np.uint64(32), np.arange(1 << bits, dtype=np.uint64), "right")
    return [(i, a, b) for i, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())) if b > a]


def low_bits(dealt: np.ndarray) -> np.ndarray:
    return (dealt & np.uint64(0xFFFFFFFF)).astype("<u4")


DEALT = "bucket int, part bigint, keys binary, often binary"


def deal(keys: np.ndarray, owners: np.ndarray, part: int, bits: int) -> pa.RecordBatch:
    """The distinct keys (64-bit) of some owners, by bucket, and whether two of the owners have them."""
    order = np.lexsort((owners, keys))
    key, owner = (keys >> np.uint64(32 - bits))[order], owners[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    last = np.concatenate([start[1:], [len(key)]]) - 1 if len(start) else start
    key, several = key[start], (owner[start] != owner[last]).astype(np.uint8)
    spans, low = spans_of(key, bits), low_bits(key)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _, _ in spans], pa.int32()), pa.array([part] * len(spans), pa.int64()),
            pa.array([low[a:b].tobytes() for _, a, b in spans], pa.binary()),
            pa.array([np.packbits(several[a:b]).tobytes() for _, a, b in spans], pa.binary()),
        ],
        ["bucket", "part", "keys", "often"],
    )


def recurring(dealt: DataFrame, hot: int | None = None) -> DataFrame:
    """(part, keys): for each part and bucket those of its keys (first 32 + bits bits) that recur.

    With `hot` also the column `hot`: those of the keys that more pieces than that have. `dealt` has the columns of `deal`, all of a bucket in one partition. A key comes once from each piece dealt, however many owners it has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, part, low, often in zip(*(c.to_pylist() for c in batch.columns)):
                low = np.frombuffer(low, "<u4")
                held.setdefault(bucket, []).append((part, low, np.unpackbits(np.frombuffer(often, np.uint8), count=len(low))))
        for bucket in list(held):
            pieces = held.pop(bucket)
            low = np.concatenate([x for _, x, _ in pieces])
            part = np.repeat(np.array([p for p, _, _ in pieces]), [len(x) for _, x, _ in pieces])
            _, of, n = np.unique(low, return_inverse=True, return_counts=True)
            again = n > 1
            again[of[np.concatenate([x for _, _, x in pieces]) == 1]] = True
            keep = again[of]
            low, part, n = low[keep], part[keep], n[of[keep]]
            if not len(part):
                continue
            order = np.argsort(part, kind="stable")
            low, part, n = (bucket << 32) + low[order].astype(np.int64), part[order], n[order]
            parts, start = np.unique(part, return_index=True)
            columns = [pa.array(parts, pa.int64()), pa.array([x.tobytes() for x in np.split(low, start[1:])], pa.binary())]
            if hot is not None:
                pairs = zip(np.split(low, start[1:]), np.split(n > hot, start[1:]))
                columns.append(pa.array([x[many].tobytes() for x, many in pairs], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["part", "keys", "hot"][: len(columns)])

    return dealt.mapInArrow(run, "part bigint, keys binary" + (", hot binary" if hot is not None else ""))


def answers(found: pa.Table, column: str = "keys") -> np.ndarray:
    """The sorted keys that came back to a part."""
    keys = np.frombuffer(b"".join([x for x in found.column(column).to_pylist() if x]), np.int64)
    return np.unique(keys).view(np.uint64)


def among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of `keys` are in the sorted array `wanted`."""
    if not len(wanted):
        return np.zeros(len(keys), dtype=bool)
    return wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys
