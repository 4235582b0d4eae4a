"""Row positions and consecutive chunks of n rows."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from framestore.errors import InvalidInputError
from framestore.session import delete_path, own_scratch, stage
from framestore.validation import as_list, check_chunksize, check_columns

POSITION = "__position"
_LOCAL = "__local"
# monotonically_increasing_id keeps the partition number above 33 bits for the place in it.
_PLACES = 1 << 33


def _with_local_ids(df: DataFrame, order_by: Sequence[str], partitions: int) -> DataFrame:
    """Range partition by the order, so that partition number and place give the position.

    The random last key lets many equal order values spread over partitions.
    """
    if order_by:
        keys = [F.col(f"`{c}`") for c in order_by]
        df = df.repartitionByRange(partitions, *keys, F.rand(7)).sortWithinPartitions(*keys)
    return df.withColumn(_LOCAL, F.monotonically_increasing_id())


@dataclass
class Positioned:
    """Rows with a global position, kept in a staged table at `path`.

    `before[i]` is the number of rows in the partitions before the i-th one of
    `partitions`. Local ids grow with the position.
    """

    staged: DataFrame
    path: str
    partitions: list[int]
    before: list[int]
    n_rows: int

    @property
    def df(self) -> DataFrame:
        """All rows, with their position in column `POSITION`."""
        place = F.col(_LOCAL).bitwiseAND(F.lit(_PLACES - 1))
        starts = dict(zip(self.partitions, self.before))
        offsets = ",".join(str(starts.get(p, 0)) for p in range(max(starts, default=0) + 1))
        # One literal with a number per partition, made from text so that it is one node of the plan.
        before = F.get(F.split(F.lit(offsets), ",").cast("array<bigint>"), _partition_number())
        return self.staged.withColumn(POSITION, before + place).drop(_LOCAL)

    def _local_id(self, position: int) -> int:
        i = bisect_right(self.before, position) - 1
        return self.partitions[i] * _PLACES + position - self.before[i]

    def rows(self, start: int, stop: int) -> DataFrame:
        """The rows at positions `start` up to but without `stop`, in order.

        The positions are a range of local ids, which is pushed down to the scan.
        """
        stop = min(stop, self.n_rows)
        inside = F.col(_LOCAL).between(self._local_id(start), self._local_id(stop - 1))
        return self.staged.where(inside).orderBy(_LOCAL).drop(_LOCAL)

    def delete(self) -> None:
        delete_path(self.staged.sparkSession, self.path)


def _partition_number():
    return F.shiftright(F.col(_LOCAL), 33).cast("int")


def with_positions(
    df: DataFrame, order_by: str | Sequence[str] | None = None, num_partitions: int | None = None
) -> Positioned:
    """Number all rows 0, 1, 2, ... in the order of `order_by` (any order if None).

    The rows are range partitioned and sorted in parallel and written once to the
    shared folder; then the rows per partition are counted, and each row adds its
    place in the partition to the count of the partitions before it. Only those
    counts, one per partition, come to the driver. No window over the whole
    frame, and the written table makes the numbers stable when executors are lost.
    """
    spark = df.sparkSession
    order = check_columns(as_list(order_by), df.columns)
    partitions = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged, path = stage(_with_local_ids(df, order, partitions), "positions")
    counted = staged.groupBy(_partition_number().alias("p")).agg(F.count("*").alias("n"))
    counts = sorted((r["p"], r["n"]) for r in counted.collect())
    sizes = [n for _, n in counts]
    before = [0, *accumulate(sizes)][: len(sizes)]
    return Positioned(staged, path, [p for p, _ in counts], before, sum(sizes))


def chunk_ids(
    df: DataFrame, chunksize: int | None, order_by: str | Sequence[str] | None = None, name: str = "chunk_id"
) -> DataFrame:
    """Add the number of the block of `chunksize` consecutive rows (0 if None)."""
    if name in df.columns:
        raise InvalidInputError(f"The DataFrame already has a column {name}", data=name)
    if check_chunksize(chunksize) is None:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    positioned = with_positions(df, order_by)
    own_scratch(df.sparkSession, positioned.path)
    numbered = positioned.df
    return numbered.withColumn(name, F.floor(F.col(POSITION) / F.lit(chunksize)).cast("bigint")).drop(POSITION)


def iter_chunks(
    df: DataFrame, chunksize: int, order_by: str | Sequence[str] | None = None
) -> Iterator[DataFrame]:
    """Yield DataFrames of `chunksize` consecutive rows; the last one may be shorter.

    An empty frame yields itself once. Each chunk filters the staged table, which
    is sorted by position, on a range: Parquet statistics skip the other row groups.
    Chunks can be kept and read later; `framestore.session.delete_scratch` deletes the staged table.
    """
    check_chunksize(chunksize)
    positioned = with_positions(df, order_by)
    own_scratch(df.sparkSession, positioned.path)
    if positioned.n_rows == 0:
        yield df
    for start in range(0, positioned.n_rows, chunksize):
        yield positioned.rows(start, start + chunksize)
