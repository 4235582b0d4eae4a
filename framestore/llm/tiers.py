"""Hierarchical packing into sequences of several lengths.

A document longer than the largest tier fills windows of that length by itself; its rest, like any shorter document, is routed
to the smallest tier that holds it. Each tier is packed, the largest first: a window begins with a rest of the tier, and its gap is
filled with the longest whole rests that fit, from the shorter tiers. Where none fits, the longest rest of the shorter
tiers is cut and its remainder goes back among the rests. So windows are full; what is left at the end, less than a
window, goes into windows of powers of two. Sequences are dealt to step groups, the longest first, so that groups hold equally many of
each tier, but for one, and their tokens differ by at most one sequence.

Rests have fewer different lengths than the largest tier, so the packing is planned on their counts. The
counts, one per length, are all that comes to the driver. Each step of the plan ends a set of windows or uses up or shortens a run of equal
rests, so the plan is bounded by the square of the largest tier, whatever the input; it has some thousand rows.
Spark does the rest: tasks encode the documents and number their rests by length, joins place them.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from framestore.errors import InvalidInputError
from framestore.llm.batches import id_and_text, id_type, slices
from framestore.llm.packing import vocabulary_file
from framestore.llm.registry import query, table
from framestore.llm.vocabulary import byte_of_symbol
from framestore.session import delete_path, own_scratch, stage

TIERS = (1024, 512, 256, 128)
END = 0
#: Tokens of a training step.
STEP_TOKENS = 1 << 19

#: The words that byte-level BPE cuts a text into before merges.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def merge_ranks(file: dict) -> dict[bytes, int] | None:
    """Ids by bytes of a byte-level BPE whose ids are in the order of its merges, or None for another tokenizer."""
    model, before = file["model"], file.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    extras = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
    if not plain or any(extras) or file.get("normalizer") or any(not t["special"] or t["normalized"] for t in file["added_tokens"]):
        return None
    special, vocab = {t["id"] for t in file["added_tokens"]}, model["vocab"]
    byte_of = byte_of_symbol()
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if [vocab[m] for m in merged] != list(range(256, 256 + len(merged))):
        return None
    return {bytes(byte_of[c] for c in token): n for token, n in vocab.items() if n not in special}


@lru_cache(maxsize=4)
def encoder(path: str) -> tuple[Callable[[str], list[int]], int]:
    """(ids of a text, number of ids) of the tokenizer file: the ids are those of the tokenizers library without added special tokens.

    Ranked merges are much faster; the library itself does what they cannot: other kinds of files, and texts
    whose blanks are too long a run for their word pattern.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    tokenizer = Tokenizer.from_file(path)
    size = max([*tokenizer.get_vocab(with_added_tokens=True).values()], default=0) + 1

    def plain(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    ranks = merge_ranks(file)
    if ranks is None:
        return plain, size
    import tiktoken

    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    fast = tiktoken.Encoding("file", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens=special)

    def ids(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:
            return plain(text)

    return ids, size


def encoded(docs: DataFrame, id_col: str, text_col: str, path: str, largest: int, end: int) -> DataFrame:
    """One row per document: `row`, `id`, `n` (ids, with the end), `full` windows and `rest`, their numbers in the task, and `ids` (2 or 4 bytes each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, size = encoder(path)
        kind = "<u2" if max(size, end + 1) <= 1 << 16 else "<u4"
        # How many windows, and rests of each length, this task has had.
        windows, rests = 0, np.zeros(largest, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                found = [np.array([*ids_of(t), end], dtype=kind) for t in part.column("text").to_pylist()]
                n = np.array([len(x) for x in found], dtype=np.int64)
                full, rest = np.divmod(n, largest)
                full_at = windows + np.cumsum(full) - full
                order = np.argsort(rest, kind="stable")
                values, first, count = np.unique(rest[order], return_index=True, return_counts=True)
                rest_at = np.empty(len(n), dtype=np.int64)
                rest_at[order] = np.arange(len(n)) - np.repeat(first, count) + np.repeat(rests[values], count)
                windows += int(full.sum())
                rests[values] += count
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("id"), *[pa.array(x) for x in (n, full, full_at, rest, rest_at)],
                        pa.array([x.tobytes() for x in found], pa.binary()),
                    ],
                    ["row", "id", "n", "full", "full_at", "rest", "rest_at", "ids"],
                )

    numbers = ", ".join(f"{c} bigint" for c in ("n", "full", "full_at", "rest", "rest_at"))
    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"row bigint, id {id_type(docs, id_col)}, {numbers}, ids binary")


class Rests:
    """Runs of equal rests by length. A run is (length before any cut, first number, end number, start behind earlier cuts)."""

    def __init__(self, counts: dict[int, int]):
        self.runs = {n: [(n, 0, c, 0)] for n, c in counts.items() if c}
        self.lengths = sum(1 << n for n in self.runs)
        self.tokens = sum(n * c for n, c in counts.items())

    def longest(self, most: int) -> int:
        """The longest length of at most `most`, 0 if there is none."""
        return max(0, (self.lengths & ((2 << most) - 1)).bit_length() - 1)

    def size(self, length: int) -> int:
        _, first, stop, _ = self.runs[length][-1]
        return stop - first

    def take(self, length: int, n: int) -> tuple[int, int, int, int]:
        """`n` of the rests of the run that `size` counts."""
        origin, first, stop, start = self.runs[length].pop()
        if first + n < stop:
            self.runs[length].append((origin, first + n, stop, start))
        elif not self.runs[length]:
            del self.runs[length]
            self.lengths ^= 1 << length
        self.tokens -= n * length
        return origin, first, first + n, start

    def give(self, length: int, run: tuple[int, int, int, int]) -> None:
        self.runs.setdefault(length, []).append(run)
        self.lengths |= 1 << length
        self.tokens += length * (run[2] - run[1])


#: length of the rest, numbers from, to; start in the rest, length of the piece, pieces per window; first sequence, offset there, tier.
PLAN = "length_ bigint, first bigint, stop bigint, cut bigint, size bigint, copies bigint, sequence bigint, at bigint, tier bigint"


def plan_tiers(counts: dict[int, int], tiers: tuple[int, ...] = TIERS, sequence: int = 0) -> tuple[list[tuple], int]:
    """(rows as in `PLAN`, the number after the last sequence) for the rests of these lengths. `tiers` go down."""
    rests, plan = Rests(counts), []

    def place(length: int, n: int, size: int, copies: int, sequence: int, at: int, tier: int) -> None:
        """`n` rests of `length`, whole or their first `size` tokens."""
        origin, first, stop, start = rests.take(length, n)
        plan.append((origin, first, stop, start, size, copies, sequence, at, tier))
        if size < length:
            rests.give(length - size, (origin, first, stop, start + size))

    def fill(n: int, sequence: int, at: int, tier: int, below: int) -> None:
        open_ = [(n, sequence, at)]
        while open_:
            n, sequence, at = open_.pop()
            gap = tier - at
            if not gap:
                continue
            size = rests.longest(gap)
            if size and rests.size(size) >= n:
                copies = min(rests.size(size) // n, gap // size)
                place(size, n * copies, size, copies, sequence, at, tier)
                open_.append((n, sequence, at + copies * size))
                continue
            length = size or rests.longest(below) or rests.longest(tiers[0])
            some = min(n, rests.size(length))
            place(length, some, min(length, gap), 1, sequence, at, tier)
            open_ += [(some, sequence, at + min(length, gap))] + ([(n - some, sequence + some, at)] if some < n else [])

    for tier, below in zip(tiers, [*tiers[1:], 0]):
        while (length := rests.longest(tier)) > below:
            n = min(rests.size(length), rests.tokens // tier)
            if not n:
                break
            place(length, n, length, 1, sequence, 0, tier)
            fill(n, sequence, length, tier, below)
            sequence += n
    while rests.tokens:
        tier = 1 << (min(rests.tokens, tiers[0]).bit_length() - 1)
        fill(1, sequence, 0, tier, tier)
        sequence += 1
    return plan, sequence


def pack_tiers(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS, with_ids: bool = True, end: int = END,
) -> DataFrame:
    """One row per piece: id, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`, `tier`, `step_group` and (`with_ids`) `ids`.

    A document is its ids and an end id. `tiers` are powers of two, the largest first. Every sequence is full: its length is
    `tier`, a power of two, which is smaller than the smallest tier only for a few sequences at the end. Null and empty
    texts are one end id; documents with equal ids or texts are packed one by one, in the order of the rows; an
    empty table gives no rows. Other columns are ignored.
    """
    tiers = tuple(sorted(tiers, reverse=True))
    if not tiers or any(t < 1 or t & (t - 1) for t in tiers):
        raise InvalidInputError("Tiers are powers of two", data=tiers)
    spark, largest = docs.sparkSession, tiers[0]
    found = encoded(docs, id_col, text_col, path or vocabulary_file("byte_bpe_50k.json"), largest, end)
    rows, rows_path = stage(found, "tokens")
    own_scratch(spark, rows_path)
    part = F.shiftright("row", 33).cast("int").alias("part")
    windows = F.struct(F.lit(largest).cast("bigint").alias("length"), F.col("full").alias("copies"), F.col("full_at").alias("number"))
    rest = F.struct(F.col("rest").alias("length"), F.lit(1).cast("bigint").alias("copies"), F.col("rest_at").alias("number"))
    items = rows.select("row", part, "n", "full", F.explode(F.array(windows, rest)).alias("item")).select("row", "part", "n", "full", "item.*")
    items = items.where("copies > 0 AND length > 0")
    parts = items.groupBy("length", "part").agg(F.sum("copies").alias("n"))
    # One row per length.
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    n_full = counts.pop(largest, 0)
    plan, n_sequences = plan_tiers(counts, tiers, n_full)
    plan.append((largest, 0, n_full, 0, largest, 1, 0, 0, largest))
    tokens = n_full * largest + sum(n * c for n, c in counts.items())
    groups = max(1, -(-tokens // step_tokens))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    each = items.join(before, ["length", "part"]).select(
        "row", "length", (F.col("full") * largest).alias("behind"), F.explode(F.expr("sequence(0L, copies - 1)")).alias("k"),
        (F.col("number") + F.col("before") + F.col("k")).alias("number"),
    )
    steps = F.broadcast(spark.createDataFrame(plan, PLAN))
    within = (F.col("length") == F.col("length_")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("stop"))
    place = F.col("number") - F.col("first")
    start = F.when(F.col("length") == largest, F.col("k") * largest).otherwise(F.col("behind") + F.col("cut"))
    pieces = each.join(steps, within).select("row", F.struct(
        start.alias("start"), F.col("size").alias("length"),
        (F.col("sequence") + F.floor(place / F.col("copies"))).cast("bigint").alias("sequence"),
        (F.col("at") + place % F.col("copies") * F.col("size")).alias("offset"), "tier",
    ).alias("piece"))
    # A list is never longer than its document.
    lists = pieces.groupBy("row").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    kinds = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids", 1 << 20):
                lists, flat = part.column("pieces"), part.column("pieces").flatten()
                of = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy())
                start, length, sequence, offset, tier = (flat.field(c).to_numpy() for c in ("start", "length", "sequence", "offset", "tier"))
                n = part.column("n").to_numpy()
                ids = [
                    np.frombuffer(raw, "<u2" if len(raw) == 2 * k else "<u4").astype("<u4") for raw, k in zip(part.column("ids").to_pylist(), n.tolist())
                ]
                raw = [ids[i][a : a + k].tobytes() for i, a, k in zip(of.tolist(), start.tolist(), length.tolist())]
                crc = np.array([zlib.crc32(x) for x in raw], dtype=np.int64)
                columns = [start, length, crc, n[of], sequence, offset, tier, sequence % groups]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(of)), *map(pa.array, columns), *([pa.array(raw, pa.binary())] if with_ids else [])],
                    ["id", *kinds, *(["ids"] if with_ids else [])],
                )

    schema = f"id {id_type(docs, id_col)}, {', '.join(f'{c} bigint' for c in kinds)}{', ids binary' if with_ids else ''}"
    joined = rows.select("row", "id", "n", "ids").join(lists, "row").select("id", "n", "ids", "pieces")
    return joined.mapInArrow(cut, schema).withColumnRenamed("id", id_col)


@query()
def op13_tiers(spark, sf_dir):
    return pack_tiers(table(spark, sf_dir, "documents"), with_ids=False)
