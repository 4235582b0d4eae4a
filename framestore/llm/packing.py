"""Best-fit packing by minimum bin slack.

For each sequence a bitset of reachable sums over the lengths that are left finds the
fullest feasible combination, which is then removed. The lengths
of all pieces are at most `capacity` different numbers, so the packing is planned on
their counts: a combination is taken as often as the counts allow. Spark
does the rest: it cuts and encodes the documents, counts the lengths, ranks the pieces
of each length in parallel, and joins them to the plan by rank.

What comes to the driver is one count per length, at most `capacity` rows; the plan
has a few rows per length and use, bounded by `capacity` as well, whatever the input.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from framestore.llm.batches import id_and_text, id_type, slices
from framestore.llm.registry import query, table
from framestore.llm.vocabulary import WordIds, byte_of_symbol
from framestore.session import stage

CAPACITY = 2048
END = 0


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Of the words that a Python worker remembers. More of them save no time (72 s of CPU on files of 0.13 GB, 79 with three times as many).
CACHE_BYTES = 32 << 20

#: Latin words: what NFC leaves as it is, and lower-casing changes letter by letter.
_LATIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: The words that the tokenizer cuts lower-case Latin text into, and the line ends that keep the given words apart.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+")
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SUFFIX = "</w>"


def ranked_words(file: dict) -> Callable[[list[str]], list[bytes | None]] | None:
    """Ids of Latin words by ranked merges, for a BPE with word ends whose ids are in the order of its merges; None for another tokenizer.

    A line end stands for the end of a word: its merges with single letters come before all others, as
    the tokenizer begins with letters that carry the word end. A line end by itself keeps the given words apart.
    """
    model, before = file["model"], file.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers") or [{}]
    cut = (steps[0].get("pattern") or {}).get("Regex") == _PATTERN and steps[0].get("invert") and len(steps) == 2 and not steps[1].get("use_regex")
    lower = [n["type"] for n in (file.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    if model["type"] != "BPE" or model.get("end_of_word_suffix") != _SUFFIX or not cut or not lower or model.get("dropout"):
        return None
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if [model["vocab"][m] for m in merged] != list(range(512, 512 + len(merged))):
        return None
    special, byte_of, ranks = {t["id"] for t in file["added_tokens"]}, byte_of_symbol(), {}
    for token, n in model["vocab"].items():
        if n not in special:
            ends = token.endswith(_SUFFIX)
            ranks[bytes(byte_of[c] for c in token.removesuffix(_SUFFIX)) + b"\n" * ends] = n
    import tiktoken

    encoding = tiktoken.Encoding("words", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})
    mark = ranks[b"\n"]

    def ids(words: list[str]) -> list[bytes | None]:
        out: list[bytes | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if _LATIN.fullmatch(w) and "<|" not in w]
        for a in range(0, len(plain), 2000):
            some = plain[a : a + 2000]
            text = _PARTS.sub("\\g<0>\n", "\n".join([words[i] for i in some]).lower()) + "\n"
            flat = np.array(encoding.encode_ordinary(text), dtype="<u4")
            raw, start = flat.tobytes(), 0
            for i, cut in zip(some, np.flatnonzero(flat == mark).tolist(), strict=True):
                out[i] = raw[4 * start : 4 * cut]
                start = cut + 1
        return out

    return ids


_READY: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of `path` in this Python worker, with its words learned so far."""
    if path not in _READY:
        from tokenizers import Tokenizer

        # A worker that earlier stages used still holds the memory of their batches.
        pa.default_memory_pool().release_unused()
        tokenizer = Tokenizer.from_file(path)

        def encode(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        with open(path, encoding="utf-8") as f:
            fast = ranked_words(json.load(f))
        # A NUL by itself is a word of its own and has one id.
        _READY[path] = WordIds(encode, " \0 ", "\0", fast=fast, cache_bytes=CACHE_BYTES)
    return _READY[path]


def text_ids(words: WordIds, texts: list[str]) -> list[bytes]:
    """Ids of each text; white space separates words and has no ids."""
    split = [t.encode().split() for t in texts]
    words.learn((w for s in split for w in s), bytes.decode)
    known = words.known
    return [b"".join([known[w] for w in s]) for s in split]


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The longest length left, with the combination of others that leaves the least slack."""
    longest = max(counts)
    room = capacity - longest
    mask, reach, steps = (2 << room) - 1, 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        most = min(counts[length] - (length == longest), room // length)
        steps.append((length, most, reach))
        take = 1
        while most > 0:  # 1, 2, 4, ... copies make every number of copies up to `most`
            n = min(take, most)
            reach |= reach << (n * length) & mask
            most -= n
            take *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {longest: 1}
    for length, most, before in reversed(steps):
        for n in range(most + 1):
            if total >= n * length and before >> (total - n * length) & 1:
                if n:
                    chosen[length] = chosen.get(length, 0) + n
                total -= n * length
                break
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies per sequence, first sequence, offset) of all pieces."""
    left, used, sequence, plan = dict(counts), dict.fromkeys(counts, 0), 0, []
    while left:
        chosen = fullest(left, capacity)
        times = min(left[length] // n for length, n in chosen.items())
        offset = 0
        for length, n in chosen.items():
            plan.append((length, used[length], used[length] + n * times, n, sequence, offset))
            offset += n * length
            used[length] += n * times
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequence += times
    return plan


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int, end: int = END) -> DataFrame:
    """The pieces of every document: `row`, `id`, `piece`, `start`, `length`, `ids` (unsigned 32-bit, little-endian)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tail, step = word_ids(path), np.array([end], dtype="<u4").tobytes(), 4 * capacity
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = [x + tail for x in text_ids(words, part.column("text").to_pylist())]
                of = np.repeat(np.arange(len(ids)), [-(-len(x) // step) for x in ids])
                cuts = [(k, x[a : a + step]) for x in ids for k, a in enumerate(range(0, len(x), step))]
                number = np.array([k for k, _ in cuts], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row").take(pa.array(of)),
                        part.column("id").take(pa.array(of)),
                        pa.array(number),
                        pa.array(number.astype(np.int64) * capacity),
                        pa.array([len(x) // 4 for _, x in cuts], pa.int64()),
                        pa.array([zlib.crc32(x) for _, x in cuts], pa.int64()),
                        pa.array([x for _, x in cuts], pa.binary()),
                    ],
                    ["row", "id", "piece", "start", "length", "crc", "ids"],
                )

    schema = f"row bigint, id {id_type(docs, id_col)}, piece int, start bigint, length bigint, crc bigint, ids binary"
    return id_and_text(docs, id_col, text_col).mapInArrow(cut, schema)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset` and (`with_ids`) `ids`.

    A document is its ids and an end id. Longer ones than `capacity` are cut into
    full pieces and a rest. Null and empty texts are one end id; repeated rows are
    packed one by one; an empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    found = pieces(docs, id_col, text_col, path or vocabulary_file("word_bpe_49k.json"), capacity)
    rows, _ = stage(found if with_ids else found.drop("ids"), "pieces")
    rows = rows.withColumn("part", F.shiftright("row", 33).cast("int"))
    parts = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    names = ["length_", "first", "stop", "copies", "sequence", "at"]
    planned = np.array(plan_bins(counts, capacity), dtype=np.int64).reshape(-1, len(names))
    # An Arrow table needs no Python worker to be read; a list of rows needs a second kind of them on the executors.
    plan = F.broadcast(spark.createDataFrame(pa.table(list(planned.T), names=names)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy("row", "piece")) - 1
    ranked = rows.withColumn("rank", rank).join(before, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    within = (F.col("length") == F.col("length_")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop"))
    place = F.col("rank") - F.col("first")
    return ranked.join(plan, within).select(
        F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
        (F.col("sequence") + F.floor(place / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("at") + place % F.col("copies") * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )


@query()
def op6_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
