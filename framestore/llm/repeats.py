"""Repeated passages: every byte that a repeated window of `DEPTH` bytes covers, by a depth-limited radix sort.

All windows of DEPTH bytes (suffixes cut at that depth) are ordered by most-significant-digit passes; those
that are still together after the last digit are equal, and no deeper order is made. To
sort few of them, the digits of a window are taken around an anchor, the gram of
`GRAM` bytes in it with the least hash: equal windows have the same anchor at the same place.

1. First digit, the anchor gram: each part of the input deals its distinct grams; those found once are
   dropped with all their windows. The answer goes back to the parts.
2. For grams that recur the parts deal runs: all bytes of the windows with that anchor, each distinct
   run once, with the smallest document id that has it. Runs that are the same
   throughout need no more digits; the windows of the others are ordered by all their
   bytes, 8 at a time, and groups of one are dropped at each pass. Equal groups are the repeated windows.
   A gram that very many parts have is split by its next digits: its windows are dealt one by one, by all their bytes.
3. The smallest id per run and place goes back to the parts, which remove the bytes.

Hashes only choose what is compared: runs and windows count as equal when all their bytes are.
The rows are kept in a table that is bucketed by part, so texts are read three times but never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from framestore.llm.batches import slices
from framestore.llm.parts import DEALT, among, answers, by_part, deal, dealing, kept_by_part, recurring
from framestore.llm.registry import query, table
from framestore.llm.shingles import _BYTES, _POWERS, mix, span_hashes, text_bytes
from framestore.session import delete_path, own_scratch, stage

DEPTH = 50
#: An anchor gram is one of the SPREAD grams of a window.
GRAM = 28
SPREAD = DEPTH - GRAM + 1
#: A gram that more pieces of the input have is dealt by windows.
HOT = 512
#: Mark of such a window beside the place of the anchor in it.
_ALONE = 128
_PLACE = np.uint64((1 << 21) - 1)
_SEGMENT = 1 << 19
_SLICE = 1 << 19
_LAST = np.iinfo(np.int64).max


def _anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, gram hash) of each run of windows with one anchor.

    `data` holds documents that begin at `at`; no window crosses from one to the next.
    """
    n = len(data) - DEPTH + 1
    if n < 1:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),)
    _POWERS.need(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * _POWERS.up[: len(data)], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * _POWERS.down[: len(data) - GRAM + 1])
    least = grams & ~_PLACE | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= SPREAD:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPREAD:
        least = np.minimum(least[: n], least[SPREAD - width : SPREAD - width + n])
    edge = np.zeros(len(data) + 1, dtype=np.int32)
    inner = at[1:-1]
    np.add.at(edge, np.maximum(inner - DEPTH + 1, 0), 1)
    np.add.at(edge, inner, -1)
    windows = np.flatnonzero(np.cumsum(edge)[:n] == 0)
    anchor = (least[windows] & _PLACE).astype(np.int64)
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    start = np.flatnonzero(new)
    end = np.concatenate([start[1:], [len(windows)]]) - 1 if len(start) else start
    # The least hashes are small numbers, by whose first bits nearly all would be dealt to the first buckets: scrambled again.
    return windows[start], windows[end], anchor[start], mix(grams[anchor[start]])


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """`_anchors` of documents of any length: long ones go in segments that overlap by a window."""
    if len(data) <= 2 * _SEGMENT:
        return _anchors(data, at)
    found = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        for s in range(a, max(a + 1, b - DEPTH + 1), _SEGMENT):
            part = data[s : min(b, s + _SEGMENT + DEPTH - 1)]
            first, last, place, gram = _anchors(part, np.array([0, len(part)]))
            found.append((first + s, last + s, place + s, gram))
    return tuple(np.concatenate(x) for x in zip(*found))


def deal_grams(rows: DataFrame, bits: int) -> DataFrame:
    """The distinct grams of each piece of a partition, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, batch in by_part(batches):
            for piece in slices(batch, "text", _SLICE):
                data, at = text_bytes(piece.column("text"))
                _, _, place, gram = anchors(data, at)
                yield deal(gram, np.searchsorted(at, place, "right"), part, bits)

    return rows.select("part", "text").mapInArrow(run, DEALT)


def _ids(piece) -> np.ndarray:
    """Ids as numbers; a null id is larger than all others."""
    return pc.fill_null(piece.column("id"), _LAST).to_numpy().astype(np.int64)


def _pieces(texts: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in texts.to_batches():
        yield from slices(batch, "text", _SLICE)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, without a copy. `data` has eight bytes more than are asked for."""
    return np.ndarray((len(data) - 7,), dtype=">u8", buffer=data, strides=(1,))


def _padded(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([*parts, np.zeros(8, np.uint8)])


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a:a + size] and data[b:b + size] are equal, pair by pair. Sizes are 8 to 8 * 16."""
    words, same = _words(data), np.ones(len(a), dtype=bool)
    for k in range(0, int(size.max(initial=0)), 8):
        rows = np.flatnonzero(same & (size > k))
        step = np.minimum(k, size[rows].astype(np.int64) - 8)  # the last eight bytes overlap those before
        same[rows] = words[a[rows] + step] == words[b[rows] + step]
    return same


@dataclass
class Runs:
    """Runs of windows with one anchor: bytes start:start + size of `data`, the anchor `left` bytes in.

    `key` is a hash that equal windows of runs share, `content` one of the whole run. `group` numbers the different ones, `one` has a run of each group with the smallest id.
    """

    data: np.ndarray
    ids: np.ndarray
    key: np.ndarray
    content: np.ndarray
    left: np.ndarray
    start: np.ndarray
    size: np.ndarray
    group: np.ndarray | None = None
    one: np.ndarray | None = None

    def compared(self) -> Runs:
        """With `group` and `one`. Only neighbours by hash and id are compared: equal runs may get two numbers, different ones never get one."""
        order = np.lexsort((self.ids, self.content, self.key))
        new = np.ones(len(order), dtype=bool)
        a, b = order[:-1], order[1:]
        met = np.flatnonzero(
            (self.content[a] == self.content[b]) & (self.key[a] == self.key[b]) & (self.size[a] == self.size[b]) & (self.left[a] == self.left[b])
        )
        new[met[same_bytes(self.data, self.start[a[met]], self.start[b[met]], self.size[a[met]])] + 1] = False
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(new) - 1
        return replace(self, group=group, one=order[new])


def _in_order(texts: pa.Table) -> pa.Table:
    """The rows of a part in one order, whatever order they were read in: runs are numbered by it."""
    return texts.sort_by("row").combine_chunks()


def _content(values: np.ndarray, start: np.ndarray, size: np.ndarray, left: np.ndarray) -> np.ndarray:
    """A hash of each run and the place of its anchor; `values` are random numbers of the bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    return mix(span_hashes(values, start, start + size) + mix(left.astype(np.uint64) + np.uint64(1)))


def part_runs(texts: pa.Table, bits: int, wanted: np.ndarray, hot: np.ndarray) -> Runs:
    """The runs of all wanted grams in the texts of a part. Those of the hot ones are cut into windows, each with its own key."""
    datas, found, base = [], [], 0
    for piece in _pieces(texts):
        data, at = text_bytes(piece.column("text"))
        first, last, place, gram = anchors(data, at)
        key = gram >> np.uint64(32 - bits)
        keep = among(key, wanted)
        first, last, place, key = first[keep], last[keep], place[keep], key[keep]
        many = among(key, hot)
        n = last[many] - first[many] + 1
        window = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[many], n)
        left = np.concatenate([(place - first)[~many], (np.repeat(place[many], n) - window) | _ALONE]).astype(np.uint8)
        start = np.concatenate([first[~many], window])
        size = np.concatenate([(last - first)[~many] + DEPTH, np.full(len(window), DEPTH)])
        content = _content(_BYTES[data], start, size, left)
        key = np.concatenate([key[~many], content[len(content) - len(window) :] >> np.uint64(32 - bits)])
        found.append((_ids(piece)[np.searchsorted(at, start, "right") - 1], key, content, left, start + base, size.astype(np.uint8)))
        datas.append(data)
        base += len(data)
    pa.default_memory_pool().release_unused()
    return Runs(_padded(datas), *(np.concatenate(x) for x in zip(*found))).compared()


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places start[0]:start[0] + size[0], start[1]:..., one after the other."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def deal_runs(rows: DataFrame, grams: DataFrame, bits: int) -> DataFrame:
    """(bucket, part, numbers, ids, lefts, sizes, bytes): the different runs of recurring grams in a part, numbered by `part_runs`."""
    names = ["bucket", "part", "numbers", "ids", "lefts", "sizes", "bytes"]
    schema = pa.schema(list(zip(names, [pa.int32(), pa.int64(), *[pa.binary()] * 5])))

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not len(texts) or not len(found):
            return schema.empty_table()
        texts = _in_order(texts)
        runs = part_runs(texts, bits, answers(found), answers(found, "hot"))
        bucket = (runs.key[runs.one] >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        buckets, at = np.unique(bucket[order], return_index=True)
        part, columns = texts.column("part")[0].as_py(), [[] for _ in names[2:]]
        for number in np.split(order, at[1:]):
            one = runs.one[number]
            made = (
                number.astype("<u4"), runs.ids[one].astype("<i8"), runs.left[one], runs.size[one],
                runs.data[_ragged(runs.start[one], runs.size[one].astype(np.int64))],
            )
            for column, values in zip(columns, made):
                column.append(values.tobytes())
        columns = [buckets, [part] * len(buckets), *(columns if len(order) else [[] for _ in columns])]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, schema.types)], schema=schema)

    left, right = rows.select("part", "row", "id", "text").groupBy("part"), grams.groupBy("part")
    return left.cogroup(right).applyInArrow(
        run, "bucket int, part bigint, numbers binary, ids binary, lefts binary, sizes binary, bytes binary"
    )


def radix_groups(n: int, digits: list) -> tuple[np.ndarray, np.ndarray]:
    """(rows, group): those of `n` rows that agree with another one in all digits, and the number of their group.

    Each of `digits` gives the digit of some rows. Most significant digit first; rows that are alone after a digit take part in no later pass.
    """
    rows = np.arange(n)
    group = np.zeros(n, dtype=np.int64)
    for digit in digits:
        value = digit(rows)
        order = np.lexsort((value, group))
        rows, group, value = rows[order], group[order], value[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
        group = np.cumsum(new) - 1
        several = np.bincount(group, minlength=len(rows))[group] > 1
        rows, group = rows[several], group[several]
    return rows, group


def _window_minima(runs: Runs, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in `entries`, place in its run of windows, smallest id) for windows that another one of these runs has as well."""
    n = runs.size[entries] - DEPTH + 1
    entry = np.repeat(np.arange(len(entries)), n)
    step = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
    where, words = runs.start[entries][entry] + step, _words(runs.data)
    digits = [lambda rows, k=k: words[where[rows] + k].astype(np.uint64) for k in (*range(0, DEPTH - 8, 8), DEPTH - 8)]
    rows, group = radix_groups(len(entry), [lambda rows: runs.key[entries[entry[rows]]], *digits])
    if not len(rows):
        return entry[:0], step[:0], runs.ids[:0]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.repeat(np.minimum.reduceat(runs.ids[entries[entry[rows]]], starts), np.diff([*starts, len(rows)]))
    return entry[rows], step[rows], least


def run_hashes(left: np.ndarray, size: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, content) of runs that lie one after the other in `data`, some at a time."""
    keys, contents, ends = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], np.cumsum(size, dtype=np.int64)
    for a in range(0, len(size), 1 << 14):
        stop = ends[a : a + (1 << 14)]
        first = int(stop[0]) - int(size[a])
        some, start = size[a : a + (1 << 14)].astype(np.int64), stop - first - size[a : a + (1 << 14)]
        place, values = left[a : a + (1 << 14)], _BYTES[data[first : int(stop[-1])]]
        content, alone = _content(values, start, some, place), place >= _ALONE
        gram = start + np.where(alone, 0, place)
        keys.append(np.where(alone, content, span_hashes(values, gram, gram + GRAM)))
        contents.append(content)
    return np.concatenate(keys), np.concatenate(contents)


_WINDOWS_AT_ONCE = 1 << 18


def first_holders(dealt: DataFrame) -> DataFrame:
    """(part, numbers, lo, hi, ids): for windows lo to hi of a run, the smallest id that has them elsewhere, if it is less than that of the run."""

    def resolve(pieces: list) -> Iterator[pa.RecordBatch]:
        part = np.repeat(np.array([p[0] for p in pieces]), [len(p[1]) for p in pieces])
        number, ids, left, size = (np.concatenate([p[i] for p in pieces]) for i in range(1, 5))
        hashes = [run_hashes(*p[3:]) for p in pieces]
        key, content = (np.concatenate(x) for x in zip(*hashes))
        data, size = _padded([p[5] for p in pieces]), size.astype(np.int64)
        start = np.cumsum(size) - size
        runs = Runs(data, ids, key, content, left, start, size).compared()
        of, one = runs.group, runs.one
        base = ids[one]
        # A part knows the ids that it has itself.
        less = np.flatnonzero(base[of] < ids)
        found: list[tuple] = [(less, np.zeros(len(less), np.int64), size[less] - DEPTH, base[of[less]])]
        # Keys with several runs: window by window, whole keys at a time.
        k = key[one]
        _, inverse, n = np.unique(k, return_inverse=True, return_counts=True)
        several = np.flatnonzero(n[inverse] > 1)
        cuts, at = [0], 0
        total = np.cumsum(size[one[several]] - DEPTH + 1)
        while at < len(several):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _WINDOWS_AT_ONCE, "right")))
            while stop < len(several) and k[several[stop]] == k[several[stop - 1]]:
                stop += 1
            cuts.append(stop)
            at = stop
        made = []
        for a, b in zip(cuts, cuts[1:]):
            entry, step, least = _window_minima(runs, one[several[a:b]])
            low = least < base[several[a:b]][entry]
            entry, step, least = several[a:b][entry[low]], step[low], least[low]
            order = np.lexsort((step, entry))
            entry, step, least = entry[order], step[order], least[order]
            new = np.ones(len(entry), dtype=bool)
            new[1:] = (entry[1:] != entry[:-1]) | (step[1:] != step[:-1] + 1) | (least[1:] != least[:-1])
            s = np.flatnonzero(new)
            last = np.concatenate([s[1:], [len(entry)]]) - 1 if len(s) else s
            made.append((entry[s], step[s], step[last], least[s]))
        if made:
            group, lo, hi, least = (np.concatenate(x) for x in zip(*made))
            order = np.argsort(group, kind="stable")
            group, lo, hi, least = group[order], lo[order], hi[order], least[order]
            a, b = np.searchsorted(group, of, "left"), np.searchsorted(group, of, "right")
            entry = np.repeat(np.arange(len(of)), b - a)
            pick = _ragged(a, b - a)
            found.append((entry, lo[pick], hi[pick], least[pick]))
        entry, lo, hi, least = (np.concatenate(x) for x in zip(*found))
        if not len(entry):
            return
        order = np.argsort(part[entry], kind="stable")
        entry, lo, hi, least = entry[order], lo[order], hi[order], least[order]
        parts, at = np.unique(part[entry], return_index=True)
        columns = [number[entry].astype("<u4"), lo.astype(np.uint8), hi.astype(np.uint8), least.astype("<i8")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int64()), *[pa.array([x.tobytes() for x in np.split(c, at[1:])], pa.binary()) for c in columns]],
            ["part", "numbers", "lo", "hi", "ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        kinds = ("<u4", "<i8", np.uint8, np.uint8, np.uint8)
        for batch in batches:
            for bucket, part, *columns in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, []).append((part, *(np.frombuffer(c, k) for c, k in zip(columns, kinds))))
        for bucket in list(held):
            yield from resolve(held.pop(bucket))
            pa.default_memory_pool().release_unused()

    return dealt.mapInArrow(run, "part bigint, numbers binary, lo binary, hi binary, ids binary")


def remove_held(rows: DataFrame, grams: DataFrame, holders: DataFrame, bits: int) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept) of every row."""
    out = pa.schema(
        [("row", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
    )

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not len(texts):
            return out.empty_table()
        texts = _in_order(texts)
        kinds = {"numbers": "<u4", "lo": np.uint8, "hi": np.uint8, "ids": "<i8"}
        known, lo, hi, least = (np.frombuffer(b"".join([x for x in found.column(c).to_pylist() if x]), k) for c, k in kinds.items())
        order = np.argsort(known, kind="stable")
        known, lo, hi, least = known[order], lo[order].astype(np.int64), hi[order].astype(np.int64), least[order]
        # The numbers are those of the runs that were dealt: they come from the same rows and grams.
        runs = part_runs(texts, bits, answers(found), answers(found, "hot"))
        a, b = np.searchsorted(known, runs.group, "left"), np.searchsorted(known, runs.group, "right")
        run_of, pick = np.repeat(np.arange(len(a)), b - a), _ragged(a, b - a)
        held = least[pick] < runs.ids[run_of]
        run_of, pick = run_of[held], pick[held]
        edge = np.zeros(len(runs.data) + 1, dtype=np.int32)
        np.add.at(edge, runs.start[run_of] + lo[pick], 1)
        np.add.at(edge, runs.start[run_of] + hi[pick] + DEPTH, -1)
        again = np.flatnonzero(runs.ids[runs.one][runs.group] < runs.ids)
        np.add.at(edge, runs.start[again], 1)
        np.add.at(edge, runs.start[again] + runs.size[again], -1)
        covered = np.cumsum(edge, dtype=np.int32) > 0
        tables, base = [], 0
        for piece in _pieces(texts):
            data, at = text_bytes(piece.column("text"))
            gone = covered[base : base + len(data)]
            base += len(data)
            before = np.concatenate([[0], np.cumsum(gone)])
            begins = gone & np.concatenate([[True], ~gone[:-1]])
            begins[at[:-1][at[:-1] < len(gone)]] |= gone[at[:-1][at[:-1] < len(gone)]]
            spans = np.concatenate([[0], np.cumsum(begins)])
            left = data[~gone].tobytes()
            kept_at = (at - before[at]).tolist()
            tables.append(pa.Table.from_arrays(
                [
                    piece.column("row"), pa.array(np.diff(at), pa.int64()), pa.array(np.diff(before[at]), pa.int64()),
                    pa.array(np.diff(spans[at]), pa.int64()), pa.array([left[x:y] for x, y in zip(kept_at, kept_at[1:])], pa.binary()),
                ],
                schema=out,
            ))
        return pa.concat_tables(tables)

    answered = grams.unionByName(holders, allowMissingColumns=True)
    left, right = rows.select("part", "row", "id", "text").groupBy("part"), answered.groupBy("part")
    return left.cogroup(right).applyInArrow(run, "row bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `n_bytes`, `n_removed`, `n_spans` (maximal removed runs) and `kept` (the bytes left).

    A byte goes if a string of 50 bytes that covers it also begins in a document with
    a smaller id; matches are those of the input and never cross documents. The id
    is an integer; a null id is larger than all others, rows with one id do not take from each
    other. Null and empty texts have no bytes. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    n, bits = dealing(spark)
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    with kept_by_part(texts, F.octet_length("text")) as (rows, _):
        grams, grams_path = stage(recurring(deal_grams(rows, bits).repartition(n, "bucket"), HOT), "grams")
        dealt = deal_runs(rows, grams, bits).repartition(n, "bucket")
        holders, holders_path = stage(first_holders(dealt), "holders")
        kept, kept_path = stage(remove_held(rows, grams, holders, bits), "kept")
        ids, ids_path = stage(rows.select("row", "id"), "ids")
    for path in (grams_path, holders_path):
        delete_path(spark, path)
    for path in (kept_path, ids_path):
        own_scratch(spark, path)
    return ids.join(kept, "row").select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")


#: Windows as hex digits, cut from blocks of 500 windows; the removed bytes are the union of repeated windows, as islands.
_SQL = f"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (
    SELECT doc_id, b, substr(h, 2 * b + 1, {2 * (500 + DEPTH - 1)}) AS h
    FROM (SELECT doc_id, h, unnest(range(0, CAST(len(h) // 2 AS BIGINT), 500)) AS b FROM docs)
),
windows AS (
    SELECT doc_id, b + i AS pos, h[2 * i + 1 : 2 * i + {2 * DEPTH}] AS w
    FROM (SELECT doc_id, b, h, unnest(range(0, least(500, CAST(len(h) // 2 AS BIGINT) - {DEPTH - 1}))) AS i FROM blocks)
),
firsts AS (SELECT w, min(doc_id) AS lo FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, pos FROM windows JOIN firsts USING (w) WHERE lo < doc_id),
edges AS (SELECT doc_id, pos, CASE WHEN pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + {DEPTH} THEN 1 ELSE 0 END AS new FROM gone),
numbered AS (SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM edges),
islands AS (SELECT doc_id, k, min(pos) AS a, max(pos) + {DEPTH} AS b FROM numbered GROUP BY ALL),
gaps AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM islands
    UNION ALL SELECT doc_id, max(b), NULL FROM islands GROUP BY doc_id
),
kept AS (
    SELECT doc_id, string_agg(CASE WHEN gaps.b IS NULL THEN substr(h, CAST(2 * a + 1 AS BIGINT)) ELSE substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (gaps.b - a) AS BIGINT)) END, '' ORDER BY a) AS h
    FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
),
counts AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM islands GROUP BY doc_id)
SELECT doc_id, CAST(len(docs.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, docs.h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""


@query(_SQL)
def op10_repeats(spark, sf_dir):
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
