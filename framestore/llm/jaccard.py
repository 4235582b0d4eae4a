"""Similarity join of shingle sets, size-aware: subsets of small sets, inverted lists of large ones.

Texts with equal sets are one class. Two sets with a Jaccard similarity of the threshold or more share
a known least number of shingles, so they agree on one shingle of their first p and on
a pair of shingles of their first p + 1, whatever common order the shingles have. The order
puts frequent shingles last: those first ones are rare.

* Small sets enumerate the pairs (subsets of size 2) of their first p + 1 shingles; two small sets meet under a common pair.
* Large sets are scanned against the inverted lists of the first p shingles of all sets that are large enough.
* The boundary is where the two costs, taken over the sizes of all sets, add up to the least.

Links are found in two steps, so that a group of near copies does not become all of its pairs.
First each list links its members to one of them, its pivot; verified links give components.
Then members of *different* components that a list still holds, and that could be
similar by size and place, are compared pair by pair. So no link between components is lost.
Pairs first meet with a bit per shingle (`marks`), which tells most that differ in too many; whole sets
move only for the others, since each pair takes a copy of a set with it.

Similarity is exact up to 64-bit hashes of shingles. The frequency of a shingle only
decides the order: any order gives the same links. The most frequent shingles are
broadcast for it, at most `HEAVY` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from framestore.llm.batches import id_and_text, id_type, slices
from framestore.llm.components import components
from framestore.llm.parts import DEALT, among, answers, by_part, deal, dealing, kept_by_part
from framestore.llm.parts import low_bits, recurring, spans_of
from framestore.llm.registry import query, table
from framestore.llm.shingles import mix, sets
from framestore.session import delete_path, passing_tables, shuffles_dropped, stage

WIDTH = 5
#: Shingles in the frequency table, 8 bytes each; and the count from which a shingle may be in it.
HEAVY, FREQUENT = 1 << 18, 16
_WORK_BYTES, _SHINGLES_AT_ONCE = 1 << 20, 1 << 20


def least_overlap(size, other=None):
    """Shared shingles that a link needs at least: ceil(4 / 9 of both sizes), or over all partners ceil(4 / 5 size)."""
    return -(-4 * size // 5) if other is None else -(-4 * (size + other) // 9)


def prefix(size: int, k: int) -> int:
    """How many first shingles of a set hold k of those that any linked set shares."""
    return max(0, min(size, size - least_overlap(size) + k))


def _row(schema: dict, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in schema.items()], list(schema))


def frequencies(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, int, float]:
    """(shingles, classes, shift, mean): the most frequent shingles (first bits of their hash, sorted), the
    logarithm of their counts, how far a hash is shifted to compare, and the mean count of all shingles.

    Every shingle of every text is counted: summed up for each batch, dealt by its first bits as arrays, summed up again.
    """
    spark = texts.sparkSession
    n, bits = dealing(spark)
    shift = np.uint64(32 - bits)
    schema = {"bucket": pa.int32(), "low": pa.binary(), "counts": pa.binary()}

    def rows_of(found: list[np.ndarray]) -> pa.RecordBatch:
        seen, counts = np.unique(np.concatenate(found) >> shift, return_counts=True)
        counts = np.minimum(counts, 65535).astype("<u2")
        low, spans = low_bits(seen), spans_of(seen, bits)
        return _row(
            schema, bucket=[i for i, _, _ in spans], low=[low[a:b].tobytes() for _, a, b in spans],
            counts=[counts[a:b].tobytes() for _, a, b in spans],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for part in slices(batch, "text", _WORK_BYTES):
                for one in sets(part.column("text"), WIDTH):
                    found.append(one)
                    held += len(one)
                if held > _SHINGLES_AT_ONCE:
                    yield rows_of(found)
                    found, held = [], 0
        if found:
            yield rows_of(found)

    out = {"shingle": pa.int64(), "n": pa.int64(), "all": pa.int64(), "distinct": pa.int64()}

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, counts = {}, {}
        for batch in batches:
            for i, low, c in zip(*(batch.column(x).to_pylist() for x in schema)):
                lows.setdefault(i, []).append(np.frombuffer(low, "<u4"))
                counts.setdefault(i, []).append(np.frombuffer(c, "<u2"))
        for i in list(lows):
            seen, place = np.unique(np.concatenate(lows.pop(i)), return_inverse=True)
            sums = np.bincount(place, np.concatenate(counts.pop(i))).astype(np.int64)
            often = sums >= FREQUENT
            yield _row(out, shingle=[None], n=[None], all=[int(sums.sum())], distinct=[len(sums)])
            yield _row(
                out, shingle=(i << 32) + seen[often].astype(np.int64), n=sums[often],
                all=[None] * int(often.sum()), distinct=[None] * int(often.sum()),
            )

    dealt = texts.mapInArrow(count, "bucket int, low binary, counts binary").repartition(n, "bucket")
    counted, _ = stage(dealt.mapInArrow(total, "shingle bigint, n bigint, all bigint, distinct bigint"), "frequencies")
    level = F.floor(F.log2("n")).cast("int")
    sums = counted.agg(F.sum("all").alias("all"), F.sum("distinct").alias("distinct")).first()
    # At most 63 rows: how many shingles there are for each power of two.
    at_level = counted.where("n IS NOT NULL").groupBy(level.alias("level")).count().collect()
    least, left = 64, HEAVY
    for r in sorted(at_level, key=lambda r: -r["level"]):
        if r["count"] > left:
            break
        least, left = r["level"], left - r["count"]
    top = counted.where(level >= least).select("shingle", level.alias("level")).toPandas().sort_values("shingle")
    mean = (sums["all"] or 0) / max(1, sums["distinct"] or 0)
    return top["shingle"].to_numpy(np.uint64), top["level"].to_numpy(np.uint8), int(shift), mean


class Order:
    """The common order of shingles: rare before frequent, then by hash."""

    def __init__(self, shingles: np.ndarray, classes: np.ndarray, shift: int):
        self.shingles, self.classes, self.shift = shingles, classes, np.uint64(shift)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.fold = np.uint64(0xFFFFF)
        self.maybe[(shingles & self.fold).astype(np.int64)] = True

    def first(self, found: np.ndarray, n: int) -> np.ndarray:
        """The first n of the sorted shingles `found`."""
        if not len(self.shingles):
            return found[:n]
        cut = found >> self.shift
        hit = np.flatnonzero(self.maybe[(cut & self.fold).astype(np.int64)])
        level = np.zeros(len(found), dtype=np.uint8)
        place = np.minimum(np.searchsorted(self.shingles, cut[hit]), len(self.shingles) - 1)
        level[hit] = np.where(self.shingles[place] == cut[hit], self.classes[place], 0)
        return found[np.argsort(level, kind="stable")[:n]]


def signature(found: np.ndarray) -> tuple[int, int]:
    """128 bits for a set."""
    a, b = mix(found), mix(found ^ np.uint64(0x5555555555555555))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(b).view(np.int64)) if len(b) else 0


def marks(found: np.ndarray) -> bytes:
    """A bit for each remainder of hashes, set if an odd number of the shingles has it. There are one to two a shingle."""
    width = 1 << max(6, (len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """How many shingles only one of two sets has, at least, by their marks: those of both cancel out."""
    x, y = sorted((x, y), key=len)
    few, many, width = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 8 * len(y)
    while width > 8 * len(x):
        width //= 2
        many = (many >> width) ^ (many & ((1 << width) - 1))
    return (few ^ many).bit_count()


_SET = {"size": pa.int32(), "sum": pa.int64(), "xor": pa.int64()}


def set_rows(texts: DataFrame, kind: str, order) -> DataFrame:
    """One row per text: row, id, size, signature and marks of its set, and the first shingles in `order`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = order.value
        for batch in batches:
            for part in slices(batch, "text", _WORK_BYTES):
                found = list(sets(part.column("text"), WIDTH))
                signs = [signature(s) for s in found]
                firsts = [by.first(s, prefix(len(s), 2)).tobytes() for s in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("id"), pa.array([len(s) for s in found], pa.int32()),
                        pa.array([s for s, _ in signs], pa.int64()), pa.array([x for _, x in signs], pa.int64()),
                        pa.array(firsts, pa.binary()), pa.array([marks(s) for s in found], pa.binary()),
                    ],
                    ["row", "id", "size", "sum", "xor", "first", "marks"],
                )

    return texts.mapInArrow(run, f"row bigint, id {kind}, size int, sum bigint, xor bigint, first binary, marks binary")


def boundary(sizes: list[tuple[int, int]], mean: float) -> int:
    """The largest size that counts as small: the cheapest split of `sizes`, (size, how many sets).

    A small set costs its pairs; a large one its list entries, each with the list that it meets. Sets that large
    ones may link with are in the lists as well.
    """
    pairs = lambda s: prefix(s, 2) * (prefix(s, 2) - 1) // 2
    lists = lambda s: prefix(s, 1) * mean
    best = None
    for x in [0, *sorted(s for s, _ in sizes)]:
        cost = sum(n * (pairs(s) if s <= x else lists(s)) for s, n in sizes)
        cost += sum(n * prefix(s, 1) for s, n in sizes if s <= x and 5 * s >= 4 * (x + 1))
        if best is None or cost < best[0]:
            best = (cost, x)
    return best[1]


def keys_of(size: int, first: bytes, small: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) under which a set may meet others: pairs of a small set, single shingles
    of a large one and of those that large ones may link with."""
    tokens, keys, places = np.frombuffer(first, np.uint64), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if size <= small:
        a, b = np.array(list(combinations(range(len(tokens)), 2)), dtype=np.int64).reshape(-1, 2).T
        keys.append(mix(mix(np.minimum(tokens[a], tokens[b])) + np.maximum(tokens[a], tokens[b])))
        places.append(a)
    if size > small or 5 * size >= 4 * (small + 1):
        n = prefix(size, 1)
        keys.append(tokens[:n])
        places.append(np.arange(n))
    return np.concatenate(keys), np.concatenate(places)


_ROWS_AT_ONCE = 1000


def postings(kept: DataFrame, small: int) -> tuple[DataFrame, str]:
    """(key, class, size, place) of the keys that more than one of the sets, kept by part, has; and the path of this table.

    Keys are first dealt as bare numbers to find those; most belong to one set only and are never made into rows.
    """
    spark = kept.sparkSession
    n, bits = dealing(spark)

    def keyed(table: pa.Table | pa.RecordBatch):
        found = [keys_of(s, f, small) for s, f in zip(table.column("size").to_pylist(), table.column("first").to_pylist())]
        of = np.repeat(np.arange(len(found)), [len(k) for k, _ in found])
        return np.concatenate([k for k, _ in found]), np.concatenate([p for _, p in found]), of

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, batch in by_part(batches):
            for a in range(0, batch.num_rows, _ROWS_AT_ONCE):
                keys, _, of = keyed(batch.slice(a, _ROWS_AT_ONCE))
                yield deal(keys, of, part, bits)

    schema = {"key": pa.int64(), "class": pa.int64(), "size": pa.int32(), "place": pa.int32()}

    def list_shared(rows: pa.Table, found: pa.Table) -> pa.Table:
        wanted, parts = answers(found), []
        for a in range(0, len(rows), _ROWS_AT_ONCE):
            some = rows.slice(a, _ROWS_AT_ONCE)
            keys, place, of = keyed(some)
            keep = among(keys >> np.uint64(32 - bits), wanted)
            of = pa.array(of[keep])
            parts.append(pa.Table.from_arrays(
                [pa.array(keys[keep].view(np.int64)), some.column("class").take(of), some.column("size").take(of),
                 pa.array(place[keep].astype(np.int32))], schema=pa.schema(list(schema.items())),
            ))
        return pa.concat_tables(parts) if parts else pa.schema(list(schema.items())).empty_table()

    asked = kept.select("part", "size", "first").mapInArrow(ask, DEALT).repartition(n, "bucket")
    with passing_tables(spark) as lasting:
        shared, _ = stage(recurring(asked), "shared-keys")
        lists = kept.select("part", "class", "size", "first").groupBy("part").cogroup(shared.groupBy("part"))
        listed = stage(lists.applyInArrow(list_shared, "key bigint, class bigint, size int, place int"), "lists")
        lasting.append(listed[1])
    return listed


def _could_link(a: str, b: str):
    """By their sizes, and by what is left of each set from the common key on."""
    both = F.col(f"{a}size") + F.col(f"{b}size")
    rest = F.least(F.col(f"{a}size") - F.col(f"{a}place"), F.col(f"{b}size") - F.col(f"{b}place"))
    return 9 * F.least(f"{a}size", f"{b}size", rest) >= 4 * both


def pivot_pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of a list's pivot, the set that comes into it first, and each other member that it could link with."""
    pivots = lists.groupBy("key").agg(F.min(F.struct("place", "size", "class")).alias("p"), F.count("*").alias("n"))
    pivots = pivots.where("n > 1").select("key", *[F.col(f"p.{c}").alias(f"a_{c}") for c in ("class", "size", "place")])
    own = lists.select("key", *[F.col(c).alias(f"b_{c}") for c in ("class", "size", "place")])
    met = own.join(pivots, "key").where((F.col("a_class") != F.col("b_class")) & _could_link("a_", "b_"))
    return met.select(F.least("a_class", "b_class").alias("a"), F.greatest("a_class", "b_class").alias("b")).distinct()


def open_pairs(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs that share a key, could link, and are not in one component yet."""
    known = lists.join(labels.withColumnRenamed("node", "class"), "class", "left")
    known = known.withColumn("label", F.coalesce("label", "class"))
    several = known.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    known, _ = stage(known.join(several.select("key"), "key"), "open-lists")
    left = known.select("key", *[F.col(c).alias(f"a_{c}") for c in ("class", "size", "place", "label")])
    right = known.select("key", *[F.col(c).alias(f"b_{c}") for c in ("class", "size", "place", "label")])
    met = left.join(right, "key").where((F.col("a_class") < F.col("b_class")) & (F.col("a_label") != F.col("b_label")))
    return met.where(_could_link("a_", "b_")).select(F.col("a_class").alias("a"), F.col("b_class").alias("b")).distinct()


def possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that could link by their marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y, both = (batch.column(c) for c in ("a", "b", "x", "y", "both"))
            # A link shares 4 / 9 of both sizes, so at most 1 / 9 of them is in one set only.
            keep = [9 * least_difference(p, q) <= n for p, q, n in zip(x.to_pylist(), y.to_pylist(), both.to_pylist())]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    x = classes.select(F.col("class").alias("a"), F.col("size").alias("x_size"), F.col("marks").alias("x"))
    y = classes.select(F.col("class").alias("b"), F.col("size").alias("y_size"), F.col("marks").alias("y"))
    met = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", (F.col("x_size") + F.col("y_size")).alias("both"))
    return met.mapInArrow(run, "a bigint, b bigint")


def filter_bits(n: int) -> int:
    """The logarithm of the bits of a filter for n sets: 16 a set or more, so that few others pass; 2 ** 20 to 2 ** 27 bits."""
    return min(27, max(20, (16 * n).bit_length()))


def wanted_sets(texts: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(class, shingles) of the classes in `pairs`, from a second look at the texts.

    A filter that grows with the classes, up to 16 MB, keeps most other texts from being moved. It only saves work.
    """
    spark = texts.sparkSession
    nodes = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    keys, _ = stage(nodes.join(classes.select("class", *_SET), "class"), "wanted")
    width = filter_bits(keys.count())
    bit = F.shiftrightunsigned("sum", 64 - width)
    word = keys.groupBy(F.shiftright(bit, 5).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1, CAST(shiftrightunsigned(sum, {64 - width}) & 31 AS int))")).alias("bits")
    ).toArrow()
    words = np.zeros(1 << (width - 5), dtype=np.uint32)
    words[word.column("word").to_numpy()] = word.column("bits").to_numpy().view(np.uint32)
    held = spark.sparkContext.broadcast(words)
    schema = {**_SET, "shingles": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            for part in slices(batch, "text", _WORK_BYTES):
                rows = []
                for s in sets(part.column("text"), WIDTH):
                    total, xor = signature(s)
                    at = (total & 0xFFFFFFFFFFFFFFFF) >> (64 - width)
                    if len(s) and int(bits[at >> 5]) >> (at & 31) & 1:
                        rows.append((len(s), total, xor, s.tobytes()))
                if rows:
                    yield _row(schema, **dict(zip(schema, zip(*rows))))

    found = texts.select("text").mapInArrow(run, "size int, sum bigint, xor bigint, shingles binary")
    one = found.groupBy(*_SET).agg(F.first("shingles").alias("shingles"))
    return keys.join(one, list(_SET)).select("class", "shingles")


def verified(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    schema = {"a": pa.int64(), "b": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                keep.append(9 * int((both[1:] == both[:-1]).sum()) >= 4 * (len(x) + len(y)))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], list(schema))

    x = found.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    y = found.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def similar(texts: DataFrame, classes: DataFrame, pairs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The `verified` pairs, staged."""
    with passing_tables(texts.sparkSession) as lasting:
        pairs, _ = stage(possible(pairs, classes), "possible")
        links = stage(verified(pairs, wanted_sets(texts, classes, pairs)), label)
        lasting.append(links[1])
    return links


def _classed(texts: DataFrame, kind: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their sets, the classes of equal sets, and the component labels of those that link with another.

    Tables that hold shingles or lists are the large ones; marks take a 64th to a 32nd of what shingles take. Each goes as soon as it has been read for the last time.
    """
    spark = texts.sparkSession
    with passing_tables(spark):
        shingles, levels, shift, mean = frequencies(texts.select("text"))
    order = spark.sparkContext.broadcast(Order(shingles, levels, shift))
    sets_of, sets_path = stage(set_rows(texts, kind, order), "sets")
    classes = sets_of.where("size > 0").groupBy(*_SET).agg(
        F.min("id").alias("low_id"), F.min("row").alias("low_row"), *[F.first(c).alias(c) for c in ("first", "marks")]
    )
    with kept_by_part(classes.withColumn("class", F.monotonically_increasing_id()), lasting=False) as (kept, plain):
        rows, _ = stage(sets_of.drop("first", "marks"), "rows")
        delete_path(spark, sets_path)
        classes, _ = stage(plain.drop("first", "part"), "classes")
        # Sizes in steps of a tenth: a few hundred rows at most.
        step = F.floor(F.log(F.col("size").cast("double")) / F.lit(np.log(1.1)))
        sizes = classes.groupBy(step.alias("step")).agg(F.max("size").alias("size"), F.count("*").alias("n")).collect()
        lists, lists_path = postings(kept, boundary([(r["size"], r["n"]) for r in sizes], mean))
    pairs, pairs_path = stage(pivot_pairs(lists), "pivot-pairs")
    links, _ = similar(texts, classes, pairs, "pivot-links")
    labels = components(links)
    with passing_tables(spark) as lasting:
        rest, rest_path = stage(open_pairs(lists, labels).join(pairs, ["a", "b"], "left_anti"), "open-pairs")
        lasting.append(rest_path)
    delete_path(spark, lists_path)
    delete_path(spark, pairs_path)
    if rest.limit(1).count():
        more, _ = similar(texts, classes, rest, "open-links")
        labels = components(links.union(more))
    delete_path(spark, rest_path)
    return rows, classes, labels


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `n_shingles`, `component_id` (the smallest id linked with it, at any
    distance) and `component_row` / `row`, which tell repeated ids apart.

    Two texts link at a Jaccard similarity of 0.8 of their sets of five-word shingles.
    Texts without words link with nothing, null counts as such. A null id is its
    own component unless linked. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    with shuffles_dropped(spark):
        rows, classes, labels = _classed(texts, id_type(docs, id_col))
    low = classes.select("class", *_SET, "low_id", "low_row").join(labels.withColumnRenamed("node", "class"), "class", "left")
    low = low.withColumn("label", F.coalesce("label", "class"))
    least = low.groupBy("label").agg(F.min("low_id").alias("least_id"), F.min("low_row").alias("least_row"))
    least = low.join(least, "label").select(*_SET, "least_id", "least_row")
    joined = rows.join(least, list(_SET), "left")
    return joined.select(
        F.col("id").alias(id_col), F.col("size").cast("long").alias("n_shingles"),
        F.coalesce("least_id", "id").alias("component_id"), "row", F.coalesce("least_row", "row").alias("component_row"),
    )


@query(
    oracle=r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + 4), ' ')) AS s
        FROM words, unnest(generate_series(1, greatest(1, len(w) - 4))) g(i) WHERE len(w) > 0
    ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
        GROUP BY ALL
    ), links AS (
        SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
        WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)
    ), reach AS (
        SELECT doc_id, doc_id AS node FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.node
    )
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(node) AS component_id
    FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """
)
def op3_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
