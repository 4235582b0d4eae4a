"""Vector codes: product quantisation by Lloyd rounds over cover trees, in exact integers.

Vectors are cut into parts; the parts of a position share a codebook. In each round every part goes to its
nearest entry, and every entry becomes the mean of its parts.

The vectors of a partition are kept in runs of at most `TREE_ROWS`, each with one cover tree per part position, which are
built once and stored. A node knows the sum and the number of all points below it, and how far the farthest one is. By the triangle
inequality, a node whose second nearest entry is more than two radii farther than its nearest goes to that entry as
a whole, by its sum; only the children of the other nodes are looked at, down to exact comparisons of points.

What moves between tasks in a round is one sum per entry, component and task. The codebooks, of a fixed size, come to the
driver and go back to the tasks. The result is that of plain Lloyd rounds, whatever the trees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from framestore.errors import InvalidInputError
from framestore.llm.registry import query, table
from framestore.session import own_scratch, stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of one cover tree.
TREE_ROWS = 1024
#: Points of a node that is not split any more.
LEAF = 8
#: Sums of squares up to here are exact as floating point numbers, and so are compared.
_EXACT = 1 << 52


@dataclass
class Tree:
    """A cover tree over `points`. Node i holds the points starts[i]:stops[i] of `order`; its centre is the first of them.

    Its children are the nodes first[i]:first[i] + children[i]. Each child has points within half the scale of its parent from
    its centre, and the centres of the children of one node are farther apart than that.
    """

    order: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    children: np.ndarray

    def to_bytes(self) -> bytes:
        return b"".join(x.tobytes() for x in (self.order, self.starts, self.stops, self.radius, self.first, self.children))

    @staticmethod
    def from_bytes(raw: bytes, n: int) -> Tree:
        m = (len(raw) // 4 - n) // 6
        kinds, sizes = ("<i4", "<i4", "<i4", "<f8", "<i4", "<i4"), (n, m, m, m, m, m)
        ends = np.cumsum([0, *[s * np.dtype(k).itemsize for k, s in zip(kinds, sizes)]]).tolist()
        return Tree(*[np.frombuffer(raw[a:b], k) for k, a, b in zip(kinds, ends, ends[1:])])


def _squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows: whole numbers, exact below `_EXACT`."""
    return (points**2).sum(1)[:, None] + (others**2).sum(1)[None, :] - 2.0 * (points @ others.T)


def cover_tree(points: np.ndarray) -> Tree:
    """The cover tree of the rows of `points` (whole numbers as float64), at least one."""
    square = _squares(points, points)
    order = np.arange(len(points))
    nodes = [(0, len(points))]
    radius, first, children = [], [], []
    for a, b in nodes:  # which grows
        rows = order[a:b]
        far = square[rows[0], rows].max() if b - a > 1 else 0.0
        radius.append(np.sqrt(far))
        first.append(len(nodes))
        if b - a <= LEAF or far == 0:
            children.append(0)
            continue
        # Half of the smallest power of two that covers the node. Scales are squared here.
        limit = 4.0 ** (np.ceil(np.log2(far) / 2) - 1)
        near = (square <= limit)[rows][:, rows] if b - a == len(points) else square[np.ix_(rows, rows)] <= limit
        owner = np.full(len(rows), -1, dtype=np.int64)
        open_ = np.ones(len(rows), dtype=bool)
        n = 0
        while True:
            centre = int(open_.argmax())
            if not open_[centre]:
                break
            taken = near[centre] & open_
            owner[taken] = n
            open_ &= ~taken
            n += 1
        # Stable, so the centre of a child, its first uncovered point, comes first.
        order[a:b] = rows[np.argsort(owner, kind="stable")]
        ends = a + np.cumsum(np.bincount(owner, minlength=n))
        nodes += list(zip([a, *ends[:-1].tolist()], ends.tolist()))
        children.append(n)
    ends = np.array(nodes, dtype="<i4")
    ints = lambda x: np.array(x, dtype="<i4")
    return Tree(order.astype("<i4"), ends[:, 0].copy(), ends[:, 1].copy(), np.array(radius, dtype="<f8"), ints(first), ints(children))


def assign(tree: Tree, points: np.ndarray, sums: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each point, sums and counts per entry). `sums` are the cumulative sums of the points in tree order."""
    owner = np.empty(len(points), dtype=np.int64)
    total = np.zeros(entries.shape, dtype=np.int64)
    count = np.zeros(len(entries), dtype=np.int64)
    active, alone = np.zeros(1, dtype=np.int64), []
    while len(active):
        square = _squares(points[tree.order[tree.starts[active]]], entries)
        nearest = square.argmin(axis=1)
        least = np.sqrt(square[np.arange(len(active)), nearest])
        # A hair more than two radii: rounding can only keep a node from being settled.
        reach = (least + 2 * tree.radius[active]) * (1 + 1e-9) + 1e-6
        settled = ((square <= (reach**2)[:, None]).sum(axis=1) == 1) | (tree.radius[active] == 0)
        a, b, e = tree.starts[active[settled]], tree.stops[active[settled]], nearest[settled]
        np.add.at(total, e, sums[b] - sums[a])
        np.add.at(count, e, (b - a).astype(np.int64))
        owner[tree.order[_ranges(a, b)]] = np.repeat(e, b - a)
        open_ = active[~settled]
        leaf = tree.children[open_] == 0
        alone.append(_ranges(tree.starts[open_[leaf]], tree.stops[open_[leaf]]))
        inner = open_[~leaf]
        active = _ranges(tree.first[inner], tree.first[inner] + tree.children[inner])
    rows = tree.order[np.concatenate(alone)]
    if len(rows):
        owner[rows] = _squares(points[rows], entries).argmin(axis=1)
        np.add.at(total, owner[rows], points[rows].astype(np.int64))
        np.add.at(count, owner[rows], 1)
    return owner, total, count


def _ranges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All of a[0]:b[0], a[1]:b[1], ... one after the other."""
    size = (b - a).astype(np.int64)
    return np.arange(int(size.sum())) + np.repeat(a - (np.cumsum(size) - size), size)


def _matrix(column: pa.Array) -> np.ndarray:
    """The whole numbers of a list column whose lists have one length, as float64."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * values).reshape(len(column), -1)


def tree_runs(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """One row per run of vectors: lists `ids` and `labels`, `points` (32-bit numbers, part after part), `trees`."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), TREE_ROWS):
                batch = whole.slice(a, TREE_ROWS)
                numbers = _matrix(batch.column("vector"))
                if 4 * width * np.abs(numbers).max() ** 2 >= _EXACT:
                    raise ValueError(f"Components are too large for exact distances: {np.abs(numbers).max() / SCALE}")
                cut = [np.ascontiguousarray(x) for x in np.split(numbers, parts, axis=1)]
                lists = [
                    pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), batch.column(c)) for c in ("id", "label")
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *lists, pa.array([b"".join(x.astype("<i4").tobytes() for x in cut)], pa.binary()),
                        pa.array([[cover_tree(x).to_bytes() for x in cut]], pa.list_(pa.binary())),
                    ],
                    ["ids", "labels", "points", "trees"],
                )

    return rows.mapInArrow(
        run, f"ids array<{types['id']}>, labels array<{types['label']}>, points binary, trees array<binary>"
    )


def _forest(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.Array, pa.Array, list[tuple[Tree, np.ndarray]]]]:
    for batch in batches:
        for k in range(len(batch)):
            ids, labels = (batch.column(c).slice(k, 1).flatten() for c in ("ids", "labels"))
            points = np.frombuffer(batch.column("points")[k].as_py(), "<i4").reshape(parts, len(ids), -1).astype(np.float64)
            trees = [Tree.from_bytes(raw, len(ids)) for raw in batch.column("trees")[k].as_py()]
            yield ids, labels, list(zip(trees, points))


def _sums(tree: Tree, points: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, ... points in tree order; a node's sum is the difference at its ends."""
    out = np.zeros((len(points) + 1, points.shape[1]), dtype=np.int64)
    np.cumsum(points[tree.order].astype(np.int64), axis=0, out=out[1:])
    return out


def lloyd_round(runs: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (part, entry, component) after one round. An entry without parts stays."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last column counts.
        held = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for _, _, forest in _forest(batches, parts):
            for k, (tree, points) in enumerate(forest):
                _, total, count = assign(tree, points, _sums(tree, points), books[k].astype(np.float64))
                held[k, :, :-1] += total
                held[k, :, -1] += count
        used = np.flatnonzero(np.repeat(held[:, :, -1].ravel() > 0, width + 1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held.ravel()[used])], ["cell", "value"])

    found = runs.select("ids", "labels", "points", "trees").mapInArrow(run, "cell bigint, value bigint")
    # One row per part, entry and component at most, whatever the input.
    found = found.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    held = np.zeros(parts * entries * (width + 1), dtype=np.int64)
    held[found.column("cell").to_numpy()] = found.column("value").to_numpy()
    held = held.reshape(parts, entries, width + 1)
    count = held[:, :, -1:]
    return np.where(count > 0, held[:, :, :-1] // np.maximum(count, 1), books)


def encode(runs: DataFrame, books: np.ndarray, id_type: str, label_type: str) -> DataFrame:
    """(id, label, code, error) of every vector of the runs."""
    parts = books.shape[0]
    digits = np.array([f"{k:02x}" for k in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, forest in _forest(batches, parts):
            owners, error = [], np.zeros(len(ids), dtype=np.int64)
            for k, (tree, points) in enumerate(forest):
                owner, _, _ = assign(tree, points, _sums(tree, points), books[k].astype(np.float64))
                error += ((points - books[k][owner]) ** 2).sum(axis=1).astype(np.int64)
                owners.append(digits[owner])
            codes = ["".join(x) for x in zip(*owners)]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes, pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    return runs.mapInArrow(run, f"id {id_type}, label {label_type}, code string, error bigint")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """`coded` (a stored table) with the sum of `error` over equal labels; nulls are equal here.

    Labels that hold more than a share of all rows are few, are broadcast, and their rows stay where they are; all others are joined by a shuffle.
    """
    tasks = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums, path = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    own_scratch(coded.sparkSession, path)
    # At most `tasks` + 1 labels can have more rows than this.
    hot = sums.agg(F.sum("n").alias("n")).first()["n"] or 0
    is_hot = F.col("label").isNull() | (F.col("n") * tasks > hot)
    few = F.broadcast(sums.where(is_hot).select(F.col("label").alias("_label"), "label_error"))
    same = F.col("label").eqNullSafe(F.col("_label"))
    many = sums.where(~is_hot).select("label", "label_error")
    rest = coded.join(few, same, "left_anti").join(many, "label")
    columns = ["id", "code", "error", "label_error"]
    return coded.join(few, same).select(*columns).unionByName(rest.select(*columns))


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks). Codes have one row per kept vector: id, `code`, `error`, `label_error`; `entries` is at most 256.

    Rows without a vector, or with a null or a non-finite component in it, are dropped, and so are those whose vector has another
    number of components than that of the smallest kept id; it must be a multiple of `parts`. The first codebooks are
    the parts of the vectors of the smallest ids (null last; equal ids by their vectors). Repeated rows count each by
    itself. Fewer vectors than `entries` give smaller codebooks, an empty table gives none and no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    if not 0 < entries <= 256:
        raise InvalidInputError("A code has two hex digits: at most 256 entries", data=entries)
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
        F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double")).alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    order = [F.col("id").isNull(), F.col("id"), F.col("vector")]
    # `entries` vectors at most come to the driver.
    lead = [r["vector"] for r in rows.orderBy(*order).limit(entries).select("vector").collect()]
    width, rest = divmod(len(lead[0]), parts) if lead else (1, 0)
    if rest:
        raise InvalidInputError(f"Vectors of {len(lead[0])} components cannot be cut into {parts} equal parts", data=len(lead[0]))
    if lead and any(len(v) != len(lead[0]) for v in lead):
        rows = rows.where(F.size("vector") == len(lead[0]))
        lead = [r["vector"] for r in rows.orderBy(*order).limit(entries).select("vector").collect()]
    else:
        rows = rows.where(F.size("vector") == parts * width)
    books = np.floor(SCALE * np.array(lead, dtype=np.float64)).astype(np.int64).reshape(len(lead), parts, width).transpose(1, 0, 2)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    runs, path = stage(tree_runs(rows, width, parts), "vector-trees")
    own_scratch(spark, path)
    if lead:
        for _ in range(rounds):
            books = lloyd_round(runs, books)
    coded, coded_path = stage(encode(runs, books, types["id"], types["label"]), "vector-codes")
    own_scratch(spark, coded_path)
    return with_label_errors(coded).withColumnRenamed("id", id_col), books


def _sql() -> str:
    """Plain Lloyd rounds, each as a join of all parts with all entries."""
    text = [
        f"""
        WITH kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        cut AS (
            SELECT vec_id, label, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x
            FROM kept, (SELECT unnest(range({PARTS})) AS p)
        ),
        book0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM cut QUALIFY e < {ENTRIES})"""
    ]
    for r in range(ROUNDS + 1):
        text.append(
            f"""
        near{r} AS MATERIALIZED (
            SELECT vec_id, any_value(label) AS label, cut.p, any_value(x) AS x, CAST(min((list_inner_product(x, x) + list_inner_product(c, c) - 2 * list_inner_product(x, c)) * 256 + e) AS BIGINT) AS best
            FROM cut JOIN book{r} b ON b.p = cut.p GROUP BY vec_id, cut.p
        )"""
        )
        if r < ROUNDS:
            text.append(
                f"""
        mean{r} AS (
            SELECT p, e, list(CAST(m AS DOUBLE) ORDER BY i) AS c FROM (
                SELECT p, best % 256 AS e, i, floor(sum(x[i]) / count(*)) AS m
                FROM near{r}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM cut) + 1)) AS i) GROUP BY ALL)
            GROUP BY p, e
        ),
        book{r + 1} AS MATERIALIZED (
            SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.e = b.e
        )"""
            )
    return (
        ",".join(text)
        + f""",
        coded AS (
            SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code,
                   CAST(sum(best // 256) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id
        ),
        books AS (
            SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e)) AS codebooks_sha256
            FROM book{ROUNDS}
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books
        """
    )


@query(_sql())
def op11_codes(spark, sf_dir):
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
