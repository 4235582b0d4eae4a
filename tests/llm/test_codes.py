"""Vector codes against plain Lloyd rounds, and the invariants of cover trees."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from framestore.errors import InvalidInputError
from framestore.llm.codes import Tree, assign, books_sha256, compress, cover_tree

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    """[(vec_id, code, error, label_error)] and the codebooks, in Python integers."""
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v], y) for i, v, y in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for _, v, _ in kept] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, book: min((square(x, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            owner = [nearest(x, books[p])[1] for x in cut[p]]
            for e in set(owner):
                mine = [x for x, o in zip(cut[p], owner) if o == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[nearest(x, books[p]) for x in cut[p]] for p in range(parts)]
    codes = ["".join(f"{f[k][1]:02x}" for f in found) for k in range(len(kept))]
    errors = [sum(f[k][0] for f in found) for k in range(len(kept))]
    by_label = Counter()
    for (_, _, y), e in zip(kept, errors):
        by_label[y] += e
    return [(i, c, e, by_label[y]) for (i, _, y), c, e in zip(kept, codes, errors)], books


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(5)
    made = [(int(i), [float(x) for x in np.float32(random.normal(0, 0.2, 8))], int(i % 4) or None) for i in range(300)]
    made += [(1000 + k, made[7][1], 1) for k in range(60)]  # copies
    made += [(1000, made[9][1], 2), (1000, made[9][1], 2), (None, made[3][1], 3), (2000, [0.0] * 8, 3), (2001, [-0.0001] * 8, None)]
    odd = [None, [], [None] * 8, [float("nan")] * 8, [0.0] * 7 + [float("inf")], [0.0] * 7 + [None]]
    return made + [(3000 + k, v, 1) for k, v in enumerate(odd)] + [(-1, None, None)]


@pytest.mark.parametrize("entries", [256, 5])
def test_codes_equal_plain_lloyd(spark, rows, entries):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("extra") for c in ("id", "vector", "code", "error", "points")})
    codes, books = compress(df, entries=entries)
    expected, plain_books = plain(rows, entries=entries)
    assert codes.columns == ["vec_id", "code", "error", "label_error"]
    assert sorted(map(tuple, codes.collect()), key=repr) == sorted(expected, key=repr)
    assert books.tolist() == plain_books
    assert books_sha256(books) == hashlib.sha256(",".join(str(x) for b in plain_books for c in b for x in c).encode()).hexdigest()


def test_hot_and_rare_labels(spark):
    rows = [(i, [float(i % 7)] * 4, 1 if i % 3 else i) for i in range(200)]
    codes, _ = compress(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, codes.collect())) == sorted(plain(rows)[0])


def test_codes_of_no_vectors(spark):
    codes, books = compress(spark.createDataFrame([], SCHEMA))
    assert codes.count() == 0 and books.size == 0
    codes, books = compress(spark.createDataFrame([(1, None, 1)], SCHEMA))
    assert codes.count() == 0


def test_vectors_of_other_lengths_go(spark):
    rows = [(1, [1.0] * 8, 1), (2, [1.0] * 12, 1), (3, [2.0] * 8, 1)]
    assert [r.vec_id for r in compress(spark.createDataFrame(rows, SCHEMA))[0].orderBy("vec_id").collect()] == [1, 3]
    with pytest.raises(InvalidInputError):
        compress(spark.createDataFrame([(1, [1.0] * 6, 1)], SCHEMA))


def test_cover_trees_keep_their_rules_and_settle_whole_nodes():
    random = np.random.default_rng(1)
    centres = random.integers(-4000, 4000, (6, 8))
    points = (centres[random.integers(0, 6, 500)] + random.integers(-20, 20, (500, 8))).astype(np.float64)
    points[100:200] = points[0]
    tree = Tree.from_bytes(cover_tree(points).to_bytes(), len(points))
    assert sorted(tree.order.tolist()) == list(range(500))
    far = lambda a, b: np.sqrt(((points[a] - points[b]) ** 2).sum(-1))
    for k in range(len(tree.starts)):
        inside = tree.order[tree.starts[k] : tree.stops[k]]
        assert np.isclose(far(inside, inside[0]).max(), tree.radius[k])
        kids = range(tree.first[k], tree.first[k] + tree.children[k])
        if tree.children[k]:
            half = 2.0 ** (np.ceil(np.log2(tree.radius[k])) - 1)
            assert [tree.starts[k], *[tree.stops[c] for c in kids]] == [*[tree.starts[c] for c in kids], tree.stops[k]]
            assert tree.order[tree.starts[kids[0]]] == inside[0] and all(tree.radius[c] <= half + 1e-9 for c in kids)
            first = tree.order[tree.starts[list(kids)]]
            assert all(far(a, b) > half - 1e-9 for n, a in enumerate(first) for b in first[:n])
    entries = np.concatenate([points[[0, 0]], centres, points[:20]])
    sums = np.zeros((501, 8), dtype=np.int64)
    np.cumsum(points[tree.order].astype(np.int64), axis=0, out=sums[1:])
    owner, total, count = assign(tree, points, sums, entries)
    exact = ((points[:, None] - entries[None]) ** 2).sum(-1).argmin(1)
    assert owner.tolist() == exact.tolist() and count.tolist() == np.bincount(exact, minlength=len(entries)).tolist()
    assert all(total[e].tolist() == points[exact == e].sum(0).tolist() for e in range(len(entries)))
