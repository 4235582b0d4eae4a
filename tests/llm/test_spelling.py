"""Spelling variants against all pairs of words in plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from framestore.llm.spelling import Filters, edits, spelling_variants, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    found = {w: [x for x in n if near(w, x)] for w in n}
    form = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in found.items() if xs}
    form = {w: x for w, x in form.items() if n[x] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n[w], len(found[w]), n.get(form.get(w))) for w in n)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    words = {"market": 900, "markets": 150, "marke": 5, "marekt": 5, "marketss": 25, "marketsss": 5, "märket": 30, "mÄrket": 6, "arket": 9,
             "barket": 900, "aaaaaa": 40, "aaaaaaa": 40, "aaaaaaaa": 8, "STRAßE": 7, "strasse": 7, "straße×": 5}
    odd = [(9001, None), (9002, ""), (9003, "12 3 - !"), (None, "nullid nullid nullid nullid nullid nullid"), (9004, "z" * 300 + "\n" + ("z" * 299 + " ") * 6)]
    odd += [(9005, ("z" * 300 + " ") * 30)] * 2 + [(10000 + k, " ".join([w] * c)) for k, (w, c) in enumerate(words.items())]
    return given + odd


def same(got, expected):
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_variants_equal_all_pairs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    df = df.withColumns({c: F.lit("extra") for c in ("word", "n", "a", "b", "run", "name", "form", "near")})
    expected = plain(rows)
    by_word = {x[0]: x for x in expected}
    assert by_word["marketsss"][1:3] == ("marketss", "market") and by_word["z" * 299][2] == "z" * 300
    assert sum(x[1] is not None for x in expected) > 8
    got = spelling_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    same(got.collect(), expected)


def test_full_filters_lose_nothing(spark, rows):
    """Two blocks for all words: nearly every edit passes, and the join drops what is no word."""
    few = [r for r in rows if (r[0] or 0) >= 9000 or r[0] is None]
    same(spelling_variants(spark.createDataFrame(few, "doc_id bigint, text string"), blocks=2).collect(), plain(few))


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling_variants(empty).count() == 0
    assert spelling_variants(spark.createDataFrame([(1, None), (2, "a b"), (3, "onlyonce")], "doc_id bigint, text string")).count() == 0


def test_hashes_of_edits_are_those_of_the_words():
    words = ["banana", "baaaaa", "ùcdefg"]
    codes = np.array([[ord(c) for c in w] for w in words], dtype=np.uint64)
    seen = {}

    def holds(size, hashes):
        seen.setdefault(size, []).append(hashes)
        return np.ones(hashes.shape, dtype=bool)

    made = [(words[w][:p] + (chr(c) if c >= 0 else "") + words[w][p + 1 :]) for part in edits(codes, holds) for w, p, c in zip(*part)]
    assert len(made) == len(set(made)) and {"anana", "baaaa", "baaana", "ucdefg", "àcdefg"} <= set(made) and all(x not in words for x in made)
    hashes = {int(x) for size in seen.values() for h in size for x in h.ravel()}
    assert all(int(word_hashes(np.array([[ord(c) for c in x]], dtype=np.uint64))[0]) in hashes for x in made)
    filters = Filters({6: 1000, 7: 10}, blocks=50)
    assert sum(filters.sizes.values()) <= 50 and not filters.holds(9, np.zeros(3, np.uint64)).any()
