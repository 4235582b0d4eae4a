"""Lines that one cut or another kept apart: punctuation and white space, and long lines at the full tenth."""

from __future__ import annotations

import random

import brute
from pyspark.sql import functions as F

from framestore.llm.lines import _edits_between_anchors, _verified, block_keys, dedup_lines, simhash

SCHEMA = "doc_id bigint, text string"


def kept(spark, texts):
    rows = dedup_lines(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_lines_are_equal_up_to_punctuation_and_white_space(spark):
    texts = ["Terms of use", "Terms of use.", "terms  of\tuse", "(Terms, of: use)", "Terms of sale", "-----\n* * *", "-----\n* * *", "...\nterms of use!"]
    assert kept(spark, texts) == ["Terms of use", "", "", "", "Terms of sale", "-----\n* * *", "-----\n* * *", "..."]
    many = ",".join(f"w{k}" for k in range(700))
    assert kept(spark, [many, many.replace(",", " , ")]) == [many, ""]


def test_long_lines_link_at_the_full_tenth(spark):
    """The sets of words, and so the SimHashes, are the same: 60 words of a line of 14,000 characters are missing, then 400."""
    words = [f"word{k % 100:02d}" for k in range(2000)]
    near, far = (words[:1000] + words[1000 + n :] for n in (60, 400))
    assert kept(spark, [" ".join(x) for x in (words, near, far)]) == [" ".join(words), "", " ".join(far)]


def test_edits_of_shortened_texts_are_those_of_the_whole(spark):
    """What both begin or end with is cut off, and pieces are only an upper bound: the verdict is that of the plain distance."""
    draw = random.Random(5)
    texts = []
    for n in (1, 9, 10, 37, 200, 640):
        one = "".join(draw.choice("abcdé ") for _ in range(n))
        texts += [(one, one), (one, one[::-1]), (one, one + "x" * (n // 10)), (one, "y" * (n // 10 + 1) + one)]
        for changes in (1, max(1, n // 12), n // 10 + 1, n // 5 + 1):
            other = list(one)
            for _ in range(changes):
                other[draw.randrange(len(other))] = draw.choice(["z", "", "zz"])
            texts.append((one, "".join(other)))
    nodes = spark.createDataFrame([(2 * k + i, x) for k, pair in enumerate(texts) for i, x in enumerate(pair)], "line bigint, norm string")
    pairs = spark.createDataFrame([(2 * k, 2 * k + 1) for k in range(len(texts))], "a bigint, b bigint")
    got = {r["a"] // 2 for r in _verified(pairs, nodes).collect()}
    assert got == {k for k, (x, y) in enumerate(texts) if brute.edits(x, y) <= max(len(x), len(y)) // 10}


def test_lines_meet_at_distance_3_but_not_on_25_equal_bits(spark):
    """Keys of 25 bits made lists of unlike lines, which grew with the square of the input."""
    draw = random.Random(7)
    pairs = []
    for k in range(200):
        one = draw.getrandbits(63)
        other = one
        for b in draw.sample(range(63), 3):
            other ^= 1 << b
        pairs.append((k, one, other))
    whole = (1 << 63) - 1
    pairs += [(200 + k, x, x ^ (whole >> 25 << 25)) for k, (_, x, _) in enumerate(pairs[:20])]
    pairs = spark.createDataFrame(pairs, "k int, x bigint, y bigint")
    keys = [pairs.select("k", F.col(c).alias("sim")).select("k", F.explode(block_keys()).alias("key")) for c in "xy"]
    met = keys[0].join(keys[1], ["k", "key"]).select("k").distinct()
    assert sorted(r["k"] for r in met.collect()) == list(range(200))


def test_few_keys_are_moved_and_no_texts(spark):
    """A line had 20 keys, and the texts of all documents that lose lines were moved to the places of these."""
    assert spark.range(1).select(F.lit(5).cast("bigint").alias("sim")).select(F.size(block_keys()).alias("n")).first()["n"] == 14
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = dedup_lines(spark.createDataFrame([(k, f"same line\nown line {k * k}") for k in range(50)], SCHEMA))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
        assert sum(r["n_removed"] for r in got.collect()) >= 49
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_pieces_between_anchors_bound_the_edits(spark):
    """Words put in move the rest of a line, so pieces at fixed shares of it differ throughout."""
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randrange(2, 8)))
    pairs = []
    for n in (0, 1, 6, 31, 90, 120):
        for changes in (0, 1, 3, 40):
            words = [word() for _ in range(n)]
            other = list(words)
            for _ in range(changes):
                k = draw.randrange(len(other) + 1)
                other[k : k + draw.randrange(2)] = [word()]
            pairs.append((" ".join(words), " ".join(other)))
    got = spark.createDataFrame(pairs, "x string, y string").select("x", "y", _edits_between_anchors().alias("n")).collect()
    exact = [brute.edits(r["x"], r["y"]) for r in got]
    assert all(r["n"] >= e for r, e in zip(got, exact))
    moved = [(r["n"], len(r["x"]) // 10) for r, e in zip(got, exact) if len(r["x"]) > 300 and e <= 30]
    assert len(moved) >= 6 and all(n <= most for n, most in moved)


def test_simhashes_of_all_lengths(spark):
    """Counters of seven and nine bits, and of every bit by itself, at the lengths where one gives way to the next."""
    words = [f"w{k}" for k in range(600)]
    rows = [(" ".join(words[:n]),) for n in (1, 2, 3, 64, 127, 128, 255, 256, 511, 512, 600)]
    hashes = F.expr("transform(split(norm, ' '), word -> xxhash64(word) & 9223372036854775807L)").alias("hashes")
    got = spark.createDataFrame(rows, "norm string").select("norm", hashes).select("norm", simhash().alias("sim")).collect()
    assert [r["sim"] for r in got] == [brute.simhash(r["norm"]) for r in got]
