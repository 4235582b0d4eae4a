"""Packing in tiers: every id once, the checksums of the tokenizers library, full sequences, even step groups."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from framestore.errors import InvalidInputError
from framestore.llm.packing import vocabulary_file
from framestore.llm.tiers import TIERS, encoder, pack_tiers, plan_tiers

SCHEMA = "doc_id bigint, text string"


def library_ids(texts, file="byte_bpe_50k.json"):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_file(file))
    return [np.array([*e.ids, 0], dtype="<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    odd = [None, "", " ", "a", "<|endoftext|> x <|endoftext|>", "\n\n  \t  don't 123 日本語 \U0001f9ff\0", "same text", "same text", "word " * 5000, "x" * 30000]
    return given[:120] + [(9000 + k, t) for k, t in enumerate(odd)] + [(None, "null id"), (None, None), (9001, "same id")]


def check(got, rows, file="byte_bpe_50k.json", tiers=TIERS):
    """Pieces are those of the rows, sequences are full and of a power of two; returns tokens and sequences per tier."""
    ids = library_ids([t for _, t in rows], file)
    whole, by_doc, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for (i, _), x in zip(rows, ids):
        whole[i].append(x)
    for r in got:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by_doc) == set(whole)
    for i, pieces in by_doc.items():
        if len(whole[i]) == 1:  # ids that are not repeated
            (x,), at = whole[i], 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(x)
                assert r.ids_crc32 == zlib.crc32(x[at : at + r.length].tobytes())
                at += r.length
            assert at == len(x)
        assert sum(r.length for r in pieces) == sum(map(len, whole[i]))
    kinds = Counter()
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0 and r.tier == pieces[0].tier and r.step_group == pieces[0].step_group
            at += r.length
        assert at == pieces[0].tier and not at & (at - 1)
        kinds[at] += 1
    assert sum(n for t, n in kinds.items() if t not in tiers) < 11
    return kinds, sequences


def test_every_id_once_in_full_sequences(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("extra") for c in ("id", "row", "n", "rest", "full", "part", "length", "ids")})
    got = pack_tiers(df, step_tokens=8192).collect()
    kinds, sequences = check(got, rows)
    assert len(kinds) > 2
    tokens, per_tier = Counter(), defaultdict(Counter)
    for pieces in sequences.values():
        tokens[pieces[0].step_group] += pieces[0].tier
        per_tier[pieces[0].tier][pieces[0].step_group] += 1
    assert len(tokens) > 5 and max(tokens.values()) - min(tokens.values()) <= 1024
    assert all(max(c[g] for g in tokens) - min(c[g] for g in tokens) <= 1 for c in per_tier.values())
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)


def test_other_tiers_and_another_tokenizer(spark, rows):
    few = rows[:20] + rows[-13:]
    got = pack_tiers(spark.createDataFrame(few, SCHEMA), path=vocabulary_file("word_bpe_49k.json"), tiers=(64, 256), with_ids=False).collect()
    check(got, few, "word_bpe_49k.json", (256, 64))
    with pytest.raises(InvalidInputError):
        pack_tiers(spark.createDataFrame(few, SCHEMA), tiers=(100,))


def test_empty_and_blank_tables(spark):
    assert pack_tiers(spark.createDataFrame([], SCHEMA)).count() == 0
    got = pack_tiers(spark.createDataFrame([(1, None), (1, ""), (2, None)], SCHEMA)).collect()
    assert sorted((r.tier, r.offset) for r in got) == [(1, 0), (2, 0), (2, 1)]


def test_ids_are_those_of_the_library():
    ids, size = encoder(vocabulary_file("byte_bpe_50k.json"))
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c) * 2} {chr(c)}.\n{chr(c)} x" for c in [*range(0x400), *range(0x400, 0xD800, 37), 0x1F600]]
    texts += [" " * 1000, "  \n \t x", "'s'll 'T", "", "<|endoftext|>"]
    assert all(ids(t) == x[:-1].tolist() for t, x in zip(texts, library_ids(texts))) and size == 50257
    blanks = " " * 400000  # too long a run for the pattern of ranked merges
    assert ids(blanks) == library_ids([blanks])[0][:-1].tolist()


@pytest.mark.parametrize("counts", [{700: 1000}, {1: 5000}, {513: 7, 512: 1, 3: 2}, {n: n % 7 for n in range(1, 1024)}, {1023: 1}, {}, {600: 10**9, 5: 10**9}])
def test_plans_place_every_token_in_full_windows(counts):
    plan, stop = plan_tiers(counts, TIERS, 10)
    filled, taken = Counter(), defaultdict(list)
    for length, first, last, cut, size, copies, sequence, at, tier in plan:
        assert (last - first) % copies == 0 and size > 0 and at + copies * size <= tier
        taken[length].append((first, last, cut, size))
        filled[tier] += (last - first) * size
    assert all(sum((b - a) * k for a, b, _, k in taken[n]) == n * c for n, c in counts.items())
    assert sum(filled.values()) == sum(n * c for n, c in counts.items()) and all(v % t == 0 for t, v in filled.items())
    assert stop - 10 == sum(v // t for t, v in filled.items()) and len(plan) < 10000
    if counts == {600: 10**9, 5: 10**9}:
        assert sum(b - a for a, b, cut, k in taken[5]) == 10**9  # whole


def test_ranked_words_are_those_of_the_library():
    import json

    from framestore.llm.packing import ranked_words

    with open(vocabulary_file("word_bpe_49k.json"), encoding="utf-8") as f:
        fast = ranked_words(json.load(f))
    words = ["Don't", "'re'", "can'tve", "ÀÉÎõüß", "x1y22z", "a,b;c!!", "naïve's", "''s't", "0123456789abcdef" * 20, "!", "<|x", "日本", "µ", "ﬁ", "a\0b", "Z" * 3000, "don’t"]
    words += [chr(c) for c in (*range(33, 127), *range(0xC0, 0x100))] + [f"{chr(a)}{chr(b)}" for a in range(33, 127) for b in range(33, 127)]
    found = fast(words)
    assert [w for w, x in zip(words, found) if x is None] == ["<|x", "日本", "µ", "ﬁ", "a\0b", "don’t", "×", "÷", "<|"]
    assert all(x is None or x == i[:-1].tobytes() for x, i in zip(found, library_ids(words, "word_bpe_49k.json")))
