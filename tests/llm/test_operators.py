"""Every operator against a plain version, on given rows and on odd ones: nulls, empty and long texts, ties,
repeated rows, an empty table, and extra columns with the names that the operators use inside."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from framestore.llm.exact_dedup import exact_dedup
from framestore.llm.jaccard import boundary, jaccard_components
from framestore.llm.lines import dedup_lines
from framestore.llm.packing import pack, plan_bins
from framestore.llm.pieces import Pieces, decode, encode, parse_model, rebuild, vocabulary_file
from framestore.llm.quality import keep_good, quality
from framestore.llm.repeats import radix_groups, remove_repeats
from framestore.llm.secrets import confirmed_spans, find_secrets, redact, secret_spans
from framestore.llm.sharding import bounded_loads, shard
from framestore.llm.warc import LoserTree, captures_of, url_key

BASE = "The quick brown fox of the hill and a dog that is in the yard with it for as long as one can see it by day or night"
ODD = [
    (9001, None), (9002, ""), (9003, " \t\n"), (9004, "one two"), (9005, "One\tTWO "), (9006, "a" * 200), (9007, "a" * 120),
    (9008, BASE), (9009, BASE + " ."), (9010, BASE.replace("dog", "cat")), (9010, BASE.replace("dog", "cat")), (None, BASE),
    (None, None), (None, "x y z " * 40), (9011, "x" * 49), (9012, "x" * 50), (9013, "zz" + "x" * 50 + "yy"), (9014, "ab" * 60),
    (9015, "é" * 40 + "\n" + BASE + "\n" + BASE.upper()), (9016, "\n".join([BASE + f" {k}" for k in range(4)])),
    (9017, ("w%d " * 3000) % tuple(range(3000))), (9018, "don't stop\r\nstop <|endoftext|> \0 ok"), (9018, "other text, same id"),
    (9019, "password = hunter22 AKIA" + "A" * 16 + " token: x secret='abc' " + "0123456789abcdef" * 2),
]
SCHEMA = "doc_id bigint, text string"
INSIDE = ["row", "id", "part", "size", "class", "key", "words", "n_words", "kept", "place", "line", "label", "norm", "spans", "ids"]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    return sorted(given)[:120] + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return df.withColumns({c: F.lit("extra") for c in INSIDE}).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", n_chars bigint")


def same(got, expected):
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, expected), key=repr)


def test_exact_dedup(docs, rows, empty):
    same(exact_dedup(docs).collect(), brute.exact(rows))
    assert sum(r["kept"] for r in exact_dedup(docs, runs=5, fan_in=2).collect()) == len({x[-1] for x in brute.exact(rows)})
    assert exact_dedup(empty).count() == 0


def test_quality(docs, rows, empty):
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    same(quality(docs).select("doc_id", *names).collect(), [(i, *brute.quality(t)) for i, t in rows])
    good = keep_good(docs)
    assert good.columns == docs.columns
    same(good.select("doc_id", "text").collect(), [(i, t) for i, t in rows if brute.quality(t)[-1]])
    assert quality(empty).count() == 0 and keep_good(empty).count() == 0


def test_quality_is_one_projection(spark, sf_dir):
    plan = quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Join", plan)


def test_jaccard(docs, rows, empty):
    got = jaccard_components(docs).collect()
    found = brute.jaccard([t for _, t in rows])
    ids = defaultdict(list)
    for (i, _), (_, root) in zip(rows, found):
        ids[root].append(i)
    least = {root: min((i for i in x if i is not None), default=None) for root, x in ids.items()}
    expected = [(i, n, i if n == 0 else least[root]) for (i, _), (n, root) in zip(rows, found)]
    same([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], expected)
    assert jaccard_components(empty).count() == 0


def test_jaccard_near_copies_of_all_sizes(spark):
    """Sets of 4 to 80 shingles with one to many words changed, so that pairs lie on both sides of 0.8, and of the boundary."""
    random = np.random.default_rng(7)
    texts = []
    for n in [*range(5, 30), 60, 84]:
        words = [f"s{n}w{k}" for k in range(n)]
        for changes in range(6):
            copy = list(words)
            for k in random.choice(n, changes % n, replace=False):
                copy[k] = f"c{random.integers(1 << 30)}"
            texts.append(" ".join(copy[: n - random.integers(2)]))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    expected = brute.jaccard(texts)
    assert [got[i] for i in range(len(texts))] == [root for _, root in expected]
    assert 30 < len({r for _, r in expected}) < len(texts)
    assert boundary([(4, 100), (500, 100)], 50.0) >= 4 and boundary([(4, 1), (500, 100)], 0.01) < 500


def test_line_dedup(docs, rows, empty):
    few = rows[:25] + ODD
    got = dedup_lines(docs.join(docs.sparkSession.createDataFrame([(i,) for i, _ in few], "doc_id bigint").distinct(), "doc_id", "left_semi")
                      .unionByName(docs.where("doc_id IS NULL")))
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    same(got.select("doc_id", "text").collect(), zip([i for i, _ in few], brute.line_dedup(few)))
    assert dedup_lines(empty).count() == 0
    clash = dedup_lines(docs.where("doc_id < 3").withColumns({"n_lines": F.lit("x"), "n_removed": F.lit("y")}))
    assert clash.columns == [*docs.columns, "n_lines", "n_removed"] and dict(clash.dtypes)["n_removed"] == "int"


def test_line_dedup_links_near_lines(spark):
    words = " ".join(f"word{k}" for k in range(120))
    texts = [words, words.replace("word77", "word7x"), words.upper() + "  ", words[::-1], "short line", "short lines"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(6)] == brute.line_dedup(rows) and got[2] == "" and got[3] == texts[3]


def test_packing(docs, rows, empty):
    got = pack(docs).collect()
    same([tuple(r[:5]) for r in got], brute.token_pieces(rows))
    bins = defaultdict(list)
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(r["length"] for r in got) // 2048) + 1
    assert pack(empty).count() == 0


def test_plan_bins_fills_what_first_fit_leaves():
    sizes = [6, 6, 5, 5, 4, 4, 7, 3, 10, 1, 9]
    plan = plan_bins(Counter(sizes), 10)
    assert sum((stop - start) * length for length, start, stop, *_ in plan) == sum(sizes) == 60
    assert 1 + max(seq + (stop - start) // n - 1 for _, start, stop, n, seq, _ in plan) == 6


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x82]) + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


RSA = der(6, bytes.fromhex("2a864886f70d010101"))
PKCS1 = der(0x30, der(2, b"\0"), *[der(2, bytes([k + 1]) * 60) for k in range(8)])
KEY = der(0x30, der(2, b"\0"), der(0x30, RSA, der(5)), der(4, PKCS1))
SEC1 = der(0x30, der(2, b"\1"), der(4, b"\x55" * 32), der(0xA1, der(3, b"\0" + b"\x44" * 65)))
ENCRYPTED = der(0x30, der(0x30, RSA, der(0x30, der(4, b"salt" * 2), der(2, b"\x08\0"))), der(4, b"\x33" * 80))
PUBLIC = der(0x30, der(0x30, RSA, der(5)), der(3, b"\0" + der(0x30, der(2, b"\x41" * 130), der(2, b"\1\0\1"))))
CERTIFICATE = der(0x30, der(0x30, der(0xA0, der(2, b"\2")), der(2, b"\x07"), der(0x30, RSA), PUBLIC), der(0x30, RSA), der(3, b"\0" + b"\x77" * 64))


def test_secrets(docs, rows, empty):
    def base(text):
        text, out = text or "", []
        for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
            out += [(m.start(), 0, f"assign:{m.start()}:{m.end()}")] if len(m[2]) >= 6 else []
        out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        return sorted(out + [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])

    got = [(r["doc_id"], ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r["spans"] if s.kind in ("assign", "access", "hex")))
           for r in find_secrets(docs).collect()]
    same(got, [(i, ",".join(x for _, _, x in base(t))) for i, t in rows])
    clean = redact(docs)
    assert clean.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert text[9019] == "[SECRET] [SECRET] token: x secret='abc' [SECRET]" and text[9008] == BASE and text[9001] is None
    assert find_secrets(empty).count() == 0 and redact(empty).count() == 0


def test_secrets_are_confirmed_by_structure():
    b64 = base64.b64encode(KEY).decode()
    enc = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
    token = f'{enc(b"""{"alg":"HS256"}""")}.{enc(b"""{"sub":"1"}""")}.{"s" * 43}'
    ssh = base64.b64encode(b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", b"k" * 32))).decode()
    kinds = lambda t: [k for _, _, k in secret_spans(t) if k not in ("assign", "access", "hex")]
    assert kinds(f"x {b64} y") == ["base64_key"] and kinds(f"({KEY.hex()})") == ["hex_key"]
    assert kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{b64}\n-----END RSA PRIVATE KEY-----")[0] == "pem"
    assert kinds(token) == ["token"]
    wrap = lambda text, n, end="\n": end.join(text[i : i + n] for i in range(0, len(text), n))
    for key in (PKCS1, SEC1, ENCRYPTED, KEY):
        one = base64.b64encode(key).decode()
        assert kinds(f"k: {one}.") == ["base64_key"] and kinds(f"-----BEGIN PRIVATE KEY-----\n{wrap(one, 64)}\n-----END PRIVATE KEY-----")[0] == "pem"
        for text in (wrap(one, 64), wrap(one, 76, "\r\n"), wrap(one, 64, "\n    ")):
            around = f"it reads\n{text}\nand goes on with other words\n"
            (a, b, kind), = confirmed_spans(around)
            assert kind == "base64_key" and around[a:b] == text
        assert kinds(wrap(key.hex(), 2, ":")) == ["hex_key"] and kinds(wrap(wrap(key.hex().upper(), 2, ":"), 45, "\n  ")) == ["hex_key"]
    two = wrap(base64.b64encode(CERTIFICATE).decode(), 64) + "\n" + wrap(base64.b64encode(KEY).decode(), 64)
    assert [two[a:b][:12] for a, b, _ in confirmed_spans(two)] == [base64.b64encode(KEY).decode()[:12]]
    box = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + b"\0\0\0\1" + b"\x21" * 90
    assert kinds(wrap(base64.b64encode(box).decode(), 70)) == ["base64_key"]
    packet = base64.b64encode(bytes([0x95, 1, 2, 4]) + b"k" * 60).decode()
    assert kinds(f"-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: 1\n\n{wrap(packet, 64)}\n=abcd\n-----END PGP PRIVATE KEY BLOCK-----") == ["pem"]
    # Public material is no secret.
    for data, name in ((PUBLIC, "PUBLIC KEY"), (CERTIFICATE, "CERTIFICATE"), (der(0x30, der(2, b"\x41" * 130), der(2, b"\1\0\1")), "RSA PUBLIC KEY")):
        one = base64.b64encode(data).decode()
        for text in (one, wrap(one, 64), data.hex().upper(), wrap(data.hex().upper(), 2, ":"), f"-----BEGIN {name}-----\n{wrap(one, 64)}\n-----END {name}-----"):
            assert not confirmed_spans(text), name
    assert not confirmed_spans(f"ssh-ed25519 {ssh} me") and not confirmed_spans(f"-----BEGIN PGP PUBLIC KEY BLOCK-----\n{packet}\n-----END PGP PUBLIC KEY BLOCK-----")
    # Wrong lengths, other data, a header without an algorithm: not reported.
    assert not confirmed_spans(base64.b64encode(KEY[:-1] + b"").decode()) and not confirmed_spans(base64.b64encode(b"q" * 90).decode())
    assert not confirmed_spans(token.replace(enc(b'{"alg":"HS256"}'), enc(b'{"alx":"HS256"}'))) and not confirmed_spans("f" * 80)


def test_sharding(docs, rows, empty):
    got = shard(docs).collect()
    same([(r["doc_id"], r["size"], r["text_crc32"]) for r in got],
         [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows])
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    assert sum(r["home"] != r["shard"] for r in got) == sum(max(0, n - len(slots[s])) for s, n in Counter(r["home"] for r in got).items())
    assert shard(empty).count() == 0


def test_bounded_loads_go_on_clockwise():
    placed = bounded_loads([9, 0, 1, 2], [0, 1, 2, 3], 4)
    load = Counter()
    for _, start, stop, s, slot in placed:
        assert slot == load[s]
        load[s] += stop - start
    assert set(load.values()) == {3} and (0, 3, 6, 1, 0) in placed


def test_repeats(docs, rows, empty):
    got = remove_repeats(docs).collect()
    same([(r[0], r[1], r[2], r[3], bytes(r[4])) for r in got], brute.repeats(rows))
    assert remove_repeats(empty).count() == 0


def test_repeats_compares_all_bytes_of_a_window(spark):
    """Two strings of 50 bytes whose grams of 28 bytes alone differ share nothing."""
    edge, tail = "ctqwrcmozzj", "rkdyvtvzrtg"
    a, b = edge + "gpmyhdgubfagpxqnsawolxqryqna" + tail, edge + "fidslsezhvjhvfmrhkzwmqgafdsi" + tail
    rows = [(1, a), (2, b), (3, a[1:] + "x"), (4, b)]
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 50}


def test_runs_with_one_hash_are_compared_by_bytes():
    """Hashes only choose what is compared."""
    from framestore.llm import repeats

    data = np.frombuffer(b"abcdefghij" * 12 + bytes(8), np.uint8)
    same_hash = np.zeros(4, np.uint64)
    runs = repeats.Runs(data, np.array([1, 0, 2, 3]), same_hash, same_hash, np.zeros(4, np.uint8), np.array([0, 10, 3, 53]), np.full(4, 50)).compared()
    text = lambda i: bytes(data[runs.start[i] : runs.start[i] + 50])
    assert len(set(runs.group.tolist())) == 2
    assert all(text(i) == text(j) for i in range(4) for j in range(4) if runs.group[i] == runs.group[j])
    assert runs.ids[runs.one[runs.group]].tolist() == [min(runs.ids[j] for j in range(4) if runs.group[j] == g) for g in runs.group]


@pytest.mark.parametrize("hot", [0, 2, 64])
def test_repeats_splits_hot_grams(spark, monkeypatch, hot):
    """A phrase of 30 bytes that all documents have in different surroundings, and windows shared by some of them."""
    from framestore.llm import repeats

    monkeypatch.setattr(repeats, "HOT", hot)
    random = np.random.default_rng(11)
    word = lambda n: "".join(chr(97 + c) for c in random.integers(0, 26, n))
    phrase, sides = word(30), [(word(40), word(40)) for _ in range(6)]
    rows = [(k, sides[random.integers(6)][0] + phrase + sides[random.integers(6)][1] + word(9)) for k in range(80)]
    rows += [(80 + k, word(30) + phrase + word(30)) for k in range(40)] + [(200, "é" * 40000), (201, "é" * 40000 + phrase)]
    got = remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    same([(r[0], r[1], r[2], r[3], bytes(r[4])) for r in got], brute.repeats(rows))


def test_radix_groups():
    digits = [np.array([1, 2, 1, 1, 2]), np.array([5, 6, 5, 7, 8])]
    rows, group = radix_groups(5, [lambda rows, d=d: d[rows] for d in digits])
    assert sorted(rows.tolist()) == [0, 2] and len(set(group.tolist())) == 1


def test_sentencepiece(docs, rows, empty):
    model = Pieces(open(vocabulary_file("piece_bpe_32k.model"), "rb").read())
    got = encode(docs).collect()
    assert all(r["parity"] for r in got)
    same([(r["doc_id"], r["ids"], r["n_ids"]) for r in got], [(i, x, len(x)) for (i, _), x in zip(rows, model.judge.encode([t or "" for _, t in rows]))])
    same([(r["doc_id"], r["text"]) for r in decode(encode(docs)).collect()], [(i, t or "") for i, t in rows])
    for text in ["", " ", "  a", "a  b ", "▁x ▁", "\0 a\0b", "日本語 😀\n\n x", "a\tb", "<0x41> <s>", "\n", "\na\n"]:
        ids, parity = model.encode([text])
        ids = np.frombuffer(ids[0], "<u4")
        assert parity == [True] and ids.tolist() == model.judge.encode(text) and model.decode(ids) == model.judge.decode(ids.tolist())
    assert encode(empty).count() == 0


def test_unigram_models_are_rebuilt():
    import sentencepiece

    model = parse_model(open(vocabulary_file("piece_bpe_32k.model"), "rb").read())
    model.trainer_spec.model_type = 1
    model.normalizer_spec.remove_extra_whitespaces = True
    for p in model.pieces:
        if p.type == 1:
            p.score = -1.0 - len(p.piece) ** 0.5
    tokenizer, judge = rebuild(model), sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    for text in ["the other  thing", " over there ", "日本 \U0001f9ff", "", "a"]:
        assert tokenizer.encode(text, add_special_tokens=False).ids == judge.encode(text)
    assert not Pieces(model.SerializeToString()).by_word


def test_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    more = [(100000 + i, f"http://x.y/ \n{i % 3}", [None, "", "same\r\n\r\n", "é"][i % 4]) for i in range(30)]
    more += [(None, None, "same\r\n\r\n"), (None, "http://[bad", None), (100003, "http://x.y/", "é")]
    pages = pages.unionByName(spark.createDataFrame(more, "page_id bigint, url string, html string")).withColumn("sha", F.lit(1))
    rows, first, expected = list(enumerate(pages.collect())), {}, []
    for n, r in sorted(rows, key=lambda x: (brute.order(x[1].page_id), x[0])):
        again = (r.html or "") in first
        b = (r.html or "").encode()
        expected.append((r.page_id, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                         "revisit" if again else "response", first.setdefault(r.html or "", r.page_id) if again else None))
        first.setdefault(r.html or "", r.page_id)
    got = captures_of(pages).collect()
    same([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], expected)
    keys = [(r.url_key, r.time) for r in sorted(got, key=lambda r: (r.index_part, r.index_pos))]
    assert keys == sorted(keys)
    assert captures_of(pages.limit(0)).count() == 0


def test_loser_tree_merges_any_number_of_runs():
    random = np.random.default_rng(3)
    for k in range(0, 9):
        runs = [sorted(random.integers(0, 20, random.integers(0, 12)).tolist()) for _ in range(k)]
        assert list(LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)
    assert url_key("HTTP://www.A.example.com:80/P?q=1#f") == "com,example,a)/p?q=1"
