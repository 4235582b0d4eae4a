"""Plain Python versions of the operators, slow and simple."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

from framestore.llm.quality import STOP_WORDS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Runs of white space and ASCII punctuation.
PLAIN = re.compile(r"""[ \t\n\x0b\f\r!-/:-@\[-`{-~]+""")


class Groups(dict):
    """Union of nodes; the root is the smallest."""

    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self[b] = a


def order(i):
    return (i is None, i or 0)


def exact(rows):
    groups = defaultdict(list)
    for n, (i, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), *order(i), n, i))
    out = []
    for norm, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[-1], best[-1], len(members), m[3] == best[3], sha) for m in members]
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)"""
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(8)}
    n, chars, symbols = len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>")
    dup = len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(covered) > 30 * n
    shouted = sum(bool(re.fullmatch(r"[^\W\d_]{2,}[.,]?!*", w)) and w.rstrip(".,!").isupper() for w in words)
    bad = n and not (
        2 <= chars / n <= 14 and symbols / n <= 0.1 and shouted / n <= 0.3 and dup / len(lines) <= 0.5
        and len({w.lower() for w in words} & set(STOP_WORDS)) >= 2
        and sum(bool(re.match(r"[ \t]*[-*•]", x)) for x in lines) / len(lines) <= 0.9
        and sum(bool(re.search(r"(\.\.\.|…)[ \t\r]*$", x)) for x in lines) / len(lines) <= 0.3
    )
    return n, chars, symbols, dup, len(covered), failed, not failed and not bad


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(rows):
    """[(size, smallest row linked)] for rows of text."""
    found, groups = [shingles(t) for t in rows], Groups()
    has = defaultdict(list)
    for i, s in enumerate(found):
        groups.root(i)
        for x in s:
            has[x].append(i)
    for i, s in enumerate(found):
        for j, n in Counter(j for x in s for j in has[x] if j < i).items():
            if 100 * n >= 80 * (len(s) + len(found[j]) - n):
                groups.join(i, j)
    return [(len(s), groups.root(i)) for i, s in enumerate(found)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def simhash(line):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) & (2**63 - 1) for w in set(line.split(" "))]
    return sum(1 << k for k in range(63) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def line_dedup(rows):
    """Texts of rows (id, text) without repeated lines."""
    places = defaultdict(list)
    for n, (i, text) in enumerate(rows):
        for k, line in enumerate((text or "").split("\n")):
            norm = PLAIN.sub(" ", line.lower()).strip(" ")
            if norm:
                places[norm].append((*order(i), n, k))
    norms, groups = list(places), Groups()
    hashes = [simhash(x) for x in norms]
    for a in range(len(norms)):
        groups.root(a)
        for b in range(a):
            most = max(len(norms[a]), len(norms[b])) // 10
            if (hashes[a] ^ hashes[b]).bit_count() <= 3 and abs(len(norms[a]) - len(norms[b])) <= most and edits(norms[a], norms[b]) <= most:
                groups.join(a, b)
    members = defaultdict(list)
    for a, norm in enumerate(norms):
        members[groups.root(a)] += places[norm]
    gone = {(m[2], m[3]) for ms in members.values() for m in sorted(ms)[1:]}
    return [t and "\n".join(x for k, x in enumerate(t.split("\n")) if (n, k) not in gone) for n, (_, t) in enumerate(rows)]


def repeats(rows):
    """(id, n_bytes, n_removed, n_spans, bytes left)"""
    key = lambda i: float("inf") if i is None else i
    texts, first, out = [(i, (t or "").encode()) for i, t in rows], {}, []
    for i, b in sorted(texts, key=lambda x: key(x[0])):
        for j in range(len(b) - 49):
            first.setdefault(b[j : j + 50], key(i))
    for i, b in texts:
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if first[b[j : j + 50]] < key(i):
                gone[j : j + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, y in zip(b, gone) if not y)))
    return out


def token_ids(texts):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [np.array([*e.ids, 0], dtype="<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def token_pieces(rows):
    """(id, piece, start, length, crc) of rows (id, text)"""
    return [
        (i, k, a, len(x[a : a + 2048]), zlib.crc32(x[a : a + 2048].tobytes()))
        for (i, _), x in zip(rows, token_ids([t for _, t in rows])) for k, a in enumerate(range(0, len(x), 2048))
    ]
