r"""Spelling variants: frequent words grouped with the rare ones that differ from them by one code point.

Words are maximal runs of the letters of `LETTERS` with A-Z in lower case. Two are near if one inserted,
deleted or replaced code point makes one from the other. The near word of a word that is the most
frequent is its form, if it is frequent enough; forms are followed to the last one, the root.

1. The vocabulary is counted in DataFrame operations, with partial aggregation.
2. Its words set bits in blocked Bloom filters, one per word length. The filters are broadcast: `FILTER_BLOCKS`
   blocks of 64 bits at most, whatever the vocabulary. A fuller filter lets more false positives pass, nothing else.
3. Every word probes its edits, whose hashes follow from that of the word. A deletion is probed in the filter of
   the next shorter words; a replacement in that of its own length, by smaller letters only. So each pair is generated once.
4. Only edits that hit a filter become strings, which a join with the vocabulary confirms or drops.

A word has a bounded number of near words for its length, so no group of variants is ever expanded into all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from framestore.llm.registry import query, table
from framestore.llm.shingles import mix
from framestore.session import delete_path, own_scratch, stage

LETTERS = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, TIMES = 6, 5, 5
#: One run in so many loses a code point, chosen by a checksum.
NOISE = 199

#: Most blocks of all filters together: 16 MB are broadcast at most.
FILTER_BLOCKS = 1 << 21
_WORDS_PER_BLOCK = 4
#: Words of this length and longer ones share a filter.
_LAST_SHARD = 64
_PROBES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], dtype=np.uint64)


def noisy(run: Column, name: Column) -> Column:
    """`run` without one of its code points, if `NOISE` divides the crc32 of `<name>:<run>`."""
    h = F.crc32(F.concat(name, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % NOISE == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int) -> DataFrame:
    """(word, n) of the words of `min_length` code points or more that occur `min_count` times or more."""
    upper = "".join(map(chr, range(65, 91)))
    runs = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("name"),
        F.explode(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(LETTERS), F.lit(0))).alias("run"),
    )
    # A shorter run gives no word, with or without a deletion.
    runs = runs.where(F.length("run") >= min_length).withColumn("run", F.translate("run", upper, upper.lower()))
    words = runs.select(noisy(F.col("run"), F.col("name")).alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    np.cumprod(np.full(max(0, n - 1), _BASE), out=out[1:])
    return out


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in `words`, code points as a matrix) for each length."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        codes = np.frombuffer("".join([words[i] for i in at.tolist()]).encode("utf-32-le"), "<u4")
        yield size, at, codes.reshape(len(at), size).astype(np.uint64)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    """The sum of code point i times base ** i, for each row."""
    return (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and bits (five of 64) of hashes in a filter of `blocks` blocks."""
    h = mix(hashes)
    block = ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    bits = np.zeros(h.shape, dtype=np.uint64)
    for k in range(5):
        bits |= np.uint64(1) << (h >> np.uint64(6 * k) & np.uint64(63))
    return block, bits


class Filters:
    """The Bloom filters of all lengths in one array of 64-bit blocks: shard s has `sizes[s]` of them, from `starts[s]` on."""

    def __init__(self, counts: dict[int, int], blocks: int = FILTER_BLOCKS):
        wanted = {s: -(-n // _WORDS_PER_BLOCK) for s, n in counts.items()}
        scale = min(1.0, blocks / max(1, sum(wanted.values())))
        self.sizes = {s: max(1, int(n * scale)) for s, n in sorted(wanted.items())}
        ends = np.cumsum([0, *self.sizes.values()]).tolist()
        self.starts = dict(zip(self.sizes, ends))
        self.bits = np.zeros(ends[-1], dtype=np.uint64)

    def add_to(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shard = min(length, _LAST_SHARD)
        block, bits = places(hashes, self.sizes[shard])
        return block + self.starts[shard], bits

    def holds(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """Which hashes may be those of words of this length."""
        if min(length, _LAST_SHARD) not in self.sizes:
            return np.zeros(hashes.shape, dtype=bool)
        block, bits = self.add_to(length, hashes)
        return self.bits[block] & bits == bits


def set_bits(words: DataFrame, filters: Filters) -> DataFrame:
    """(block, bits) of the filters: each task gives a block once per batch, the rest is a bitwise aggregate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, _, codes in by_length(batch.column("word").to_pylist()):
                block, bits = filters.add_to(size, word_hashes(codes))
                order = np.argsort(block, kind="stable")
                block, first = np.unique(block[order], return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), pa.array(np.bitwise_or.reduceat(bits[order], first).view(np.int64))], ["block", "bits"]
                )

    return words.select("word").mapInArrow(run, "block bigint, bits bigint").groupBy("block").agg(F.bit_or("bits").alias("bits"))


def edits(codes: np.ndarray, holds) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word, place, letter) of the deletions (letter -1) and replacements by smaller letters that `holds(length, hashes)` lets pass."""
    n, size = codes.shape
    power = _powers(size)
    step = max(1, _PROBES // (size * len(_ALPHABET)))
    for a in range(0, n, step):
        part = codes[a : a + step]
        terms = part * power
        whole = terms.sum(axis=1, dtype=np.uint64)
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        # What is behind the deleted place moves down by one. Of a run of equal letters the first is deleted.
        shorter = before + (whole[:, None] - before - terms) * _INVERSE
        new = np.ones(part.shape, dtype=bool)
        new[:, 1:] = part[:, 1:] != part[:, :-1]
        word, place = np.nonzero(new & holds(size - 1, shorter))
        yield word + a, place, np.full(len(word), -1, dtype=np.int64)
        word, place, letter = np.nonzero(_ALPHABET[None, None, :] < part[:, :, None])
        change = (_ALPHABET[letter] - part[word, place]) * power[place]
        hit = holds(size, whole[word] + change)
        yield word[hit] + a, place[hit], _ALPHABET[letter[hit]].astype(np.int64)


def candidates(words: DataFrame, filters: DataFrame) -> DataFrame:
    """(a, n_a, b): words with those of their edits that hit a filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n")
            for _, at, codes in by_length(words):
                for word, place, letter in edits(codes, filters.value.holds):
                    of = at[word]
                    made = [
                        words[i][:p] + (chr(c) if c >= 0 else "") + words[i][p + 1 :]
                        for i, p, c in zip(of.tolist(), place.tolist(), letter.tolist())
                    ]
                    of = pa.array(of)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("word").take(of), counts.take(of), pa.array(made, pa.string())], ["a", "n_a", "b"]
                    )

    return words.select("word", "n").mapInArrow(run, "a string, n_a bigint, b string")


def near_words(words: DataFrame, blocks: int = FILTER_BLOCKS) -> DataFrame:
    """(a, n_a, b, n_b) of near words, each pair once. `words` (word, n) must be a stored table: it is read several times."""
    spark = words.sparkSession
    shard = F.least(F.length("word"), F.lit(_LAST_SHARD)).alias("shard")
    # At most _LAST_SHARD rows.
    filters = Filters({r["shard"]: r["n"] for r in words.groupBy(shard).agg(F.count("*").alias("n")).collect()}, blocks)
    # At most `blocks` rows, and one per length.
    found = set_bits(words, filters).toArrow()
    filters.bits[found.column("block").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    probed = candidates(words.repartition("word"), spark.sparkContext.broadcast(filters))
    return probed.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the rows (word, form): the last of the chain of forms.

    A form is several times as frequent as its word, so chains have no loops and are short; each round halves them.
    """
    spark = forms.sparkSession
    linked, path = stage(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        jump = linked.select(F.col("word").alias("root"), F.col("root").alias("last"))
        longer, new_path = stage(
            linked.join(jump, "root", "left").select("word", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")), "roots"
        )
        moved = longer.where("moved").limit(1).count()
        delete_path(spark, path)
        linked, path = longer.drop("moved"), new_path
        if not moved:
            own_scratch(spark, path)
            return linked


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
    times: int = TIMES, blocks: int = FILTER_BLOCKS,
) -> DataFrame:
    """One row per word: `word`, `form`, `root`, `n`, `n_near`, `form_n`.

    A word's form is its near word of the largest n (ties: the smallest in code point order), if that n is at least
    `times` times its own; else null, and the word is its own root. Null and empty texts have no words; a null id
    counts as an empty one in the checksum; repeated rows count each by itself; words of any length take part; an empty
    table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    words, path = stage(vocabulary(docs, id_col, text_col, min_length, min_count), "vocabulary")
    own_scratch(spark, path)
    pairs, near_path = stage(near_words(words, blocks), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("word")).alias("near")).union(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("n"), F.col("a").alias("word")).alias("near"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("near"))
    enough = -F.col("near.n") >= times * F.col("n")
    known, known_path = stage(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("near.word")).alias("form"), F.when(enough, -F.col("near.n")).alias("form_n"),
        ), "spelling",
    )
    delete_path(spark, near_path)
    own_scratch(spark, known_path)
    return known.join(roots(known), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The checksum is that of zlib, byte by byte from its table of 256 remainders; letters from U+00C0 on have the bytes C3 and 80 to BF.
_SQL = f"""
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
),
runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name, translate(run, '{"".join(map(chr, range(65, 91)))}', '{"".join(map(chr, range(97, 123)))}') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
),
counted AS (SELECT name, run, count(*) AS k FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hashed AS (
    SELECT run, k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(name || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(c) - 64 AS BIGINT)] END))),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS h
    FROM counted, crc_table
),
words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
        SELECT k, CASE WHEN h % {NOISE} = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                  ELSE run END AS word FROM hashed)
    WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(k) >= {MIN_COUNT}
),
cuts AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
    SELECT DISTINCT c.word AS a, w.word AS b FROM cuts c JOIN words w ON w.word = c.cut
    UNION SELECT DISTINCT w.word, c.word FROM cuts c JOIN words w ON w.word = c.cut
    UNION SELECT DISTINCT c.word, d.word FROM cuts c JOIN cuts d ON c.cut = d.cut AND c.i = d.i AND c.word <> d.word
),
best AS (
    SELECT a, count(*) AS n_near, max(n) AS most, arg_min(b, (-n, b)) AS near FROM near JOIN words ON words.word = b GROUP BY a
),
known AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {TIMES} * n THEN near END AS form,
           CASE WHEN most >= {TIMES} * n THEN most END AS form_n
    FROM words LEFT JOIN best ON a = word
),
chain AS (
    SELECT word, word AS last FROM known
    UNION ALL SELECT chain.word, known.form FROM chain JOIN known ON known.word = chain.last WHERE known.form IS NOT NULL
)
SELECT known.word, form, last AS root, n, n_near, form_n
FROM known JOIN chain ON chain.word = known.word
WHERE last IN (SELECT word FROM known WHERE form IS NULL)
"""


@query(_SQL)
def op12_spelling(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))
