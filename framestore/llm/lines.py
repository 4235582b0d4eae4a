r"""Fuzzy line deduplication in DataFrame operations only.

Lines are compared in normal form: lower case, with runs of white space and ASCII punctuation as one
space; words are what the spaces separate. Two lines link when the SimHashes of their sets of words differ in at most `DISTANCE` of 63 bits and
their edit distance is at most a tenth of the longer line, whatever its length. Of every
connected group of lines one occurrence stays, the first by (document id, row, place).

Equal lines are one node. Lines meet under pigeonhole blocks: the hash is cut into eight, the points of a space over two
numbers, any three of which lie in one of its 14 planes. So lines at most `DISTANCE` apart agree on all blocks outside some plane, and
the bits of these four make a key. So many bits are in a key that different lines seldom meet by chance. Of a key with two lines the pair is tested. Of a key with more, each is tested against the
first one, and those of more than `CROWD` lines again under the keys of more of `BLOCKS` blocks, where closer lines meet. Only pairs that are
still in different components are then compared one by one, so a thousand variants of a line do not become all of their pairs, and
no link between components is lost.

A fixed-size bit filter keeps rows that have no part in a join from being moved. It only saves work.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from framestore.llm.components import components
from framestore.llm.parts import kept_by_part
from framestore.llm.registry import query, table
from framestore.session import stage

BITS, DISTANCE, BLOCKS = 63, 3, 6
#: Lines of more than these under one key also meet under the keys of more blocks.
CROWD = 16
#: White space and ASCII punctuation, the classes s and p{Punct} of Java, one by one: Java looks such a class up in a table.
_PLAIN = r"""\t\n\x0B\f\r !"#$%&'()*+,\-./:;<=>?@\[\\\]\^_`{|}~"""


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), f"[{_PLAIN}]+", " "))


_WORD_HASH = "xxhash64(word) & 9223372036854775807L"


def _majority(width: int) -> str:
    """SQL of the SimHash of the word hashes `hashes`, n of them, less than 2 ** width: bit i is set if more than half have it.

    `width` divides 63. A counter has so many bits; so many sums of 63 / width counters each count the bits k, k + width, ...
    """
    lanes = sum(1 << (width * j) for j in range(BITS // width))
    sums = [f"aggregate(hashes, 0L, (a, x) -> a + (shiftright(x, {k}) & {lanes}L))" for k in range(width)]
    half = f"({(1 << (width - 1)) - 1} - size(hashes) DIV 2) * {lanes}L"
    return " | ".join(f"shiftleft(shiftrightunsigned({x} + {half}, {width - 1}) & {lanes}L, {k})" for k, x in enumerate(sums))


def simhash() -> Column:
    """The SimHash of the array `hashes`. Longer lines take wider counters; in the longest every bit is counted by itself."""
    each = (
        f"aggregate(sequence(0, {BITS - 1}), 0L, (b, k) -> b | CASE WHEN 2 * aggregate(hashes, 0L, (a, x) -> a + (shiftrightunsigned(x, k) & 1)) "
        "> size(hashes) THEN shiftleft(1L, k) ELSE 0L END)"
    )
    return F.expr(f"CASE WHEN size(hashes) < 128 THEN {_majority(7)} WHEN size(hashes) < 512 THEN {_majority(9)} ELSE {each} END")


def _keys(chosen: list[int]) -> Column:
    """A key for each mask: the bits of `sim` under it, and which mask it is."""
    # Five bytes tell the keys apart, and three bytes of zeros take no room when they are moved.
    return F.array(*[F.xxhash64(F.lit(i), F.col("sim").bitwiseAND(F.lit(m))).bitwiseAND(F.lit((1 << 40) - 1)) for i, m in enumerate(chosen)])


def _masks(blocks: int) -> list[int]:
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def block_keys() -> Column:
    """The keys of `sim` one of which any hash at most DISTANCE bits apart has, too: the bits in each plane of the eight blocks."""
    masks = _masks(8)
    return _keys([sum(masks[i] for i in range(8) if (i & a).bit_count() % 2 == c) for a in range(1, 8) for c in (0, 1)])


def closer_keys(agree: int) -> Column:
    """A key for each choice of `agree` of BLOCKS blocks of `sim`."""
    return _keys([sum(c) for c in combinations(_masks(BLOCKS), agree)])


_FILTER_BITS = 22


def likely(df: DataFrame, column: str, wanted: DataFrame, name: str | None = None) -> DataFrame:
    """The rows of `df` whose `column` may be among `wanted[name]`.

    The filter is a table of 2 ** 22 bits, 64 to a row, whatever the input.
    """
    place = lambda c: F.shiftrightunsigned(F.xxhash64(F.lit("filter"), c), 64 - _FILTER_BITS)
    bit = lambda p: F.expr(f"shiftleft(1L, CAST({p} & 63 AS int))")
    words = wanted.select(place(F.col(name or column)).alias("__p")).groupBy(F.shiftright("__p", 6).alias("__word"))
    words = F.broadcast(words.agg(F.bit_or(bit("__p")).alias("__bits")))
    met = df.withColumn("__at", place(F.col(column))).withColumn("__word", F.shiftright("__at", 6)).join(words, "__word", "left")
    hit = F.coalesce(F.col("__bits"), F.lit(0)).bitwiseAND(bit("__at")) != 0
    return met.where(hit).select(*[F.col(f"`{c}`") for c in df.columns])


def occurrences(rows: DataFrame) -> DataFrame:
    """The columns of `rows` but for `text`, and place, h1, h2, size and sim of every line whose normal form is not empty."""
    kept = [c for c in rows.columns if c != "text"]
    lines = rows.select(*kept, F.posexplode(F.split("text", "\n", -1)).alias("place", "line")).where(F.col("line").rlike(f"[^{_PLAIN}]"))
    lines = lines.select(*kept, "place", normal(F.col("line")).alias("norm"))
    names = [F.xxhash64(F.lit(salt), "norm").alias(c) for c, salt in (("h1", "one"), ("h2", "two"))]
    hashes = F.expr(f"transform(array_distinct(split(norm, ' ', -1)), word -> {_WORD_HASH})").alias("hashes")
    lines = lines.select(*kept, "place", *names, F.length("norm").alias("size"), hashes)
    return lines.withColumn("sim", simhash()).drop("hashes")


def _near(a: str, b: str) -> Column:
    """By their SimHashes, and by their lengths."""
    apart = F.abs(F.col(f"size{a}") - F.col(f"size{b}"))
    return (F.bit_count(F.col(f"sim{a}").bitwiseXOR(F.col(f"sim{b}"))) <= DISTANCE) & (apart <= _edits(f"size{a}", f"size{b}"))


def _edits(a: str, b: str) -> Column:
    return F.floor(F.greatest(a, b) / 10).cast("int")


def _named(lines: DataFrame, end: str) -> DataFrame:
    return lines.select(*[F.col(c).alias(f"{c}{end}") for c in lines.columns])


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("line")).union(pairs.select(F.col("b").alias("line"))).distinct()


def _by_part(found: DataFrame, *columns: str) -> DataFrame:
    """(part, found): for each part a map from its rows to lists of `columns`, one row per part. It is never longer than the part's lines."""
    # Both groupings are made where the rows of a part are.
    one = found.repartition("part").groupBy("part", "row").agg(F.collect_list(F.struct(*columns)).alias("list"))
    return one.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("row", "list"))).alias("found"))


def _with_found(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """`rows`, bucketed by part, and the list `found` of each. Only what was found is moved."""
    return rows.join(found, "part", how).withColumn("found", F.try_element_at("found", F.col("row")))


def _texts(wanted: DataFrame, lines: DataFrame, occ: DataFrame, rows: DataFrame) -> DataFrame:
    """(line, norm) of the wanted lines, each from the first row that has it: only those rows are split again."""
    wanted, _ = stage(likely(lines, "line", wanted).join(wanted, "line").select("line", "h1", "h2"), "wanted-lines")
    held = likely(occ.select("part", "row", "place", "h1", "h2"), "h1", wanted).join(wanted, ["h1", "h2"])
    first = held.groupBy("line").agg(F.min(F.struct("row", "place", "part")).alias("at")).select("line", "at.*")
    first, _ = stage(_by_part(first, "line", "place"), "wanted-places")
    split = _with_found(rows.select("part", "row", "text"), first, "inner").where("found IS NOT NULL")
    split = split.select("found", F.split("text", "\n", -1).alias("lines"))
    taken = F.transform("found", lambda x: F.struct(x["line"].alias("line"), F.get("lines", x["place"]).alias("text")))
    return stage(split.select(F.inline(taken)).select("line", normal(F.col("text")).alias("norm")), "line-texts")[0]


_PIECE, _ANCHOR, _SHIFT, _OPEN = 32, 10, 48, 512


def _edits_between_anchors() -> Column:
    """The edits of x and y cut where both have the same characters: as many as between the whole texts, or more.

    Of every _PIECE characters of x the first _ANCHOR are looked up in y, at most _SHIFT characters from where they are after the last ones
    found. Pieces longer than _OPEN count by their length, so the work grows with the length of a line, not with its square.
    """
    edits = "IF(greatest(length({x}), length({y})) <= " + str(_OPEN) + ", levenshtein({x}, {y}), greatest(length({x}), length({y})))"
    before = f"greatest(s.y, s.y + i * {_PIECE} - s.x - {_SHIFT})"
    found = f"instr(substring(y, {before} + 1, {2 * _SHIFT + _ANCHOR}), substring(x, i * {_PIECE} + 1, {_ANCHOR}))"
    piece = edits.format(x=f"substring(x, s.x + 1, i * {_PIECE} - s.x)", y="substring(y, s.y + 1, at - s.y)")
    cut = f"named_struct('x', i * {_PIECE}, 'y', at, 'n', s.n + {piece})"
    step = f"transform(array(IF({found} > 0, {before} + {found} - 1, -1)), at -> IF(at >= 0, {cut}, s))[0]"
    rest = edits.format(x="substring(x, s.x + 1)", y="substring(y, s.y + 1)")
    places = f"filter(sequence(0, CAST(length(x) DIV {_PIECE} AS int)), i -> i > 0 AND i * {_PIECE} < length(x))"
    return F.expr(f"aggregate({places}, named_struct('x', 0, 'y', 0, 'n', 0), (s, i) -> {step}, s -> s.n + {rest})")


def _without_start(pairs: DataFrame) -> DataFrame:
    """x and y without most of what both begin with, and the other way round: they have as many edits as before."""
    steps = "transform(sequence(1, 7), k -> CAST(least(length(x), length(y)) DIV shiftleft(1, k) AS int))"
    same = f"aggregate({steps}, 0, (n, step) -> IF(substring(x, n + 1, step) = substring(y, n + 1, step), n + step, n))"
    pairs = pairs.withColumn("same", F.expr(same))
    return pairs.withColumns({c: F.expr(f"reverse(substring({c}, same + 1))") for c in "xy"}).drop("same")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts are similar enough."""
    a = texts.select(F.col("line").alias("a"), F.col("norm").alias("x"))
    b = texts.select(F.col("line").alias("b"), F.col("norm").alias("y"))
    met = _without_start(_without_start(pairs.join(a, "a").join(b, "b").withColumn("most", _edits_of_texts())))
    near = F.when(F.greatest(F.length("x"), F.length("y")) <= F.col("most"), True)
    near = near.when(_edits_between_anchors() <= F.col("most"), True)
    near = near.otherwise(F.expr("levenshtein(x, y, most)") >= 0)
    # Chosen after it is written: a filter would be moved below the columns that it is made of, and compute these again and again.
    return stage(met.select("a", "b", near.alias("near")), "line-links")[0].where("near").select("a", "b")


def _edits_of_texts() -> Column:
    return F.floor(F.greatest(F.length("x"), F.length("y")) / 10).cast("int")


def line_groups(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(occurrences with h1 and h2, lines with h1, h2 and `label`). Lines with one label are one group; lines that occur once and are linked with none are left out.

    `rows` has part, row, id and text and is bucketed by part.
    """
    occ, _ = stage(occurrences(rows), "occurrences")
    lines = occ.groupBy("h1", "h2").agg(F.min("sim").alias("sim"), F.min("size").alias("size"), F.count("*").alias("n"))
    lines, _ = stage(lines.withColumn("line", F.monotonically_increasing_id()), "lines")
    measured = lines.select("line", "sim", "size")
    keys = lines.select("line", F.explode(block_keys()).alias("key"))
    # Most keys have one line: moved as they are, they take half the room of sums made before.
    met = keys.repartition("key").groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b"), F.count("*").alias("n")).where("a <> b")
    met, _ = stage(met, "line-keys")
    several = met.where("n > 2").select("key", "a", "n")
    listed, _ = stage(likely(keys, "key", several).join(several, "key").select("key", "line", "a", "n"), "line-lists")
    # Lines of long lists meet those that agree on more blocks as well, so that what lies close together is one component
    # before the lists are compared pair by pair.
    crowded = listed.where(F.col("n") > CROWD).select("line").distinct()
    crowd, _ = stage(likely(measured, "line", crowded).join(crowded, "line"), "crowded-lines")
    closer = F.concat(*[closer_keys(agree) for agree in range(BLOCKS, BLOCKS - DISTANCE, -1)])
    closer = crowd.select("line", F.explode(closer).alias("key"))
    first = closer.groupBy("key").agg(F.min("line").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    closer = closer.join(first, "key")
    pairs = met.select("a", "b")
    for members in (listed, closer):
        pairs = pairs.union(members.where("line <> a").select("a", F.col("line").alias("b")))
    pairs, _ = stage(pairs.distinct(), "line-candidates")
    in_pairs = pairs.select(F.explode(F.array("a", "b")).alias("line"))
    ends, _ = stage(likely(measured, "line", in_pairs), "line-ends")
    a, b = (_named(ends, end).withColumnRenamed(f"line{end}", end[1]) for end in ("_a", "_b"))
    tested, _ = stage(pairs.join(a, "a").join(b, "b").where(_near("_a", "_b")).select("a", "b"), "line-pairs")
    links = _verified(tested, _texts(_ends(tested), lines, occ, rows))
    labels = components(links)
    known = listed.join(labels.withColumnRenamed("node", "line"), "line", "left").withColumn("label", F.coalesce("label", "line"))
    open_keys = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    # Lines of lists are in pairs.
    known = known.join(open_keys, "key").join(ends, "line").select("key", "line", "label", "sim", "size")
    known, _ = stage(known, "open-lines")
    rest = _named(known, "_a").withColumnRenamed("key_a", "key").join(_named(known, "_b").withColumnRenamed("key_b", "key"), "key")
    rest = rest.where((F.col("line_a") < F.col("line_b")) & (F.col("label_a") != F.col("label_b")) & _near("_a", "_b"))
    rest = rest.select(F.col("line_a").alias("a"), F.col("line_b").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
    rest, _ = stage(rest, "open-line-pairs")
    if rest.limit(1).count():
        labels = components(links.union(_verified(rest, _texts(_ends(rest), lines, occ, rows))))
    # A line that is linked is in a group of two lines at least, any other one is a group by itself.
    marked = lines.where("n > 1").unionByName(likely(lines.where("n = 1"), "line", labels, "node"))
    marked = marked.join(labels.withColumnRenamed("node", "line"), "line", "left").where("n > 1 OR label IS NOT NULL")
    return occ, marked.select("h1", "h2", F.coalesce("label", "line").alias("label"))


def repeated_lines(rows: DataFrame) -> DataFrame:
    """(part, found): the places of the lines that go, as in `_by_part`. `rows` as in `line_groups`."""
    occ, lines = line_groups(rows)
    lines, _ = stage(lines, "line-labels")
    occ = likely(occ.select("part", "row", "id", "place", "h1", "h2"), "h1", lines).join(lines, ["h1", "h2"])
    occ, _ = stage(occ.select("part", "row", "id", "place", "label"), "shared-lines")
    first = occ.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "place")).alias("first"))
    again = occ.join(first.select("first.row", "first.place"), ["row", "place"], "left_anti")
    return _by_part(again, "place")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the repeated lines taken out of `text_col`, and `n_lines`, `n_removed`.

    Lines are what \\n splits. Empty lines, and lines of punctuation only, stay; a
    document all of whose lines go stays with an empty text; a null text stays null.
    A null id comes after all others. Other columns stay as they are, but for those that are called `n_lines` or
    `n_removed`, which give way to the counts; an empty table gives no rows.
    """
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    with kept_by_part(inner.withColumn("row", F.monotonically_increasing_id())) as (kept, _):
        cut = [F.col("row"), F.col(id_).alias("id"), F.col(text).alias("text")]
        gone, _ = stage(repeated_lines(kept.select("part", *cut)), "line-places")
    lines = F.split(F.col(text), "\n", -1)
    # The frame knows the buckets of its files also when the table has left the catalog.
    both = _with_found(kept, gone, "left").withColumn("places", F.col("found.place"))
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains("places", i)), "\n")
    both = both.withColumns({
        "n_lines": F.coalesce(F.size(lines), F.lit(0)),
        "n_removed": F.when(F.col("places").isNull(), 0).otherwise(F.size("places")),
        text: F.when(F.col("places").isNull(), F.col(text)).otherwise(left),
    })
    own = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in ("n_lines", "n_removed")]
    return both.select(*own, "n_lines", "n_removed")


@query()
def op5_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")
