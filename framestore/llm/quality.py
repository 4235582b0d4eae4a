r"""Quality rules: a threshold table compiled into one Spark projection.

Every measure and every rule is a built-in expression over the text of its own
row, so there is no shuffle, no user function and no state: a document
is read once and judged on its whole text.

Words are runs of `[^\x20\x09-\x0D]`, lines are split at \n.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from framestore.llm.registry import query, table

WINDOW = 8
#: Frequent function words of the languages of the corpus (fixed values).
STOP_WORDS = (
    "the be to of and that have with in is it for on as was are by this or an at "
    "de la le les et des du en un une que qui est dans pour au il elle ou par "
    "der die das und ist zu den mit von für ein eine nicht auf dem sich "
    "el los las y se por con para una del es su no lo al"
).split()


@dataclass(frozen=True)
class Rule:
    """`measure` must be at least `low` and at most `high` (None: no bound)."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The base rules decide `base_failed`, all rules together decide `kept`.
BASE = (
    Rule("few_words", "n_words", low=20),
    Rule("repeated_words", "100 * n_repeat_words - 30 * n_words", high=0),
)
RULES = (
    Rule("word_length", "word_chars / nullif(n_words, 0)", low=2.0, high=14.0),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", high=0.1),
    Rule("shouting", "n_shouted / nullif(n_words, 0)", high=0.3),
    Rule("stop_words", "n_stop_words", low=2),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", high=0.5),
    Rule("bullet_lines", "n_bullet_lines / nullif(n_lines, 0)", high=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines / nullif(n_lines, 0)", high=0.3),
)


def failed(rules: tuple[Rule, ...]) -> Column:
    """True if a row breaks one of the rules. A ratio over nothing breaks none."""
    broken = F.lit(False)
    for r in rules:
        value = F.expr(r.measure)
        for bad in ([value < r.low] if r.low is not None else []) + ([value > r.high] if r.high is not None else []):
            broken = broken | F.coalesce(bad, F.lit(False))
    return broken


# Names that no column of a table is likely to have; all are dropped at the end.
_TEXT, _WORDS, _LINES, _SEEN = "__q_text", "__q_words", "__q_lines", "__q_seen"

# Windows found twice: equal windows are neighbours after the sort (hash first, the words
# decide), so a window is repeated when a neighbour has the same words.
_STARTS = f"sort_array(transform({_SEEN}, (h, i) -> struct(h, slice({_WORDS}, i + 1, {WINDOW}) AS w, i)))"
_TWICE = """sort_array(transform(filter(transform(s, (x, i) -> struct(x.i AS at,
    (i > 0 AND get(s, i - 1).h = x.h AND get(s, i - 1).w = x.w)
    OR (i + 1 < size(s) AND get(s, i + 1).h = x.h AND get(s, i + 1).w = x.w) AS twice)), y -> y.twice), y -> y.at))"""
# Each repeated window covers its words, up to the start of the next repeated one.
_COVERED = f"aggregate(transform(t, (a, i) -> least({WINDOW}, coalesce(get(t, i + 1) - a, {WINDOW}))), 0L, (n, x) -> n + x)"


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with one column per measure. Null and empty texts have zero words."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    df = docs.withColumn(_TEXT, text)
    df = df.withColumns({
        _WORDS: F.expr(rf"regexp_extract_all({_TEXT}, r'[^\x20\x09-\x0D]+', 0)"),
        _LINES: F.expr(rf"filter(split({_TEXT}, r'\n', -1), l -> l rlike r'[^\x20\x09-\x0D]')"),
    })
    df = df.withColumn(
        _SEEN,
        F.expr(
            f"CASE WHEN size({_WORDS}) >= {WINDOW} THEN transform(sequence(1, size({_WORDS}) - {WINDOW - 1}), "
            f"i -> xxhash64(slice({_WORDS}, i, {WINDOW}))) ELSE array() END"
        ),
    )
    twice = f"transform(array({_STARTS}), s -> {_TWICE})[0]"
    covered = f"transform(array({twice}), t -> {_COVERED})[0]"
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return df.withColumns({
        "n_words": F.size(_WORDS).cast("long"),
        "word_chars": F.length(F.array_join(_WORDS, "")).cast("long"),
        "n_symbols": (F.length(_TEXT) - F.length(F.regexp_replace(_TEXT, r"[#*$%&|<>]+", ""))).cast("long"),
        "n_lines": F.size(_LINES).cast("long"),
        "n_dup_lines": (F.size(_LINES) - F.size(F.array_distinct(_LINES))).cast("long"),
        "n_repeat_words": F.expr(f"CASE WHEN size(array_distinct({_SEEN})) = size({_SEEN}) THEN 0L ELSE {covered} END"),
        "n_stop_words": F.expr(f"size(array_intersect(transform({_WORDS}, w -> lower(w)), array({stop})))").cast("long"),
        "n_shouted": F.regexp_count(F.col(_TEXT), F.lit(r"(?<![^\x20\x09-\x0D])\p{Lu}{2,}[.,]?!*(?![^\x20\x09-\x0D])")).cast("long"),
        "n_bullet_lines": F.expr(rf"size(filter({_LINES}, l -> l rlike r'^[\x20\t]*[-*•]'))").cast("long"),
        "n_ellipsis_lines": F.expr(rf"size(filter({_LINES}, l -> l rlike r'(\.\.\.|…)[\x20\t\r]*$'))").cast("long"),
    }).drop(_TEXT, _WORDS, _LINES, _SEEN)


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_shouted",
    "n_bullet_lines", "n_ellipsis_lines",
)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of `docs`: id, the measures, `base_failed` and `kept`.

    A null or empty text has no words and fails the base rules. Repeated rows are
    judged one by one. An empty table gives no rows. Other columns are ignored.
    """
    rows = measure(docs.select(F.col(f"`{id_col}`").alias("__q_id"), F.col(f"`{text_col}`").alias("__q_in")), "__q_in")
    rows = rows.withColumn("base_failed", failed(BASE))
    return rows.select(
        F.col("__q_id").alias(id_col), *MEASURES, "base_failed", (~F.col("base_failed") & ~failed(rules)).alias("kept")
    )


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs` that break no rule, with their own columns only."""
    names = docs.columns
    inner = docs.toDF(*[f"__q_c{i}" for i in range(len(names))])
    measured = measure(inner, f"__q_c{names.index(text_col)}")
    # A filter on the row number stays above the projection. Pushed below it, the filter would measure each word's text anew.
    judged = measured.select(*inner.columns, (failed(BASE) | failed(rules)).alias("__q_bad"), F.monotonically_increasing_id().alias("__q_row"))
    kept = judged.where(~F.col("__q_bad") & (F.col("__q_row") >= 0))
    return kept.select(*[F.col(f"__q_c{i}").alias(n) for i, n in enumerate(names)])


def oracle(source: str = "documents", columns: str | None = None) -> str:
    """DuckDB SQL of the measures and verdicts over `source`."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

    def test(rules: tuple[Rule, ...]) -> str:
        bounds = [f"{r.measure} < {r.low}" for r in rules if r.low is not None]
        bounds += [f"{r.measure} > {r.high}" for r in rules if r.high is not None]
        return " OR ".join(f"coalesce({b}, false)" for b in bounds)

    return rf"""
    WITH split AS (
        SELECT *, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM {source}
    ), windows AS (
        SELECT doc_id, pos, list_slice(words, pos, pos + {WINDOW - 1}) AS w
        FROM split, unnest(generate_series(1, len(words) - {WINDOW - 1})) g(pos)
    ), twice AS (
        SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS next
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
    ), covered AS (
        SELECT doc_id, sum(least({WINDOW}, coalesce(next - pos, {WINDOW})))::BIGINT AS n FROM twice GROUP BY doc_id
    ), measured AS (
        SELECT split.*, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
               (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
               len(list_intersect(list_transform(words, lambda w: lower(w)), [{stop}]))::BIGINT AS n_stop_words,
               len(list_filter(words, lambda w: regexp_full_match(w, '\p{{Lu}}{{2,}}[.,]?!*')))::BIGINT AS n_shouted,
               len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\t]*[-*•]')))::BIGINT AS n_bullet_lines,
               len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\t\r]*$')))::BIGINT AS n_ellipsis_lines
        FROM split LEFT JOIN covered USING (doc_id)
    ), judged AS (SELECT *, {test(BASE)} AS base_failed, {test(RULES)} AS broken FROM measured)
    SELECT {columns or f"doc_id, {', '.join(MEASURES)}, base_failed, NOT base_failed AND NOT broken AS kept"}
    FROM judged"""


@query(oracle=oracle())
def op2_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"))
