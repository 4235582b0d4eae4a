"""Translation of strftime formats to Spark datetime patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from framestore.errors import InvalidInputError
from framestore.functions.zones import zone_name

# Strftime directive -> Spark datetime pattern.
PATTERNS = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss",
    "f": "SSSSSS", "j": "DDD", "b": "MMM", "h": "MMM", "B": "MMMM", "a": "E", "A": "EEEE", "p": "a",
}
# Directives that no Spark pattern gives, from the local time.
COMPUTED = {
    "w": lambda t: (F.dayofweek(t) - 1).cast("string"),
    "u": lambda t: (F.weekday(t) + 1).cast("string"),
    "U": lambda t: _two(F.floor((F.dayofyear(t) + 7 - F.dayofweek(t)) / 7)),
    "W": lambda t: _two(F.floor((F.dayofyear(t) + 6 - F.weekday(t)) / 7)),
    "V": lambda t: _two(F.weekofyear(t)),
    "G": lambda t: F.date_part(F.lit("YEAROFWEEK"), t).cast("string"),
}
# Directives that stand for several others.
COMPOUNDS = {"F": "%Y-%m-%d", "T": "%H:%M:%S", "R": "%H:%M", "D": "%m/%d/%y"}
_BARE_LITERALS = set(" -/:.,;_+()")


def split_format(fmt: str) -> list[tuple[str, str]]:
    """Split `fmt` into ('text', literal) and ('directive', letter) tokens."""
    if not isinstance(fmt, str):
        raise InvalidInputError(f"The datetime format must be a string, got {type(fmt)}", data=fmt)
    tokens: list[tuple[str, str]] = []
    chars = iter(fmt)
    for ch in chars:
        if ch != "%":
            tokens.append(("text", ch))
            continue
        letter = next(chars, "")
        if letter == "%":
            tokens.append(("text", "%"))
        elif letter in COMPOUNDS:
            tokens += split_format(COMPOUNDS[letter])
        elif letter in (*PATTERNS, *COMPUTED, "z", "Z"):
            tokens.append(("directive", letter))
        else:
            raise InvalidInputError(f"Unsupported directive %{letter} in datetime format {fmt!r}", data=fmt)
    return tokens


def _quote(text: str) -> str:
    if set(text) <= _BARE_LITERALS:
        return text
    return "'" + text.replace("'", "''") + "'"


def spark_patterns(fmt: str) -> list[tuple[str, str]]:
    """`fmt` as a list of ('pattern', Spark pattern), ('offset', ''), ('zone', '') and ('computed', letter).

    A new pattern starts where two directives would run into one longer pattern
    letter run, as in ``%d%d``.
    """
    pieces: list[tuple[str, str]] = []
    pattern, literal = "", ""
    for kind, value in split_format(fmt):
        if kind == "text":
            literal += value
            continue
        pattern += _quote(literal) if literal else ""
        literal = ""
        if value in "zZ" or value in COMPUTED:
            if pattern:
                pieces.append(("pattern", pattern))
            pieces.append(("computed", value) if value in COMPUTED else ("offset" if value == "z" else "zone", ""))
            pattern = ""
        else:
            addition = PATTERNS[value]
            if pattern and pattern[-1] == addition[0]:
                pieces.append(("pattern", pattern))
                pattern = ""
            pattern += addition
    pattern += _quote(literal) if literal else ""
    if pattern or not pieces:
        pieces.append(("pattern", pattern))
    return pieces


# Numbers that may have one digit when they are parsed.
_SHORT = {"m": "M", "d": "d", "H": "H", "I": "h", "M": "m", "S": "s"}


def has_directive(fmt: str, letter: str) -> bool:
    return ("directive", letter) in split_format(fmt)


def parse_patterns(fmt: str) -> list[str]:
    """Spark patterns that together read `fmt`, the full one first; the second reads text without the seconds."""
    tokens = split_format(fmt)
    for kind, value in tokens:
        if kind == "directive" and (value == "Z" or value in COMPUTED):
            raise InvalidInputError(f"%{value} cannot be parsed, in datetime format {fmt!r}", data=fmt)
    # Where nothing separates two numbers, each has its full width.
    adjacent = any(a == b == "directive" for (a, _), (b, _) in zip(tokens, tokens[1:]))
    variants = [tokens]
    if tokens[-2:] == [("text", ":"), ("directive", "S")]:
        variants.append(tokens[:-2])
    out = []
    for variant in variants:
        pattern, literal = "", ""
        for kind, value in variant:
            if kind == "text":
                literal += value
                continue
            pattern += _quote(literal) if literal else ""
            literal = ""
            pattern += "Z" if value == "z" else PATTERNS[value] if adjacent else _SHORT.get(value, PATTERNS[value])
        out.append(pattern + (_quote(literal) if literal else ""))
    return out


def format_wall_clock(wall: Column, fmt: str, offset_seconds: Column | None, zone: str | None) -> Column:
    """`wall` (local time) as text. `%z` and `%Z` are empty for naive columns."""
    parts = []
    for kind, value in spark_patterns(fmt):
        if kind == "pattern":
            parts.append(F.date_format(wall, value) if value else F.lit(""))
        elif kind == "offset":
            parts.append(F.lit("") if offset_seconds is None else _offset_text(offset_seconds))
        elif kind == "computed":
            parts.append(COMPUTED[value](wall))
        elif zone is None:
            parts.append(F.lit(""))
        else:
            parts.append(zone_name(F.unix_seconds(wall.cast("timestamp")) - offset_seconds, zone))
    text = parts[0] if len(parts) == 1 else F.concat(*parts)
    has_pattern = any(kind == "pattern" and value for kind, value in spark_patterns(fmt))
    return text if has_pattern else F.when(wall.isNotNull(), text)


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def _offset_text(seconds: Column) -> Column:
    size = F.abs(seconds)
    rest = size % 60
    return F.concat(
        F.when(seconds < 0, F.lit("-")).otherwise(F.lit("+")),
        _two(F.floor(size / 3600)),
        _two(F.floor(size / 60) % 60),
        F.when(rest == 0, F.lit("")).otherwise(_two(rest)),
    )
