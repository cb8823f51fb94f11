"""Row-local string expressions (JVM-side, codegen friendly).

All regular expressions here are written so that Java's engine (Spark) and RE2
(the DuckDB oracle) read them the same way: no look-around, explicit white-space
class, ``\\z`` for end of text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.isspace() defines it (also what str.strip/split use).
WS = r"[\x{9}-\x{D}\x{1C}-\x{1F}\x{85}\p{Z}]"
NOT_WS = r"[^\x{9}-\x{D}\x{1C}-\x{1F}\x{85}\p{Z}]"
STRIP_RE = rf"^{WS}+|{WS}+\z"
RSTRIP_RE = rf"{WS}+\z"
# Digits as str.isdigit() reads them: decimal digits plus super- and subscripts.
DIGITS_RE = r"^[\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]+\z"
TOKEN_RE = r"[\p{L}\p{N}]+|[^\x{9}-\x{D}\x{1C}-\x{1F}\x{85}\p{Z}\p{L}\p{N}]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col) -> Column:
    """Remove all Unicode white space at both ends (Spark's trim only removes blanks)."""
    return F.regexp_replace(_c(col), STRIP_RE, "")


def rstrip(col) -> Column:
    return F.regexp_replace(_c(col), RSTRIP_RE, "")


def quote_regex(text: str) -> str:
    """Literal text as a Java regex."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_exact(col, separator: str) -> Column:
    """Literal split keeping empty parts (caller checks ``size == 2``)."""
    return F.split(_c(col), quote_regex(separator), -1)


def contains(col, needle) -> Column:
    """X4."""
    return F.contains(_c(col), needle if isinstance(needle, Column) else F.lit(needle))


#: Values that one block of prefix_sums() adds up.
SUM_BLOCK = 32


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body uses it in lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def prefix_sums(values: Column) -> Column:
    """For each element of an array of ints the sum of those before it.

    There is no array scan, so sums are taken in blocks of blocks: n * SUM_BLOCK steps and
    (n / SUM_BLOCK^2)^2 / 2 more."""
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    block = lambda i: F.floor(i / SUM_BLOCK).cast("int")

    def blocks(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / SUM_BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                           lambda k: total(F.slice(v, k * SUM_BLOCK + 1, F.lit(SUM_BLOCK))))

    def inside(v: Column, before: Column) -> Column:
        return F.transform(v, lambda _, i: F.get(before, block(i)) + total(
            F.slice(v, i - i % SUM_BLOCK + 1, i % SUM_BLOCK)))

    def whole(v: Column) -> Column:
        return F.transform(v, lambda _, i: total(F.slice(v, F.lit(1), i)))

    return let(values, lambda v: let(blocks(v), lambda b: let(
        let(blocks(b), whole), lambda top: let(inside(b, top), lambda low: inside(v, low)))))


def all_offsets(text, needle) -> Column:
    """0-based start of every occurrence, overlapping; an empty needle hits every index.

    The text is cut in front of every occurrence, so the pieces' lengths add up to the starts;
    no position is compared one by one."""
    t, n = _c(text), _c(needle)
    none = F.array().cast("array<int>")
    every = F.when(F.length(t) > 0, F.sequence(F.lit(0), F.length(t) - 1)).otherwise(none)
    quoted = F.concat(F.lit(r"(?=\Q"), F.replace(n, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)"))
    starts = prefix_sums(F.transform(F.split(t, quoted, -1), lambda piece: F.length(piece)))
    # the first piece begins with the text, whether or not with an occurrence
    hits = F.when(F.startswith(t, n), starts).otherwise(F.slice(starts, 2, F.size(starts)))
    return F.when(t.isNull() | n.isNull(), none).when(n == "", every).otherwise(hits)


def offset_ok(text, needle, start) -> Column:
    """The given 0-based start is a real occurrence (same as membership in X5)."""
    t, n, s = _c(text), _c(needle), _c(start)
    in_range = (s >= 0) & (s < F.length(t))
    return F.coalesce(in_range & (F.substr(t, s + 1, F.length(n)) == n), F.lit(False))


def token_estimate(col) -> Column:
    """Word runs and single punctuation marks (an estimate, not a sub-word codec)."""
    return F.regexp_count(_c(col), F.lit(TOKEN_RE))


def is_single_word(col) -> Column:
    """The stripped line has exactly one white-space separated part."""
    return F.coalesce(_c(col).rlike(rf"^{WS}*{NOT_WS}+{WS}*\z"), F.lit(False))


def char_count(col, ch: str) -> Column:
    """Occurrences of one character."""
    return F.length(_c(col)) - F.length(F.replace(_c(col), F.lit(ch), F.lit("")))


def is_digits(col) -> Column:
    """non-empty and every character is a digit (superscripts included)."""
    return F.coalesce(_c(col).rlike(DIGITS_RE), F.lit(False))


def any_pattern(col, patterns, case_insensitive: bool = True) -> Column:
    """F8: one alternation for all patterns."""
    if not patterns:
        return F.lit(False)
    flags = "(?iu)" if case_insensitive else ""
    return F.coalesce(_c(col).rlike(flags + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def render_template(template: str, **slots) -> Column:
    """Split the template once at its slots on the driver, then concat literals and
    columns (safe when values contain braces)."""
    import string

    parts = []
    for literal, name, _spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if name not in slots:
                raise KeyError(f"template slot {name!r} has no column")
            parts.append(_c(slots[name]))
    return F.concat(*parts) if parts else F.lit("")


def first_index_of(arr, value) -> Column:
    """X11: 0-based index of the first equal element, -1 when absent."""
    return F.coalesce(F.array_position(_c(arr), _c(value)) - 1, F.lit(-1)).cast("int")
