"""The row-local functions as SQL functions of a session, for callers who write Spark SQL.

``install(spark)`` defines temporary functions from SQL text alone; the engine inlines their bodies
like any expression, so a query that uses them has no Python in its plan. Sentences come as an array:
``FROM (SELECT id, sm_sentences(text) AS s FROM t) LATERAL VIEW inline(s)`` has them as rows. (A table
function would be planned as a join on the text.)"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .sentences import BOUNDARY_RE
from .text import DIGITS_RE, NOT_WS, RSTRIP_RE, STRIP_RE, SUM_BLOCK, TOKEN_RE, WS


def _q(s: str) -> str:
    return "r'" + s + "'" if "'" not in s else "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """body with the named value computed once, though lambdas use it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _blocks(v: str) -> str:
    return (f"transform(sequence(0, cast(greatest((size({v}) - 1) div {SUM_BLOCK}, 0) AS INT)), "
            f"k -> aggregate(slice({v}, k * {SUM_BLOCK} + 1, {SUM_BLOCK}), 0, (s, x) -> s + x))")


def _inside(v: str, before: str) -> str:
    return (f"transform({v}, (y, i) -> {before}[cast(i div {SUM_BLOCK} AS INT)] + aggregate(slice("
            f"{v}, i - i % {SUM_BLOCK} + 1, i % {SUM_BLOCK}), 0, (s, x) -> s + x))")


_WHOLE = "transform(top, (y, i) -> aggregate(slice(top, 1, i), 0, (s, x) -> s + x))"

_SUMS = _let(_blocks("l"), "b", _let(_let(_blocks("b"), "top", _WHOLE), "high",
                                    _let(_inside("b", "high"), "low", _inside("l", "low"))))
_PARTS = (f"zip_with(split(t, {_q(BOUNDARY_RE)}, -1), regexp_extract_all(t, {_q(BOUNDARY_RE)}, 0), "
          "(part, mark) -> concat(part, coalesce(mark, '')))")
_KEPT = f"regexp_replace(p, {_q(RSTRIP_RE)}, '')"
_SINGLE = _q("^" + WS + "*" + NOT_WS + "+" + WS + "*" + chr(92) + "z")

#: name -> (parameters, result, body).
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "sm_strip": ("s STRING", "STRING", f"regexp_replace(s, {_q(STRIP_RE)}, '')"),
    "sm_is_digits": ("s STRING", "BOOLEAN", f"coalesce(rlike(s, {_q(DIGITS_RE)}), false)"),
    "sm_is_single_word": ("s STRING", "BOOLEAN", f"coalesce(rlike(s, {_SINGLE}), false)"),
    "sm_token_estimate": ("s STRING", "INT", f"regexp_count(s, {_q(TOKEN_RE)})"),
    "sm_char_count": ("s STRING, c STRING", "INT", "length(s) - length(replace(s, c, ''))"),
    "sm_offset_ok": ("t STRING, needle STRING, start INT", "BOOLEAN",
                     "coalesce(start >= 0 AND start < length(t) AND "
                     "substr(t, start + 1, length(needle)) = needle, false)"),
    # sums of the elements before each one, in blocks of blocks (see text.prefix_sums)
    "sm_prefix_sums": ("v ARRAY<INT>", "ARRAY<INT>", _let("v", "l", _SUMS)),
    "sm_sentences": ("t STRING", "ARRAY<STRUCT<i: INT, start: INT, end: INT, text: STRING>>", "IF(t IS NULL, NULL, " +
                     _let(_PARTS, "parts", _let(
                         _let("transform(parts, x -> length(x))", "l", _SUMS), "starts",
                         f"transform(parts, (p, i) -> named_struct('i', i, 'start', starts[i], "
                         f"'end', starts[i] + length({_KEPT}), 'text', {_KEPT}))")) + ")"),
}


def install(spark: SparkSession) -> list[str]:
    """Define the functions in the session (again, if they are there); returns their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
