"""Rule-based sentence segmentation as array expressions.

A sentence ends after ``.``, ``!`` or ``?`` followed by white space and an upper-case
letter. A mark (U+0001) is inserted after the white space and the text is split at
the marks, so the parts concatenate back to the text. Each sentence is
``struct<i, start, end, text>``: 0-based code-point offsets, ``text`` right-trimmed,
``end = start + length(text)``.

Start offsets are prefix sums of the part lengths, taken in blocks of blocks (text.prefix_sums),
JVM-side, no shuffle. (Spark evaluates higher-order functions interpreted, outside whole-stage
codegen; the regex and split steps are ordinary expressions.)

Every intermediate array is referenced at least twice by its consumer, so the
optimizer keeps it as a materialised column instead of inlining it into a lambda
body (where it would be evaluated once per element).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import RSTRIP_RE, WS, let, prefix_sums

# a sentence ends behind the mark and the white space before an upper-case letter
SPLIT_RE = rf"([.!?])({WS}+)(\p{{Lu}})"
BOUNDARY_RE = rf"[.!?]{WS}+(?=\p{{Lu}})"

SENTENCE_TYPE = "array<struct<i:int,start:int,end:int,text:string>>"


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


DEFAULT_ABBREVIATIONS = ("Dr", "Prof", "Nr", "St", "bzw", "ca", "vgl", "usw", "etc", "Mr", "Mrs", "No")


def _word(entry: str) -> str:
    return "\\Q" + entry.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def boundary_pattern(ordinals: bool = False, abbreviations=(), followers=()) -> str:
    """Sentence ends. Dots after a 1-3 digit number (day ordinals such as "3. Mai") and after
    the given abbreviations, both as whole words, can be excepted, and dots after any number in
    front of one of the given ``followers``. Abbreviations and followers ignore case."""
    alts = []
    if ordinals:
        alts.append(r"\p{N}{1,3}")
    if abbreviations:
        alts.append("(?iu:" + "|".join(map(_word, abbreviations)) + ")")
    if not alts and not followers:
        return BOUNDARY_RE
    guard = r"(?<![\p{L}\p{N}])(?:" + "|".join(alts) + ")"
    dot = rf"(?<!{guard})\." if alts else r"\."
    if followers:
        named = "(?iu:" + "|".join(map(_word, followers)) + r")(?![\p{L}\p{N}])"
        dot += rf"(?!(?<=\p{{N}}\.){WS}+{named})"
    return rf"(?:[!?]|{dot}){WS}+(?=\p{{Lu}})"


def sentence_parts(text, pattern: str = BOUNDARY_RE) -> Column:
    """The text cut behind every boundary; the parts joined are the text again."""
    t = F.col(text) if isinstance(text, str) else text
    return F.zip_with(F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)),
                      lambda part, end: F.concat(part, F.coalesce(end, F.lit(""))))


def with_sentences(df: DataFrame, text_col: str, out_col: str = "sents", guard_ordinals: bool = False,
                   abbreviations=(), splitter=None, learned=None) -> DataFrame:
    """Add ``out_col`` = sentences of ``text_col`` (null text -> null). Optional guards keep
    dots after ordinals / abbreviations from ending a sentence (the default rule is the one
    the oracle restates); ``learned`` are entries of operators/abbreviations.py. ``splitter`` is a caller's own rule: a function from the text column
    to an array of parts that joined are the text."""
    t = f"`{text_col}`"
    p, ln, st = (f"__{out_col}_{x}" for x in ("parts", "lens", "starts"))
    parts = (splitter(F.col(text_col)) if splitter else
             sentence_parts(text_col, boundary_pattern(
                 guard_ordinals, (*abbreviations, *(learned.abbreviations if learned else ())),
                 learned.followers if learned else ())))
    out = df.withColumn(p, parts)
    out = out.withColumn(ln, F.expr(f"transform(`{p}`, x -> length(x))"))
    out = out.withColumn(st, prefix_sums(F.col(ln)))
    rstrip = f"regexp_replace(z.`{p}`, {_sql_str(RSTRIP_RE)}, '')"
    out = out.withColumn(out_col, F.expr(
        f"transform(arrays_zip(`{p}`, `{st}`), (z, i) -> named_struct("
        f"'i', i, 'start', z.`{st}`, 'end', z.`{st}` + length({rstrip}), 'text', {rstrip}))"))
    # Optimizer barrier: the guard is always true but nondeterministic, so Catalyst
    # neither pushes later filters (e.g. the one inferred for explode/inline) through this
    # projection nor inlines the arrays into consumers. Without it the whole expression
    # is re-inlined into lambda bodies and the per-document cost becomes super-linear.
    guard = F.spark_partition_id() >= 0
    out = out.withColumn(out_col, F.when(F.col(text_col).isNotNull() & guard, F.col(out_col)))
    return out.drop(p, ln, st)


def sentence_at(sents, pos) -> Column:
    """First sentence with start <= pos < end, else null."""
    s = F.col(sents) if isinstance(sents, str) else sents
    p = F.col(pos) if isinstance(pos, str) else pos
    return F.get(F.filter(s, lambda x: (x["start"] <= p) & (p < x["end"])), 0)


def sentence_in(text, pos) -> Column:
    """start, end, text of sentence_at(with_sentences(text), pos) without the table of sentences. A
    boundary is one mark and a whole run of white space in front of a capital, so it is seen in any
    cut of the text that holds these: the text up to pos gives the start, the rest the end."""
    t, p = (F.col(c) if isinstance(c, str) else c for c in (text, pos))
    head = F.substring(t, F.lit(1), p + 1)
    start = let(head, lambda h: F.length(h) - F.length(F.element_at(F.split(h, BOUNDARY_RE, -1), -1)))
    first = rf"(?s)^(.*?[.!?]){WS}+(?=\p{{Lu}})"

    def cut(rest: Column) -> Column:
        whole = F.regexp_extract(rest, first, 1)
        return F.when(whole == "", F.regexp_replace(rest, RSTRIP_RE, "")).otherwise(whole)

    def found(s: Column) -> Column:
        return let(F.struct(s.alias("start"), cut(F.substring(t, s + 1, F.length(t))).alias("text")), ended)

    def ended(x: Column) -> Column:
        end = x["start"] + F.length(x["text"])
        return F.when(p < end, F.struct(x["start"].alias("start"), end.alias("end"), x["text"].alias("text")))

    return F.when(t.isNotNull() & (p >= 0), let(start, found))


def sentence_index_at(sents, pos) -> Column:
    hit = sentence_at(sents, pos)
    return hit["i"]


def chunk_texts(sents_col: str, size_col) -> Column:
    """Groups of ``size`` sentences joined by one blank, the last may be short;
    size -1 = whole context re-joined (one chunk). Size 0 is rejected by the caller."""
    k = size_col if isinstance(size_col, str) else None
    if k is None and int(size_col) == 0:
        raise ValueError("chunk size 0 is not allowed (use -1 for whole contexts)")
    kk = f"`{k}`" if k else str(int(size_col))
    s = f"`{sents_col}`"
    return F.expr(
        f"CASE WHEN {kk} = 0 THEN raise_error('chunk size 0 is not allowed') "
        f"WHEN {s} IS NULL THEN NULL "
        f"WHEN {kk} = -1 THEN array(array_join(transform({s}, x -> x.text), ' ')) "
        f"ELSE transform(sequence(0, (size({s}) - 1) div {kk}), "
        f"j -> array_join(transform(slice({s}, j * {kk} + 1, {kk}), x -> x.text), ' ')) END")


def sentence_window(text_col: str, sents_col: str, pos_col: str, radius: int = 1) -> Column:
    """Text from the start of sentence i-r to the end of sentence i+r, cut from the
    source text by offsets (original white space kept); i = sentence holding pos."""
    s, t, p = f"`{sents_col}`", f"`{text_col}`", f"`{pos_col}`"
    i = f"get(filter({s}, x -> x.start <= {p} AND {p} < x.end), 0).i"
    lo = f"{s}[greatest({i} - {radius}, 0)].start"
    hi = f"{s}[least({i} + {radius}, size({s}) - 1)].end"
    return F.expr(f"CASE WHEN {i} IS NULL THEN NULL ELSE substr({t}, {lo} + 1, {hi} - {lo}) END")
